"""Working tables in the folder that all executors share: they cut lineage and outlive an executor."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import attach

#: By identity of the table that was given out; the table is kept, so that no other takes its place.
_written: dict[int, tuple[SparkSession, str, DataFrame]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set and all runs on this machine, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="shelfmark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def write_table(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: a cut of the lineage that survives lost executors.

    The folder is removed by `forget`, or when the driver's Python ends: results are lazy and may still read it.
    """
    spark = df.sparkSession
    attach(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[id(table)] = (spark, path, table)
    return table


def forget(table: DataFrame) -> None:
    """Removes a working table that nothing will read again."""
    spark, path, _ = _written.pop(id(table))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def tasks_for(rows: DataFrame, each: int = 1 << 20) -> int:
    """Tasks for a shuffle of these rows: as many as are set, or more where each would get over `each` rows. For given tables,
    whose rows Spark counts by their footers."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // each))


def spread(rows: DataFrame, each: int = 100_000) -> DataFrame:
    """A given table's rows dealt to tasks by their number: one small file holds many rows of few bytes, and what is made of
    them in one task may be long or large."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // each))
    return rows.withColumn("_at", F.monotonically_increasing_id()).repartition(n, "_at").drop("_at")


@atexit.register
def _remove() -> None:
    for _, _, table in list(_written.values()):
        try:
            forget(table)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            return
