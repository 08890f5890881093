"""What Parquet footers tell of a table without its data: rows, nulls and ranges, read by tasks, a footer each file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import attach
from .stores import opened

GROUPS = "file string, bytes long, row_group int, rows long, column string, nulls long, least string, most string, size long"


def files_of(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """Addresses and sizes of the Parquet files below some folders, by Hadoop's listing."""
    out = []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
        while found.hasNext():
            f = found.next()
            name = f.getPath().getName()
            if name.endswith(".parquet") and not name.startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def reachable(address: str) -> bool:
    """Whether tasks can open files there themselves."""
    return "://" not in address and not address.startswith("viewfs") or address.split(":")[0] in ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def _ranges(meta) -> tuple[str | None, str | None]:
    s = meta.statistics
    if s is None or not s.has_min_max:
        return None, None
    return str(s.min), str(s.max)


def row_groups(spark: SparkSession, paths: list[str], a_task: int = 64) -> DataFrame:
    """A row for each column of each row group: rows, nulls (null where the footer does not count them), the least and
    largest value as text, and bytes. Tasks open the files and read their ends only; no page of data is read."""
    import pyarrow.parquet as pq

    attach(spark)
    files = files_of(spark, paths)
    if not files:
        return spark.createDataFrame([], GROUPS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, size in zip(*[c.to_pylist() for c in batch.columns]):
                with opened(file) as f:
                    meta = pq.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        column = group.column(c)
                        s = column.statistics
                        nulls = s.null_count if s is not None and s.has_null_count else None
                        rows.append((file, size, g, group.num_rows, column.path_in_schema, nulls, *_ranges(column), column.total_compressed_size))
            types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = [c.split(" ")[0] for c in GROUPS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(types), types)], names=names)

    tasks = max(1, -(-len(files) // a_task))
    return spark.createDataFrame(files, "file string, bytes long").repartition(tasks).mapInArrow(run, GROUPS)


def column_profile(groups: DataFrame) -> DataFrame:
    """column, rows, nulls and null_share of a table; nulls are unknown where one of its footers does not count them."""
    known = F.count_if(F.col("nulls").isNull()) == 0
    g = groups.groupBy("column").agg(F.sum("rows").alias("rows"), F.when(known, F.sum("nulls")).alias("nulls"), F.sum("size").alias("bytes"))
    return g.withColumn("null_share", F.round(F.try_divide(F.col("nulls").cast("double"), F.col("rows").cast("double")), 6))


def part_counts(groups: DataFrame) -> DataFrame:
    """file, rows, row_groups: each row group counts once."""
    once = groups.groupBy("file", "row_group").agg(F.max("rows").alias("rows"))
    return once.groupBy("file").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("row_groups"))


def row_count(spark: SparkSession, paths: list[str]) -> int:
    """Rows of a table from its footers."""
    found = part_counts(row_groups(spark, paths)).agg(F.sum("rows")).first()[0]
    return found or 0
