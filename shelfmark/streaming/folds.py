"""Streams of landed parts: micro-batch folds, windows with watermarks, sessions, snapshots with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import present
from ..sources.catalog import Catalog


def parts_stream(spark: SparkSession, path: str, schema: StructType, per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder; a checkpoint knows which are consumed. Adds part: the file's name, which orders."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path).withColumn("part", F.element_at(F.split("_metadata.file_path", "/"), -1))


def fold_stream(stream: DataFrame, catalog: Catalog, target: str, keys: list[str], columns: list[str], checkpoint: str, digits: int = 2) -> StreamingQuery:
    """Folds each micro-batch into the target's state: per key and column the value of the latest part in which it is
    present. The state is a maximum of (part, value), so that a batch that runs twice, or a late part, changes nothing."""

    def fold(batch: DataFrame, number: int) -> None:
        there = lambda c: F.when(present(c), F.struct(F.col("part").alias("p"), F.col(c).alias("v")))
        fresh = batch.groupBy(*keys).agg(*[F.max(there(c)).alias(c) for c in columns])
        if not fresh.isEmpty():
            catalog.fold_state(target, keys, columns, fresh, digits)

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def weekly(stream: DataFrame, at: str, by: list[str], value: str, late: str = "2 days") -> DataFrame:
    """Tumbling weeks from Monday with a watermark."""
    week = F.window(at, "7 days", startTime="4 days")
    return stream.withWatermark(at, late).groupBy(week.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("week"), *by, "n", "total")


def sessions(stream: DataFrame, at: str, by: list[str], gap: str, late: str = "2 days") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("s"), *by).agg(F.count(F.lit(1)).alias("n")).select(*by, F.col("s.start").alias("first_at"), F.col("s.end").alias("until"), "n")


_EVENT = "key string, event string, old double, new double"


def price_events(stream: DataFrame, key: str, price: str) -> DataFrame:
    """new and price events of each key against its last known price, which is kept as state."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for frame in frames:
            for p in frame.sort_values("part")["price"]:
                if last is None:
                    out.append((k[0], "new", None, p))
                elif p != last:
                    out.append((k[0], "price", last, p))
                last = p
        if last is not None:
            state.update((float(last),))
        yield pd.DataFrame(out, columns=["key", "event", "old", "new"])

    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(price).cast("double").alias("price"), "part")
    return rows.groupBy("key").applyInPandasWithState(step, _EVENT, "last double", "append", "NoTimeout")
