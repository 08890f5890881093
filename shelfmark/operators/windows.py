"""Sequences: sessions, episodes, gaps, latest values, top-k, paging, snapshots compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.working import write_table


def sessions(rows: DataFrame, by: list[str], at: str, gap: Column) -> DataFrame:
    """Adds session: a new one begins where the step from the row before is longer than the gap. gap compares `step`,
    the difference in seconds."""
    w = Window.partitionBy(*by).orderBy(at)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    step = (micros(F.col(at)) - micros(F.lag(at).over(w))) / 1e6
    marked = rows.withColumn("step", step).withColumn("_new", F.when(F.col("step").isNull() | gap, 1).otherwise(0))
    return marked.withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new", "step")


def session_summary(rows: DataFrame, by: list[str], at: str) -> DataFrame:
    return rows.groupBy(*by, "session").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def episodes(days: DataFrame, by: list[str], day: str, flag: str) -> DataFrame:
    """Runs of flagged days: number of episodes, flagged days, median days between starts, and the last start."""
    w = Window.partitionBy(*by).orderBy(day)
    starts = days.withColumn("_start", F.col(flag) & ~F.coalesce(F.lag(flag).over(w), F.lit(False)))
    only = starts.filter("_start").withColumn("_gap", F.datediff(day, F.lag(day).over(w)))
    runs = only.groupBy(*by).agg(F.count(F.lit(1)).alias("episodes"), F.median("_gap").alias("median_gap"), F.max(day).alias("last_start"))
    flagged = days.groupBy(*by).agg(F.count_if(flag).alias("flagged_days"), F.max(day).alias("last_day"))
    due = F.datediff("last_day", "last_start") >= 0.8 * F.col("median_gap")
    return flagged.join(runs, by, "left").select(*by, "flagged_days", F.coalesce("episodes", F.lit(0)).alias("episodes"), "median_gap", "last_start", F.coalesce(due, F.lit(False)).alias("likely_soon"))


def interior_gaps(rows: DataFrame, entity: list[str], period: str) -> DataFrame:
    """Periods (integers) that an entity lacks between its first and its last."""
    held = rows.select(*entity, period).distinct()
    span = held.groupBy(*entity).agg(F.min(period).alias("_a"), F.max(period).alias("_b"))
    wanted = span.select(*entity, F.explode(F.sequence("_a", "_b")).alias(period))
    return wanted.join(held, [*entity, period], "left_anti")


def latest(rows: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """One row a key, by a full order; Spark keeps one row a task before it shuffles."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def fold_latest(parts: DataFrame, key: list[str], order: str, columns: list[str]) -> DataFrame:
    """Per key and column the latest value that is present: an empty string never overwrites, zero and false do."""
    def value(c: str) -> Column:
        there = F.col(c).isNotNull() & (F.col(c).cast("string") != "")
        return F.max_by(F.when(there, F.col(c)), F.when(there, F.col(order))).alias(c)

    return parts.groupBy(*key).agg(*[value(c) for c in columns], F.max(order).alias(order))


def top_per_group(rows: DataFrame, by: list[str], k: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)


def page(rows: DataFrame, offset: int, size: int, *order: Column) -> DataFrame:
    """One page and, on each row, the number of all rows."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return rows.orderBy(*order).offset(offset).limit(size).join(F.broadcast(total))


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Events between two snapshots: new, delisted, or a changed column, each with a deterministic id."""
    b = before.select(*key, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("_b"))
    a = after.select(*key, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("_a"))
    j = b.join(a, key, "full")
    event = lambda kind, old, new: F.struct(F.lit(kind).alias("event"), old.cast("string").alias("old"), new.cast("string").alias("new"))
    none = F.lit(None)
    changed = [F.when(F.col("_a") & F.col("_b") & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), event(c, F.col(f"b_{c}"), F.col(f"a_{c}"))) for c in columns]
    events = F.array_compact(F.array(F.when(F.col("_b").isNull(), event("new", none, none)), F.when(F.col("_a").isNull(), event("delist", none, none)), *changed))
    out = j.select(*key, F.explode(events).alias("e")).select(*key, "e.*")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*key, "event", "old", "new")]
    text = [x for p in parts for x in (F.lit("|"), p)][1:]
    return out.withColumn("event_id", F.sha1(F.concat(*text)))


def as_microbatch_window(rows: DataFrame, at: str, days: int) -> DataFrame:
    """Tumbling windows of whole days from a Monday."""
    return rows.withColumn("window_start", F.date_sub(F.to_date(at), F.pmod(F.datediff(F.to_date(at), F.lit("1970-01-05").cast("date")), F.lit(days))))


def numbered(rows: DataFrame, *order: Column, name: str = "rn") -> DataFrame:
    """Rows numbered from 1 in a full order: within ranges of it, and on from range to range, so that no task sorts all."""
    ranged = write_table(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "numbered")
    before, offsets = 0, []
    for r in ranged.groupBy("_range").count().orderBy("_range").collect():  # as many rows as ranges
        offsets += [F.lit(r["_range"]), F.lit(before)]
        before += r["count"]
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, (place + (F.create_map(*offsets)[F.col("_range")] if offsets else 0)).cast("long")).drop("_range")
