"""Leaderboards of a sales book by eight kinds of measure, bounded marts and their year-over-year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cuts(facts: DataFrame, dim: str, kind: str, of: str = "revenue", account: str = "account_id", volume: str = "cases") -> DataFrame:
    """dim and value, by kind: sum, distinct, share (per cent of all), rate (per account), index (price, all = 100), yoy."""
    if kind == "yoy":
        return growth(facts, dim, of)
    g = facts.groupBy(F.col(dim).alias("name")).agg(
        F.sum(of).alias("s"), F.sum(volume).alias("v"), F.count_distinct(account).alias("a"), F.count_distinct(of).alias("u")
    )
    if kind == "distinct":
        return g.select("name", F.col("u").alias("value"))
    if kind == "sum":
        return g.select("name", F.round("s", 1).alias("value"))
    if kind == "rate":
        return g.select("name", F.round(F.try_divide("s", "a"), 2).alias("value"))
    # The total is a sum over one row a member, not a second pass over facts.
    total = g.agg(F.sum("s").alias("ts"), F.sum("v").alias("tv"))
    joined = g.join(F.broadcast(total))
    if kind == "share":
        return joined.select("name", F.round(100.0 * F.try_divide("s", "ts"), 2).alias("value"))
    if kind == "index":
        return joined.select("name", F.round(100.0 * F.try_divide(F.try_divide("s", "v"), F.try_divide("ts", "tv")), 1).alias("value"))
    raise ValueError(f"no such kind of measure: {kind}")


def growth(facts: DataFrame, dim: str, of: str) -> DataFrame:
    """The last twelve months of the book against the twelve before. facts has month (first of month, a date)."""
    months = facts.select("month").distinct().withColumn("rn", F.row_number().over(Window.orderBy(F.desc("month")))).filter("rn <= 24")
    g = (
        facts.join(F.broadcast(months), "month")
        .groupBy(F.col(dim).alias("name"))
        .agg(F.sum(F.when(F.col("rn") <= 12, F.col(of)).otherwise(0.0)).alias("now"), F.sum(F.when(F.col("rn") > 12, F.col(of)).otherwise(0.0)).alias("then"))
    )
    return g.select("name", F.round(100.0 * F.try_divide(F.col("now") - F.col("then"), F.nullif("then", F.lit(0.0))), 1).alias("value")).filter("value is not null")


def bounded_mart(facts: DataFrame, keys: list[str], sums: list[str], carried: list[str] = []) -> DataFrame:
    """Sums at keys whose number does not grow with facts; carried attributes take their least value."""
    return facts.groupBy(*keys).agg(*[F.round(F.sum(c), 2).alias(c) for c in sums], *[F.min(c).alias(c) for c in carried])


def year_over_year(mart: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Each row beside the row of the same keys a year before; period is YYYYMM."""
    before = mart.select(*keys, (F.col(period) + 100).alias(period), F.col(value).alias("prior"))
    joined = mart.join(before, [*keys, period], "left")
    return joined.withColumn("yoy_pct", F.round(100.0 * F.try_divide(F.col(value) - F.col("prior"), F.nullif("prior", F.lit(0.0))), 2) + 0.0)  # no negative zero


def largest_remainder(shares: DataFrame, by: list[str], share: str, total: str) -> DataFrame:
    """Whole parts that sum to the total: floors, then one more for the largest remainders. total is a column."""
    w = Window.partitionBy(*by)
    exact = F.col(share) / F.sum(share).over(w) * F.col(total)
    parts = shares.withColumn("exact", exact).withColumn("base", F.floor("exact"))
    left = F.col(total) - F.sum("base").over(w)
    order = F.row_number().over(w.orderBy(F.desc(F.round(F.col("exact") - F.col("base"), 9)), *[c for c in shares.columns if c not in (share, total)]))
    return parts.withColumn("units", (F.col("base") + F.when(order <= left, 1).otherwise(0)).cast("long")).drop("exact", "base")
