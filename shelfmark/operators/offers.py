"""Offers of stores: signals, ranking, deduplication, placement in markets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import present


def stock_signal(qty: Column, per_week: Column, age_days: Column, counting: Column) -> Column:
    """What a quantity says: unknown where the source does not count or is stale; days of supply decide the rest."""
    days = F.try_divide(qty, per_week / 7)
    return (
        F.when(~counting | qty.isNull() | (age_days > 14), "unknown")
        .when(qty <= 0, "out")
        .when(days < 3, "hurry")
        .when(days < 10, "low")
        .otherwise("ample")
    )


def blend(offers: DataFrame, price: str, miles: str, stock: str, max_miles: float = 25.0) -> DataFrame:
    """0.5 of price, 0.3 of nearness, 0.2 of stock, each 0 to 1 within the offers. The range of prices is an aggregate,
    so that no row is gathered in one place."""
    ends = offers.agg(F.min(price).alias("_lo"), F.max(price).alias("_hi"))
    j = offers.join(F.broadcast(ends))
    cheap = F.coalesce(1 - F.try_divide(F.col(price) - F.col("_lo"), F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))), F.lit(1.0))
    near = 1 - F.least(F.col(miles) / max_miles, F.lit(1.0))
    return j.withColumn("score", F.round(0.5 * cheap + 0.3 * near + 0.2 * F.col(stock), 6)).drop("_lo", "_hi")


def pick_best(offers: DataFrame, by: list[str], order: list[Column], seen: str) -> DataFrame:
    """The best offer of each key by a full order, and the other sources that show it."""
    w = Window.partitionBy(*by).orderBy(*order)
    best = offers.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    also = offers.groupBy(*by).agg(F.sort_array(F.collect_set(seen)).alias("_all"))
    j = best.join(also, by)
    return j.withColumn("also_seen", F.array_join(F.array_except("_all", F.array(seen)), ",")).drop("_all")


def strip_claims(offers: DataFrame, mode: str, claims: dict[str, tuple[str, ...]]) -> DataFrame:
    """Claims that a mode may not show are null."""
    return offers.withColumns({c: F.lit(None).cast(offers.schema[c].dataType) for c, modes in claims.items() if mode not in modes})


def sibling_backfill(rows: DataFrame, sibling: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Missing values from the sibling table, marked in `_derived` as field:how."""
    s = sibling.groupBy(*key).agg(*[F.max(F.when(present(c), F.col(c))).alias(f"_{c}") for c in columns])
    j = rows.join(s, key, "left")
    fills = {c: ~present(c) & F.col(f"_{c}").isNotNull() for c in columns}
    marks = F.array_compact(F.array(*[F.when(f, F.lit(f"{c}:sibling")) for c, f in fills.items()]))
    j = j.withColumn("_derived", F.array_join(F.array_sort(marks), ","))
    for c, f in fills.items():
        j = j.withColumn(c, F.when(f, F.col(f"_{c}")).otherwise(F.col(c)))
    return j.drop(*[f"_{c}" for c in columns])


def unresolved(parts: DataFrame, key: list[str], column: str) -> DataFrame:
    """Keys none of whose rows has the column."""
    return parts.groupBy(*key).agg(F.count_if(present(column)).alias("n"), F.count(F.lit(1)).alias("tries")).filter("n = 0").drop("n")


def strikes(log: DataFrame, key: str, day: str, failed: str, least: int = 3) -> DataFrame:
    """Keys that failed on several different days and never worked since the last of them."""
    g = log.groupBy(key).agg(F.count_distinct(F.when(F.col(failed), F.col(day))).alias("bad_days"), F.max(F.when(~F.col(failed), F.col(day))).alias("last_ok"), F.max(F.when(F.col(failed), F.col(day))).alias("last_bad"))
    return g.filter((F.col("bad_days") >= least) & (F.col("last_ok").isNull() | (F.col("last_ok") < F.col("last_bad"))))


def run_ledger(runs: DataFrame, key: str, at: str, ok: str, volume: str) -> DataFrame:
    """Last attempt, last success, high-water mark and the share of it that the last run reached."""
    g = runs.groupBy(key).agg(F.max(at).alias("last_try"), F.max(F.when(F.col(ok), F.col(at))).alias("last_ok"), F.max(volume).alias("high_water"), F.max_by(volume, at).alias("last_volume"))
    state = F.when(F.col("high_water") == 0, "baseline").when(F.col("last_volume") >= 0.9 * F.col("high_water"), "complete").otherwise("partial")
    return g.withColumn("coverage", F.round(F.try_divide(F.col("last_volume").cast("double"), F.col("high_water").cast("double")), 4)).withColumn("state", state)


def calibrate(implied: DataFrame, anchor: DataFrame, by: list[str]) -> DataFrame:
    """Scale and mean absolute error of implied units against an anchor over the cells that both have."""
    j = implied.join(anchor, by)
    scale = F.try_divide(F.sum("actual"), F.sum("implied"))
    s = j.agg(scale.alias("scale"), F.count(F.lit(1)).alias("cells"))
    e = j.join(F.broadcast(s)).groupBy("scale", "cells").agg(F.avg(F.abs(F.col("actual") - F.col("scale") * F.col("implied")) / F.col("actual")).alias("mape"))
    return e.select(F.round("scale", 6).alias("scale"), "cells", F.round("mape", 6).alias("mape"))


def demand(households: DataFrame, spend: DataFrame, by: str, brackets: int) -> DataFrame:
    """Households by bracket times mean spend, for places with every bracket; indexed to the mean of all."""
    g = households.join(spend, "bracket").groupBy(by).agg(F.sum(F.col("households") * F.col("spend")).alias("demand"), F.sum("households").alias("households"), F.count_distinct("bracket").alias("n")).filter(F.col("n") == brackets)
    total = g.agg((F.sum("demand") / F.sum("households")).alias("us"))
    per = F.col("demand") / F.col("households")
    return g.join(F.broadcast(total)).select(by, F.round("demand", 2).alias("demand"), F.round(per, 4).alias("per_household"), F.round(100 * per / F.col("us"), 2).alias("index"))


def whitespace(places: DataFrame, area: str, demand_col: str, doors: str, floor: int = 1) -> DataFrame:
    """Demand a door against the upper median of its metro; the higher, the more is not served."""
    per = places.filter(F.col(doors) >= floor).withColumn("per_door", F.col(demand_col) / F.col(doors))
    # The upper median is the value at which the running count first exceeds half; counts are by value, not by place.
    counted = per.groupBy(area, "per_door").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(area)
    placed = counted.withColumns({"_upto": F.sum("_n").over(w.orderBy("per_door")), "_all": F.sum("_n").over(w)})
    upper = placed.filter(F.col("_upto") > F.floor(F.col("_all") / 2)).groupBy(area).agg(F.min("per_door").alias("typical"))
    return per.join(upper, area).withColumn("index", F.round(100 * F.col("per_door") / F.col("typical"), 2))


def fact_build(rows: DataFrame, outlet: str, refs: list[tuple[str, str]], day: str, measures: dict[str, str]) -> DataFrame:
    """Facts at (outlet, product reference, grain, day): the first present reference decides the grain."""
    ref, grain = F.coalesce(*[F.when(present(c), F.col(c).cast("string")) for c, _ in refs]), None
    for c, g in refs:
        grain = F.when(present(c), g) if grain is None else grain.when(present(c), g)
    agg = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}
    return rows.groupBy(F.col(outlet).alias("outlet"), ref.alias("product_ref"), grain.alias("grain"), F.col(day).alias("obs_date")).agg(*[F.round(agg[how](c), 4).alias(c) for c, how in measures.items()])


def territories(rows: DataFrame, groups: dict[str, Column]) -> DataFrame:
    """Members of rule-based groups; a row may be in several."""
    held = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in groups.items()]))
    return rows.withColumn("territory", F.explode(held))
