"""Rollups that are kept: sketches by day and group, which later reads merge instead of going back to the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Catalog

#: Size of the sketches: distinct counts err by about a hundredth, ranks of quantiles by less.
DISTINCT_BITS = 13
QUANTILE_K = 400


def day_sketches(rows: DataFrame, by: list[str], value: str, distinct: str) -> DataFrame:
    """n, total, least, most, and mergeable sketches of the distinct ids and of the values of each group."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.hll_sketch_agg(distinct, F.lit(DISTINCT_BITS)).alias("ids"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_K)).alias("values"),
    )


def keep_days(catalog: Catalog, name: str, rows: DataFrame, day: str, by: list[str], value: str, distinct: str, days: list[str] | None = None) -> list[str]:
    """Adds one part a day to a kept rollup, from that day's rows only: days that have a part are left alone unless they are
    named. Gives the days that were made. A day's part is replaced whole, so a run that is repeated changes nothing."""
    have = set(catalog.parts(name))
    wanted = [r[0] for r in rows.select(F.col(day).cast("string")).distinct().orderBy(1).collect()] if days is None else days  # days
    made = [d for d in wanted if d is not None and (days is not None or d not in have)]
    for d in made:
        catalog.write_part(name, d, day_sketches(rows.filter(F.col(day).cast("string") == d), by, value, distinct))
    return made


def merged(kept: DataFrame, *by: str) -> DataFrame:
    """Groups of a kept rollup over its days, or over fewer keys: exact counts and sums, distinct ids and quartiles by sketch."""
    r = kept.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("ids"), F.kll_merge_agg_double("values").alias("_v"),
    )
    quartile = lambda p: F.kll_sketch_get_quantile_double("_v", F.lit(p))
    return r.select(*by, "n", "total", "least", "most", "ids", quartile(0.25).alias("p25"), quartile(0.5).alias("median"), quartile(0.75).alias("p75"))
