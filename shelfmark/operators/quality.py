"""Data quality: profiles, duplicates, keys, dependencies, fragmentation, drift, detectors, states."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import gs1, text
from ..sources.working import spread

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profile(df: DataFrame) -> DataFrame:
    """One row a column: type, nulls, blanks, distinct values, zeros, negatives, range; all in one pass over the table."""
    aggs, kinds = [F.count(F.lit(1)).alias("rows")], dict(df.dtypes)
    for c, kind in kinds.items():
        v, number = F.col(c), kind in _NUMERIC or kind.startswith("decimal")
        none = F.lit(None)
        aggs += [
            F.struct(
                F.lit(c).alias("column"), F.lit(kind).alias("type"), F.count_if(v.isNull()).alias("nulls"), F.count_if(v.cast("string") == "").alias("blanks"),
                F.count_distinct(v).alias("distinct"), (F.count_if(v == 0) if number else none.cast("long")).alias("zeros"), (F.count_if(v < 0) if number else none.cast("long")).alias("negatives"),
                F.min(v.cast("double") if number else none.cast("double")).alias("least"), F.max(v.cast("double") if number else none.cast("double")).alias("largest"),
            ).alias(f"_{c}")
        ]
    one = spread(df).agg(*aggs)  # distinct values are collected by tasks of so many rows
    return one.select("rows", F.explode(F.array(*[f"_{c}" for c in kinds])).alias("p")).select("p.*", F.round(F.col("p.nulls") / F.col("rows"), 4).alias("null_rate"))


def top_values(df: DataFrame, columns: list[str], k: int = 8) -> DataFrame:
    """The k most frequent values of each column: counts first, ranks over counts."""
    from .windows import top_per_group

    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("e")).select("e.*")
    counts = long.filter("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, ["column"], k, F.desc("n"), F.col("value"))


def duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and the rate of exact copies."""
    n = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"))
    return n.withColumn("dup_rate", F.round(1 - F.col("distinct_rows") / F.col("rows"), 6))


def dependencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """For each ordered pair of columns whether the first decides the second, and by how many exceptions not."""
    out = None
    for a, b in itertools.permutations(columns, 2):
        g = df.filter(F.col(a).isNotNull()).groupBy(a).agg(F.count_distinct(b).alias("d"))
        one = g.agg(F.lit(a).alias("determinant"), F.lit(b).alias("dependent"), F.count(F.lit(1)).alias("groups"), F.count_if(F.col("d") > 1).alias("violations"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("holds", F.col("violations") == 0)


def candidate_keys(df: DataFrame, columns: list[str], least: float = 0.99) -> DataFrame:
    """Single columns and pairs with how nearly they identify rows; one pass, then those at or above the bar."""
    combos = [(c,) for c in columns] + list(itertools.combinations(columns, 2))
    aggs = [F.count_distinct(F.struct(*[F.coalesce(F.col(x).cast("string"), F.lit("\0")) for x in c])).alias(",".join(c)) for c in combos]
    one = spread(df.select(*columns)).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    listed = F.array(*[F.struct(F.lit(",".join(c)).alias("columns"), F.lit(len(c)).alias("width"), F.col(f"`{','.join(c)}`").alias("distinct")) for c in combos])
    keys = one.select("_rows", F.explode(listed).alias("k")).select("k.*", F.round(F.col("k.distinct") / F.col("_rows"), 6).alias("uniqueness"))
    return keys.filter(F.col("uniqueness") >= least)


def fragmentation(df: DataFrame, column: str) -> DataFrame:
    """Values that differ in case and white space alone."""
    folded = F.lower(F.trim(F.regexp_replace(column, r"\s+", " ")))
    return df.groupBy(folded.alias("folded")).agg(F.count_distinct(column).alias("spellings"), F.count(F.lit(1)).alias("n")).filter("spellings > 1")


def fill_drift(df: DataFrame, day: str, columns: list[str], baseline_days: int = 7, tolerance: float = 0.15) -> DataFrame:
    """Each day's fill rate by column against the median of the days before it."""
    from pyspark.sql import Window

    rates = df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"), *[F.round(F.count_if(text.present(c)) / F.count(F.lit(1)), 6).alias(c) for c in columns])
    long = rates.select(day, "rows", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rate")) for c in columns])).alias("e")).select(day, "rows", "e.*")
    w = Window.partitionBy("column").orderBy(day).rowsBetween(-baseline_days, -1)
    based = long.withColumn("_r", F.array_sort(F.collect_list("rate").over(w)))
    n = F.size("_r")
    middle = (F.get("_r", F.floor((n - 1) / 2).cast("int")) + F.get("_r", F.floor(n / 2).cast("int"))) / 2
    based = based.withColumn("baseline", F.round(middle, 6)).drop("_r")
    return based.withColumn("drifted", F.coalesce(F.col("rate") < F.col("baseline") - tolerance, F.lit(False)))


def sentinel(df: DataFrame, column: str, least: float = 0.15) -> DataFrame:
    """Values that stand in for missing ones: one value with a large share at the edge of the range."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ends = counts.agg(F.sum("n").alias("rows"), F.min(column).alias("lo"), F.max(column).alias("hi"))
    j = counts.join(F.broadcast(ends)).withColumn("share", F.round(F.col("n") / F.col("rows"), 4))
    return j.filter((F.col("share") >= least) & ((F.col(column) == F.col("lo")) | (F.col(column) == F.col("hi")))).select(F.col(column).alias("value"), "n", "share")


def code_scout(df: DataFrame, column: str) -> DataFrame:
    """Lengths of a code field, and how many of each carry a check digit, as they are or with a lost zero put back."""
    d = text.digits(F.col(column))
    return df.groupBy(F.length(d).alias("length")).agg(F.count(F.lit(1)).alias("n"), F.count_if(gs1.valid(d)).alias("valid"), F.count_if(gs1.valid(F.lpad(d, 12, "0"))).alias("valid_padded"), F.count_if(gs1.placeholder(d)).alias("placeholders"))


#: Detectors: each is one condition on a row; a finding counts the rows that meet it.
def detect(df: DataFrame, detectors: dict[str, Column], severity: dict[str, float] = {}) -> DataFrame:
    """All detectors in one pass; ranked by severity times the share of rows."""
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in detectors.items()])
    listed = F.array(*[F.struct(F.lit(n).alias("detector"), F.col(n).alias("hits"), F.lit(float(severity.get(n, 1.0))).alias("severity")) for n in detectors])
    found = one.select("rows", F.explode(listed).alias("e")).select("e.*", "rows")
    return found.withColumn("score", F.round(F.col("severity") * F.col("hits") / F.col("rows"), 6))


def stage_state(rows: Column, pending: Column, age_hours: Column, target: float) -> Column:
    return F.when(rows.isNull(), "unknown").when(rows == 0, "never").when((pending > 0) & (age_hours > target), "stalled").when(pending > 0, "waiting").when(age_hours <= target, "flowing").otherwise("idle")


def require_kept(before: int, after: int, least: float = 0.8) -> None:
    """Refuses a result that lost more rows than a build may lose."""
    if before and after < least * before:
        raise ValueError(f"kept {after} of {before} rows, less than {least:.0%}")
