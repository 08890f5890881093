"""Reports over masters, outlets and coverage: rates, ratios, shares, verdicts, and checks of measures and columns."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import present
from . import checks as checks_of
from .windows import numbered


def chain(levels: list[tuple[DataFrame, str]], leaf: DataFrame, first: str) -> DataFrame:
    """A leaf joined to its parents, level by level: each level's table and the key by which the one below names it."""
    out = leaf
    for parent, key in levels:
        out = out.join(parent, key, "left")
    return out.filter(present(first))


def near_namesakes(rows: DataFrame, id_col: str, name: str, lat: str, lng: str, distance, miles: float, least: float, cell: float) -> DataFrame:
    """Pairs (the smaller id first) of points within some miles whose names are alike, in the same grid cell or neighbours.

    One side of each pair goes to the nine cells around it; cells must be wider than the distance."""
    at = lambda c: F.floor(F.col(c) / cell)
    steps = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in itertools.product((-1, 0, 1), repeat=2)]))
    one = rows.select(F.col(id_col).alias("a"), F.col(name).alias("name_a"), F.col(lat).alias("lat_a"), F.col(lng).alias("lng_a"), at(lat).alias("_x"), at(lng).alias("_y"))
    other = rows.withColumn("_s", steps).select(F.col(id_col).alias("b"), F.col(name).alias("name_b"), F.col(lat).alias("lat_b"), F.col(lng).alias("lng_b"), (at(lat) + F.col("_s.x")).alias("_x"), (at(lng) + F.col("_s.y")).alias("_y"))
    met = one.join(other, ["_x", "_y"]).filter(F.col("a") < F.col("b")).withColumn("miles", F.round(distance(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b")), 6))
    return met.filter(F.col("miles") <= miles).withColumn("similarity", F.round(text.jaro_winkler("name_a", "name_b"), 6)).filter(F.col("similarity") >= least).select("a", "b", "miles", "similarity")


def fan_out(rows: DataFrame, on: list[str], resolve) -> DataFrame:
    """What `resolve` finds for distinct values of some columns, joined back; every row stays, nulls too."""
    found = resolve(rows.select(*on).distinct()).withColumnsRenamed({c: f"_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    return rows.join(found, same, "left").drop(*[f"_{c}" for c in on])


def centroid_fill(rows: DataFrame, by: list[str], lat: str, lng: str) -> DataFrame:
    """Missing coordinates from the centre of their place's known ones; `filled` marks them."""
    centres = rows.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull()).groupBy(*by).agg(F.round(F.avg(lat), 6).alias("_lat"), F.round(F.avg(lng), 6).alias("_lng"))
    lacks = F.col(lat).isNull() | F.col(lng).isNull()
    met = rows.join(centres, by, "left").withColumn("filled", lacks & F.col("_lat").isNotNull())
    return met.withColumns({lat: F.when(F.col("filled"), F.col("_lat")).otherwise(F.col(lat)), lng: F.when(F.col("filled"), F.col("_lng")).otherwise(F.col(lng))}).drop("_lat", "_lng")


def per_household(outlets: DataFrame, households: DataFrame, by: str) -> DataFrame:
    """Outlets of each metro, and for a thousand of its households; metros without any of either are there."""
    n = outlets.groupBy(by).agg(F.count(F.lit(1)).alias("outlets"))
    h = households.groupBy(by).agg(F.sum("households").alias("households"))
    return n.join(h, by, "full").select(by, F.coalesce("outlets", F.lit(0)).alias("outlets"), "households", F.round(F.try_divide(1000 * F.coalesce("outlets", F.lit(0)), F.col("households")), 4).alias("per_1000"))


def coverage(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(present(c)).alias(f"with_{c}") for c in columns])


def coverage_verdict(log: DataFrame, table: str, at: str, rows: str, least: float = 0.95) -> DataFrame:
    """Of each table's log: its high-water mark and last run, complete if that kept enough of the mark, baseline if it is the first."""
    last = F.max_by(rows, at)
    g = log.groupBy(table).agg(F.max(rows).alias("high_water"), last.alias("last_rows"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("runs"))
    return g.withColumn("verdict", F.when(F.col("runs") == 1, "baseline").when(F.col("last_rows") >= least * F.col("high_water"), "complete").otherwise("partial"))


def on_latest(rows: DataFrame, at: str, by: str) -> DataFrame:
    """Rows a key on the table's latest day."""
    latest = rows.agg(F.max(at).alias("_latest"))  # one row
    return rows.join(F.broadcast(latest), F.col(at) == F.col("_latest")).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def chain_rollup(rows: DataFrame, known: DataFrame, by: str, key: str, flag: Column) -> DataFrame:
    """Rows of each chain, those that hold a condition, and orphans: rows whose key the master lacks."""
    k = known.select(key).distinct().withColumn("_known", F.lit(True))
    return rows.withColumn("_flag", flag).join(k, key, "left").groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count_if("_flag").alias("flagged"), F.count_if(F.col("_known").isNull()).alias("orphans"))


def top_shares(rows: DataFrame, by: list[str], member: str, k: int = 3) -> DataFrame:
    n = rows.groupBy(*by, member).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by)
    ranked = n.withColumns({"share": F.round(F.col("n") / F.sum("n").over(w), 4), "place": F.row_number().over(w.orderBy(F.desc("n"), member))})
    return ranked.filter(F.col("place") <= k)


def tier_rates(matched: DataFrame, tier: str, why: str) -> DataFrame:
    """Rows and share of each tier, those without a match by why."""
    n = matched.groupBy(tier, F.when(F.col(tier) == "unmatched", F.col(why)).alias("why")).agg(F.count(F.lit(1)).alias("n"))
    total = matched.agg(F.count(F.lit(1)).alias("_all"))  # one row
    return n.join(F.broadcast(total)).select(tier, "why", "n", F.round(F.col("n") / F.col("_all"), 4).alias("rate"))


def empties_last(rows: DataFrame, column: str, key: str) -> DataFrame:
    return numbered(rows, F.struct((~present(column)).alias("e"), F.col(column), F.col(key)), name="place")


def core_key(name: Column, drop: tuple[str, ...]) -> Column:
    """A name's words without those to drop and without numbers, in order and once each."""
    return F.array_join(F.filter(text.tokens(name), lambda t: ~t.isin(*drop) & ~t.rlike("^[0-9]+$")), " ")


def trailing(days: DataFrame, by: list[str], day: str, value: str, length: int) -> DataFrame:
    """The sum and mean of each key over the days up to and with each of its days."""
    w = Window.partitionBy(*by).orderBy(F.unix_date(day)).rangeBetween(1 - length, 0)
    return days.withColumns({"trailing_sum": F.round(F.sum(value).over(w), 4), "trailing_mean": F.round(F.avg(value).over(w), 6)})


#: Decades between two clusters of one measure that tell of mixed units, and how many values it takes to say so.
SCALE_GAP, SCALE_ROWS = 1.7, 30


def measure_checks(rows: DataFrame, column: str, percent: bool = False) -> DataFrame:
    """check, hits, share, failed of a column that should be a measure: values of another type, negatives, percentages above
    100, one capping or sentinel value at an end (15 %), a band of 2 % below the largest (15 %), nulls (20 %), zeros (30 %), and
    two clusters of values some fifty times apart (5 % in the smaller), as of mixed units or a lost decimal."""
    x = F.col(column).try_cast("double")
    filled = present(column)
    r = rows.agg(F.max(x).alias("hi"), F.min(x).alias("lo"))  # one row
    v = rows.select(x.alias("x"), filled.alias("filled")).join(F.broadcast(r))
    n, held = F.count(F.lit(1)), F.count("x")
    checks = {
        "type": (F.count_if(F.col("filled") & F.col("x").isNull()), F.count_if("filled"), 0.0),
        "negative": (F.count_if(F.col("x") < 0), held, 0.0),
        "percent": (F.count_if((F.col("x") > 100) & F.lit(percent)), held, 0.0),
        "cap": (F.count_if(F.col("x") == F.col("hi")), held, 0.15),
        "floor": (F.count_if(F.col("x") == F.col("lo")), held, 0.15),
        "cap_band": (F.count_if((F.col("x") >= F.col("hi") - 0.02 * F.abs("hi")) & (F.col("x") < F.col("hi"))), held, 0.15),
        "nulls": (n - F.count_if("filled"), n, 0.2),
        "zeros": (F.count_if(F.col("x") == 0), held, 0.3),
    }
    cells = [F.struct(F.lit(k).alias("check"), hits.alias("hits"), of.alias("of"), F.lit(bar).alias("bar")) for k, (hits, of, bar) in checks.items()]
    out = v.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    gap = checks_of.scale_gap(rows.select(x.alias("x")), "x")
    apart = (F.col("gap") >= SCALE_GAP) & (F.col("n") >= SCALE_ROWS)
    out = out.unionByName(gap.select(F.lit("scale").alias("check"), F.when(apart, F.least("below", F.col("n") - F.col("below"))).otherwise(0).alias("hits"), F.col("n").alias("of"), F.lit(0.05).alias("bar")))
    share = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("of").cast("double")), F.lit(0.0))
    return out.select("check", "hits", F.round(share, 4).alias("share"), ((F.col("hits") > 0) & (share >= F.col("bar"))).alias("failed"))


def covariation(rows: DataFrame, columns: list[str], least: float = 1.0) -> DataFrame:
    """a, b, kind of pairs of columns: mirror where they are equal in every row, one_to_one where each value of one stands
    with one value of the other. Distinct pairs are counted before their sides."""
    out = None
    for a, b in itertools.combinations(columns, 2):
        p = rows.groupBy(F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).agg(F.count(F.lit(1)).alias("n"))
        one = p.agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("x").alias("xs"), F.count_distinct("y").alias("ys"), F.sum(F.when(F.col("x").eqNullSafe(F.col("y")), F.col("n")).otherwise(0)).alias("same"), F.sum("n").alias("n"))
        kind = F.when(F.col("same") >= least * F.col("n"), "mirror").when((F.col("pairs") == F.col("xs")) & (F.col("pairs") == F.col("ys")) & (F.col("pairs") > 1), "one_to_one")
        one = one.select(F.lit(a).alias("a"), F.lit(b).alias("b"), kind.alias("kind")).filter("kind is not null")
        out = one if out is None else out.unionByName(one)
    return out
