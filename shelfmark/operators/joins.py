"""Joins that Spark has no operator for, as equi-joins with a residual, windows or grids."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.working import write_table


def asof(left: DataFrame, right: DataFrame, by: list[str], on: str, effective: str, carried: list[str]) -> DataFrame:
    """Each left row with the latest right row of the same keys that is not later: one sort, no pairs. A left row without a
    time has none, and neither has one with a null key.

    Both sides are stacked, dealt by ranges of key and time, and the last right row is carried forward within each range.
    A key of very many rows lies in several ranges; what a range's first key had at the end of the ranges before, one row a
    range, is carried into it."""
    kept = [f"r_{c}" for c in (effective, *carried)]
    empty = [F.lit(None).cast(right.schema[c].dataType).alias(f"r_{c}") for c in (effective, *carried)]
    l = left.withColumns({"_at": F.col(on), "_side": F.lit(1)}).select("*", *empty)
    r = right.dropna(subset=[*by, effective]).select(*by, F.col(effective).alias("_at"), F.lit(0).alias("_side"), *[F.col(c).alias(f"r_{c}") for c in (effective, *carried)])
    stacked = ranged(l.unionByName(r, allowMissingColumns=True), *by, "_at", "_side")
    w = Window.partitionBy("_part", *by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.when(F.col("_side") == 0, F.struct(*kept))
    both = stacked.withColumn("_held", F.last(held, ignorenulls=True).over(w))
    # A range's first key, and the last right row of its last key.
    key = F.struct(*by)
    ends = stacked.groupBy("_part").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    tails = stacked.filter("_side = 0").join(F.broadcast(ends.select("_part", "_last")), "_part").filter(key == F.col("_last"))
    tails = tails.groupBy("_part", "_last").agg(F.max_by(F.struct(*kept), "_at").alias("_tail"))
    before = ends.select("_part", "_first").join(tails.select(F.col("_part").alias("_q"), F.col("_last").alias("_first"), "_tail"), "_first").filter("_q < _part")
    carry = before.groupBy("_part", "_first").agg(F.max_by("_tail", "_q").alias("_carry")).select("_part", *[F.col(f"_first.{c}").alias(c) for c in by], "_carry")  # a row a range
    told = both.filter("_side = 1").join(F.broadcast(carry), ["_part", *by], "left").withColumn("_held", F.when(F.col("_at").isNotNull(), F.coalesce("_held", "_carry")))
    return told.select(*left.columns, *[F.col(f"_held.r_{c}").alias(c) for c in (effective, *carried)])


def ranged(rows: DataFrame, *by: str | Column) -> DataFrame:
    """Rows in a written table, dealt by ranges of an order, each with the number of its range (_part), which grows with it."""
    return write_table(rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranges")


def asof_band(left: DataFrame, rates: DataFrame, by: list[str], on: str, effective: str, value: str, low: str, high: str) -> DataFrame:
    """As-of within a band: of the rates whose band holds the value, the latest that is not later, and of equally late ones the
    greatest by its other columns.

    The ends of a key's bands cut its values into pieces, and a rate is repeated for each piece of its band; a row has one
    piece, so key and piece are the keys of a plain as-of join, and no row meets all rates of its key. Rates are a reference
    table: the pieces of one key are as many as its different ends."""
    extra = [c for c in rates.columns if c not in by]
    known = rates.filter(F.col(low).isNotNull() & F.col(high).isNotNull())
    cuts = known.groupBy(*by).agg(F.array_sort(F.array_union(F.collect_set(F.col(low).cast("double")), F.collect_set(F.col(high).cast("double")))).alias("_cuts"))
    piece = lambda v: F.size(F.filter("_cuts", lambda c: c <= v))
    pieces = F.explode(F.sequence(piece(F.col(low).cast("double")), piece(F.col(high).cast("double")) - 1))
    banded = known.filter(F.col(low) < F.col(high)).join(cuts, by).withColumn("_piece", pieces)
    best = F.max(F.struct(*[c for c in extra if c != effective], F.lit(0).alias("_")))
    one = banded.groupBy(*by, "_piece", effective).agg(best.alias("_b")).select(*by, "_piece", effective, *[F.col(f"_b.{c}").alias(c) for c in extra if c != effective])
    placed = left.join(cuts, by, "left").withColumn("_piece", F.when(F.col(value).isNotNull(), piece(F.col(value).cast("double"))))
    return asof(placed.drop("_cuts"), one, [*by, "_piece"], on, effective, [c for c in extra if c != effective]).select(*left.columns, *extra)


def upsert(existing: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The batch replaces rows of its keys. A null in a key equals a null and nothing else, so that a row with an empty
    key stays when a row without one comes in. Rows of the batch that share a key all come in, as in a plain append:
    `last_of_key` leaves one."""
    keys = batch.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return existing.join(keys, same, "left_anti").unionByName(batch, allowMissingColumns=True)


def last_of_key(batch: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row of each key: that which comes last in the order, and of equal ones the greatest by its other columns. The
    aggregate keeps one row a key in each task before it shuffles, so a key that repeats often moves no more than another."""
    rest = [c for c in batch.columns if c not in key]
    # Maps have no order; their text has.
    ordered = [F.to_json(c).alias(c) if batch.schema[c].dataType.typeName() == "map" else F.col(c) for c in rest]
    rank = F.struct(*[o.alias(f"_o{k}") for k, o in enumerate(order)], *ordered, F.lit(0).alias("_"))
    kept = batch.groupBy(*key).agg(F.max_by(F.struct(*rest, F.lit(0).alias("_")), rank).alias("_last"))
    return kept.select(*[F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in batch.columns])


def probe(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """How many of the left side's distinct keys the right side holds: what a join would find."""
    l = left.select(*[F.col(a).alias(f"k{i}") for i, (a, _) in enumerate(on)]).distinct()
    r = right.select(*[F.col(b).alias(f"k{i}") for i, (_, b) in enumerate(on)]).distinct().withColumn("_hit", F.lit(1))
    j = l.join(r, [f"k{i}" for i in range(len(on))], "left")
    return j.agg(F.count(F.lit(1)).alias("keys"), F.count("_hit").alias("matched")).withColumn("rate", F.round(F.try_divide(F.col("matched").cast("double"), F.col("keys").cast("double")), 4))


def best_method(candidates: list[tuple[int, DataFrame]], key: list[str], target: str) -> DataFrame:
    """Several ways to resolve a key: the best way wins; one that names several targets for a key names none."""
    stacked = None
    for priority, frame in candidates:
        unique = frame.groupBy(*key).agg(F.min(target).alias(target), F.count_distinct(target).alias("_n")).filter("_n = 1").drop("_n")
        one = unique.withColumn("method", F.lit(priority))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked.groupBy(*key).agg(F.min(F.struct("method", target)).alias("b")).select(*key, "b.method", f"b.{target}")


def cascade(rows: DataFrame, tiers: list[tuple[str, DataFrame, list[str]]], target: str) -> DataFrame:
    """Lookups tried in order; the first hit gives the target and its tier. Each lookup has one row a key."""
    out = rows.withColumns({"_t": F.lit(None).cast("string"), "tier": F.lit(None).cast("string")})
    for name, lookup, on in tiers:
        found = lookup.select(*on, F.col(target).cast("string").alias("_hit"))
        out = out.join(found, on, "left")
        out = out.withColumn("tier", F.when(F.col("_t").isNull() & F.col("_hit").isNotNull(), F.lit(name)).otherwise(F.col("tier")))
        out = out.withColumn("_t", F.coalesce("_t", "_hit")).drop("_hit")
    return out.withColumn("tier", F.coalesce("tier", F.lit("unmatched"))).withColumnRenamed("_t", target)


#: Anchors up to this many are broadcast; more meet points in grid cells.
BROADCAST_ANCHORS = 200
#: Fewer miles than a degree of latitude has anywhere.
DEGREE_MILES = 68.0


def nearest(points: DataFrame, anchors: DataFrame, distance: Column, keys: list[str], name: str, cell: float = 0.5, most: int = BROADCAST_ANCHORS) -> DataFrame:
    """The nearest anchor (name, a_lat, a_lng) of each point (keys, lat, lng) by a distance in miles; of equally near ones
    the first by name. No point is lost: one without a place, or without any anchor, has none.

    Few anchors are broadcast. More meet points in cells of a grid and their neighbours; a point whose best hit may not be
    the nearest, as it lies further off than the neighbours reach for certain, goes on to cells twice as wide."""
    best = F.min(F.when(distance.isNotNull(), F.struct(F.round(distance, 6).alias("miles"), F.col(name))))
    if anchors.limit(most + 1).count() <= most:
        found = points.join(F.broadcast(anchors), how="left").groupBy(*keys).agg(best.alias("b"))
        return found.select(*keys, f"b.{name}", "b.miles")
    left = write_table(points.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()), "points")
    done = [points.filter(F.col("lat").isNull() | F.col("lng").isNull()).select(*keys, F.lit(None).cast(anchors.schema[name].dataType).alias(name), F.lit(None).cast("double").alias("miles"))]
    while not left.isEmpty():
        whole = cell >= 360
        at = lambda c: F.floor((F.col(c) + 360) / cell)
        steps = F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x in (-1, 0, 1) for y in (-1, 0, 1)]))
        near = anchors.withColumn("_s", steps).withColumns({"_cx": at("a_lat") + F.col("_s.dx"), "_cy": at("a_lng") + F.col("_s.dy")}).drop("_s")
        met = left.withColumns({"_cx": at("lat"), "_cy": at("lng")}).join(near, ["_cx", "_cy"], "left")
        # A degree of longitude is shorter the nearer it lies to a pole; beyond the neighbours everything is this far off.
        sure = F.lit(cell * DEGREE_MILES) * F.cos(F.radians(F.least(F.abs("lat") + cell, F.lit(90.0))))
        hit = write_table(met.groupBy(*left.columns).agg(best.alias("b")).withColumn("_sure", F.lit(whole) | F.coalesce(F.col("b.miles") < sure, F.lit(False))), "nearest")
        done.append(hit.filter("_sure").select(*keys, f"b.{name}", "b.miles"))
        left = hit.filter("not _sure").select(*left.columns)
        cell *= 2
    return functools.reduce(DataFrame.unionByName, done)


def _inside(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Even-odd rule over all rings, so a hole is outside and an island in it inside; points on an edge count as inside."""
    out = np.zeros(len(x), bool)
    edge = np.zeros(len(x), bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, np.roll(ring, -1, 0)):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            edge |= (cross == 0) & (x >= min(x1, x2)) & (x <= max(x1, x2)) & (y >= min(y1, y2)) & (y <= max(y1, y2))
            if y1 != y2:
                hit = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
                out ^= hit
    return out | edge


#: Points of a cell that one task holds against one polygon; more are dealt to several.
CELL_POINTS = 100_000


def point_in_polygon(points: DataFrame, polygons: DataFrame, cell: float = 1.0) -> DataFrame:
    """Each point with the lowest code of the polygons that hold it, or null. points: id, x, y; polygons: code and rings (an
    array of rings, each an array of struct x, y, even-odd over all of them) or one ring. Polygons without rings hold nothing.

    Polygons are cut into the grid cells that their boxes touch, and places into cells; a place that many points share is
    looked at once. A cell's places meet its polygons in one task, as whole tables, so that a polygon is not repeated for each
    of them, and a cell of very many places is dealt to several tasks, each with the cell's polygons."""
    shapes = polygons.select("code", F.array("ring").alias("rings")) if "ring" in polygons.columns else polygons.select("code", "rings")
    shapes = shapes.filter(F.exists("rings", lambda r: F.size(r) > 0))
    every = F.flatten("rings")
    lo = lambda f, c: F.floor(f(F.transform(every, lambda p: p[c])) / cell)
    boxed = shapes.select(
        "code",
        "rings",
        F.explode(F.sequence(lo(F.array_min, "x"), lo(F.array_max, "x"))).alias("cx"),
        lo(F.array_min, "y").alias("y0"),
        lo(F.array_max, "y").alias("y1"),
    ).select("code", "rings", "cx", F.explode(F.sequence("y0", "y1")).alias("cy"))
    at = lambda c: F.floor(F.col(c) / cell)
    spots = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).select("x", "y").distinct().withColumns({"cx": at("x"), "cy": at("y")})
    # Few cells hold very many places; the others have one part.
    parts = spots.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / CELL_POINTS).cast("int").alias("parts"))
    dealt = spots.join(parts, ["cx", "cy"]).withColumn("part", F.pmod(F.hash("x", "y"), "parts"))
    shown = boxed.join(parts, ["cx", "cy"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def run(key: tuple, places: pd.DataFrame, shapes: pd.DataFrame) -> pd.DataFrame:
        x, y = places["x"].to_numpy(), places["y"].to_numpy()
        best = np.full(len(x), None, object)
        for code, rings in shapes.sort_values("code", ascending=False)[["code", "rings"]].itertuples(index=False):
            best[_inside(x, y, [np.array([(p["x"], p["y"]) for p in ring], float) for ring in rings if len(ring)])] = code
        return pd.DataFrame({"x": x, "y": y, "code": best})

    by = ["cx", "cy", "part"]
    shown = shown.select(*by, "code", "rings").toDF(*by, "code", "rings")  # columns of their own
    held = dealt.groupBy(*by).cogroup(shown.groupBy(*by)).applyInPandas(run, "x double, y double, code string").filter("code is not null")
    kept = [c for c in points.columns if c != "code"]
    return points.select(*kept).join(held, ["x", "y"], "left").select(*kept, "code")
