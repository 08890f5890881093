"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 48-bit hash of its id and text. A source takes whole repeats of itself and, for the rest of
its target, the documents whose hash lies below a threshold. Thresholds come from histograms: words are summed by
source and hash bucket, the running sum finds the bucket in which the budget ends, and only that bucket is summed
again, by the next bits of the hash, until it holds one hash. A document that is longer than what is left there is
passed over and the search goes on behind it, among documents that fit, so that a long document at the threshold
does not leave a source short. Rows that repeat share a hash; where the budget ends among them, as many of them are taken
as fit. Documents are then filtered by their source's few hash ranges; nothing is sorted but what differs among such rows.

Buckets are partial sums, so a source with a third of all rows shuffles no more than any other. What is known of
sources (size, weight, target, where its search stands, its ranges) are tables of one row a source that Spark holds,
however many there are; the driver holds sums over all of them.

Defined cases: a null text has no words; a null source is a source of its own, the last; of rows that repeat with
equal id and text and differ in other columns those that come first in these columns' order are taken; an empty table
gives an empty result; columns of the input that clash with the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, write_table

HASH_BITS = 48
LEVEL_BITS = 12
MAX_REPEATS = 3
#: Tables of one row a source are broadcast up to so many rows, and joined by shuffle beyond.
BROADCAST_SOURCES = 100_000
#: Rows that one list is unrolled to at a time, where rows repeat.
UNROLL = 4096


def _bounded(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows < BROADCAST_SOURCES else table


def weighed(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds weight to (_source, source_size): by place in the order of sources, null last, weights repeating. Sources are
    numbered within ranges of names and on from range to range, so that no task has all of them."""
    by = [F.col("_source").isNull(), F.col("_source")]
    ranged = write_table(sizes.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "mix-ranges")
    before, offsets = 0, {}
    for r in ranged.groupBy("_part").count().orderBy("_part").collect():  # as many rows as ranges
        offsets[r["_part"]], before = before, before + r["count"]
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*by)) - 1
    offset = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])[F.col("_part")] if offsets else F.lit(0)
    table = F.array(*[F.lit(float(w)) for w in weights])
    return ranged.withColumn("weight", F.get(table, F.pmod(offset + place, F.lit(len(weights))).cast("int"))).drop("_part")


def water_level(sources: DataFrame, total: float | None, cap: float) -> float | None:
    """Words a unit of weight, once what lies above cap times a source's size has gone to the others; None if all stop."""
    over, level = -1, None
    while True:
        stops = F.lit(False) if level is None else F.col("weight") * level > cap * F.col("source_size")
        r = sources.agg(
            F.sum("source_size").alias("all"),
            F.count_if(stops).alias("over"),
            F.sum(F.when(stops, cap * F.col("source_size"))).alias("stopped"),
            F.sum(F.when(~stops, F.col("weight"))).alias("open"),
        ).first()
        if not r["open"]:
            return None
        if r["over"] == over:
            return level
        over, level = r["over"], ((r["all"] if total is None else total) - (r["stopped"] or 0.0)) / r["open"]


def _hash48(id_col: str, text_col: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col)), 64 - HASH_BITS)


def _find(hashed: DataFrame, sources: DataFrame, tolerance: float) -> DataFrame:
    """_name, ranges (lo, hi, cap: hashes and largest size) whose documents fill each source's budget from below, and parts
    (h, copies: of rows that share the hash so many are taken).

    A row a source says where its search stands: it began at `start` with documents of at most `cap` words, has come to
    the bucket of `bits` bits at `lo`, and has `left` to fill. Each turn sums the next finer buckets of all searches."""
    state = sources.filter("budget > 0").selectExpr(
        "_name", "budget", "0L as start", "budget as cap", "0L as lo", f"{HASH_BITS} as bits", "budget as left"
    )
    state = write_table(state, "mix-search")
    searches = state.count()
    found = sources.select("_name", *[F.lit(None).cast("long").alias(c) for c in ("lo", "hi", "cap")]).limit(0)
    parts = sources.select("_name", *[F.lit(None).cast("long").alias(c) for c in ("h", "copies")]).limit(0)
    while searches:
        finer = F.greatest(F.col("bits") - LEVEL_BITS, F.lit(0))
        inside = (
            hashed.join(_bounded(state, searches), F.col("_source").eqNullSafe(F.col("_name")))
            .filter("shiftright(h, bits) = shiftright(lo, bits) and h >= start and size <= cap and size > 0")
            .groupBy("_name", "left", F.call_function("shiftright", "h", finer).alias("b"))
            .agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"), F.max("size").alias("most"))
        )
        running = inside.withColumn("upto", F.expr("sum(words) over (partition by _name order by b)"))
        over = running.groupBy(F.col("_name").alias("_same")).agg(
            F.coalesce(F.max(F.expr("if(upto <= left, upto, 0)")), F.lit(0)).alias("taken"),
            F.min(F.expr("if(upto > left, struct(b, words, lo, hi, most), null)")).alias("at"),
        )
        turned = (
            state.join(over, F.col("_name").eqNullSafe(F.col("_same")), "left")
            .withColumns({"rest": F.col("left") - F.coalesce("taken", F.lit(0)), "one": F.expr("at is not null and at.lo = at.hi"), "finer": finer})
            .withColumn("copies", F.expr("if(one, rest div at.most, 0)"))
            .withColumn("rest", F.expr("rest - if(one, copies * at.most, 0)"))
            .selectExpr(
                "_name", "budget", "start", "cap", "rest", "one", "finer", "copies", "at.b as b", "at.lo as first",
                "case when at is null then shiftleft(shiftright(lo, bits) + 1, bits) when one then at.lo end as stop",
                f"at is null or one and rest <= {tolerance!r} * budget as done",
            )
        )
        turned = write_table(turned, "mix-search")
        found = found.unionByName(turned.filter("start < stop").selectExpr("_name", "start as lo", "stop as hi", "cap"))
        parts = parts.unionByName(turned.filter("copies > 0").selectExpr("_name", "first as h", "copies"))
        # A document that does not fit is passed over and the search goes on behind it, among those that do.
        state = turned.filter("not done").selectExpr(
            "_name", "budget", "if(one, first + 1, start) as start", "if(one, rest, cap) as cap",
            "if(one, first + 1, shiftleft(b, finer)) as lo", f"if(one, {HASH_BITS}, finer) as bits", "rest as left",
        )
        searches = state.count()
    ranges = found.groupBy("_name").agg(F.collect_list(F.struct("lo", "hi", "cap")).alias("ranges"))
    some = parts.groupBy(F.col("_name").alias("_same")).agg(F.collect_list(F.struct("h", "copies")).alias("parts"))
    both = ranges.join(some, F.col("_name").eqNullSafe(F.col("_same")), "full")
    return both.select(F.when(F.col("ranges").isNull(), F.col("_same")).otherwise(F.col("_name")).alias("_name"), "ranges", "parts")


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """All columns, then _source, size and hash."""
    return docs.withColumns(
        {
            "_source": F.col(source_col).cast("string"),
            "size": F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"),
            "hash": _hash48(id_col, text_col),
        }
    )


def plan(
    hashed: DataFrame, weights: tuple[float, ...] = (1, 2, 3), total: float | None = None, tolerance: float = 0.0005, cap: float = MAX_REPEATS
) -> tuple[DataFrame, int]:
    """One row a source: _name, source_size, target, whole (repeats of every document), ranges (of hashes taken once
    more), parts (hashes of which some rows are taken once more); and their number. hashed has _source, size and h, and is read once for each level of a search, so it should
    be a written table."""
    sizes = hashed.groupBy("_source").agg(F.sum("size").alias("source_size"))
    sources = write_table(weighed(sizes, weights), "mix-sources")
    level = water_level(sources, total, cap)
    most = cap * F.col("source_size")
    target = most if level is None else F.least(F.col("weight") * level, most)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(MAX_REPEATS), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    budget = F.when(F.col("whole") == MAX_REPEATS, 0).otherwise(F.greatest(F.lit(0), F.bround(F.col("target") - F.col("whole") * F.col("source_size")))).cast("long")
    goals = sources.withColumn("target", target.cast("double")).withColumn("whole", whole).withColumn("budget", budget).withColumnRenamed("_source", "_name")
    found = _find(hashed, goals, tolerance)
    planned = goals.join(found.withColumnRenamed("_name", "_same"), F.col("_name").eqNullSafe(F.col("_same")), "left")
    none = F.array().cast("array<struct<lo: bigint, hi: bigint, cap: bigint>>")
    no_parts = F.array().cast("array<struct<h: bigint, copies: bigint>>")
    planned = write_table(planned.select("_name", "source_size", "target", "whole", F.coalesce("ranges", none).alias("ranges"), F.coalesce("parts", no_parts).alias("parts")), "mix-plan")
    return planned, planned.count()


def _some(rows: DataFrame) -> DataFrame:
    """Of rows that share a source and a hash the first _copies in the order of their columns get _more 1, the others 0.
    Equal rows are counted, so the window holds only what differs."""
    names = [c for c in rows.columns if c != "_copies"]
    each = rows.groupBy(*names, "_copies").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_name", "hash").orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = each.withColumn("_left", F.col("_copies") - (upto - F.col("_n")))
    runs = each.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {UNROLL}"))))
    places = F.sequence(F.col("_run") * UNROLL, F.least((F.col("_run") + 1) * UNROLL, F.col("_n")) - 1)
    return runs.withColumn("_place", F.explode(places)).select(*names, (F.col("_place") < F.col("_left")).cast("int").alias("_more"))


def apply(measured: DataFrame, planned: DataFrame, sources: int) -> DataFrame:
    """Adds source_size, target and taken (words, repeats counted) to documents with _source, size and hash."""
    joined = measured.join(_bounded(planned, sources), F.col("_source").eqNullSafe(F.col("_name")))
    chosen = F.exists("ranges", lambda r: (F.col("hash") >= r["lo"]) & (F.col("hash") < r["hi"]) & (F.col("size") <= r["cap"]))
    copies = F.get(F.filter("parts", lambda p: p["h"] == F.col("hash")), F.lit(0))["copies"]
    told = joined.withColumns({"_more": chosen.cast("int"), "_copies": copies})
    kept = [c for c in told.columns if c not in ("ranges", "parts", "_copies", "_more")]
    out = told.filter("_copies is null").select(*kept, "_more")
    if not planned.filter("size(parts) > 0").isEmpty():
        # A hash at which a budget ended: it is in no range, as its rows were passed over.
        out = out.unionByName(_some(told.filter("_copies is not null").select(*kept, "_copies")))
    return out.withColumn("taken", F.col("size") * (F.col("whole") + F.col("_more"))).drop("_name", "_source", "_more", "whole")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    total: float | None = None,
    tolerance: float = 0.0005,
    texts: bool = False,
) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, hash, taken (words, repeats counted).

    One pass over texts counts words and writes (id, source, size, hash), which all later steps read. With texts the
    result has all columns of the input instead of the id and the source, at the price of a second pass over it.
    """
    new = ("size", "hash", "source_size", "target", "taken")
    measured = _measured(docs.drop(*[c for c in new if c in docs.columns]), id_col, text_col, source_col)
    written = write_table(measured.select(F.col(id_col).alias("doc_id"), "_source", "size", "hash"), "mix-sizes")
    planned, sources = plan(written.select("_source", "size", F.col("hash").alias("h")), weights, total, tolerance)
    if texts:
        return apply(measured, planned, sources)
    return apply(written.withColumn("source", F.col("_source")), planned, sources)
