"""Names that are nearly one within a block: all pairs above a similarity, clusters of them, and pairs near the bar."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _jaro_winkler
from ..sources.working import write_table
from .entities import components

#: Names of a unit, which one task holds against another unit's.
UNIT = 1024
#: Tasks to which pairs of units are dealt.
MOST_TASKS = 4096
#: Similarity from which two names of a block are one, and from which that is sure.
MEDIUM, HIGH = 0.86, 0.92
#: Fixed value: members beyond which a cluster is looked at.
LARGE_CLUSTER = 20
#: Bits of a name's set of numbered letters.
_WORDS = 4


def _sketch(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bits of each name's letters, each numbered by its occurrence (so repeated letters count as often as both have them),
    its length, how many of its letters share a bit, and its first four letters."""
    bits = np.zeros((len(names), _WORDS), np.uint64)
    length = np.array([len(n) for n in names], np.int64)
    first = np.zeros((len(names), 4), np.int64)
    for k, name in enumerate(names):
        seen: dict[str, int] = {}
        for c in name:
            seen[c] = seen.get(c, 0) + 1
            at = (ord(c) * 7 + seen[c] * 61) % (64 * _WORDS)
            bits[k, at >> 6] |= np.uint64(1 << (at & 63))
        for j, c in enumerate(name[:4]):
            first[k, j] = ord(c)
    return bits, length, length - np.bitwise_count(bits).sum(axis=1), first


def _may_reach(a: tuple, b: tuple, least: float) -> np.ndarray:
    """Pairs whose similarity may reach the bar, by bounds that hold for Jaro-Winkler: matched letters are at most those in
    common, which are at most the common bits and what shares a bit; and the common start counts four letters at most."""
    (bits_a, len_a, slack_a, first_a), (bits_b, len_b, slack_b, first_b) = a, b
    common = sum(np.bitwise_count(bits_a[:, None, w] & bits_b[None, :, w]).astype(np.int64) for w in range(_WORDS))
    common = np.minimum(common + np.minimum(slack_a[:, None], slack_b[None]), np.minimum(len_a[:, None], len_b[None]))
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (common / len_a[:, None] + common / len_b[None] + 1) / 3
    same = (first_a[:, None, :] == first_b[None, :, :]) & (first_a[:, None, :] > 0)
    start = np.cumprod(same, axis=2).sum(axis=2)
    reach = np.where(jaro > 0.7, jaro + 0.1 * start * (1 - jaro), jaro)
    return (common > 0) & (reach >= least - 1e-9)


def _meet(least: float, below: float | None):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, y = left.sort_values("node"), right.sort_values("node")
        names = x["name"].tolist(), y["name"].tolist()
        sides = _sketch(names[0]), _sketch(names[1])
        ids = x["node"].tolist(), y["node"].tolist()
        asks = x["_q"].to_numpy(bool), y["_q"].to_numpy(bool)
        out = []
        for at in range(0, len(names[0]), 128):
            part = tuple(s[at : at + 128] for s in sides[0])
            wanted = asks[0][at : at + 128, None] | asks[1][None]
            if not wanted.any():
                continue
            for i, j in zip(*np.nonzero(wanted & _may_reach(part, sides[1], least))):
                u, v = at + int(i), int(j)
                if key[1] == key[2] and u >= v:
                    continue
                s = _jaro_winkler(names[0][u], names[1][v])
                if s >= least and (below is None or s < below):
                    out.append((*sorted((ids[0][u], ids[1][v])), s))
        return pd.DataFrame(out, columns=["a", "b", "s"])

    return run


def _blocks(rows: DataFrame, id_col: str, block: list[Column], name: str) -> DataFrame:
    """One node (its least id) for each name of a block, with how many rows have it. Empty names take no part."""
    keyed = rows.select(F.col(id_col).alias("id"), F.concat_ws("|", *block).alias("block"), F.col(name).cast("string").alias("name")).filter("name <> ''")
    return keyed.groupBy("block", "name").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("rows"))


def _spelled(unit: str) -> Column:
    """A unit's two numbers as text, alike on both sides."""
    return F.regexp_replace(F.col(unit).cast("string"), "[^0-9,]", "").alias(unit)


def alike_names(nodes: DataFrame, least: float = MEDIUM, below: float | None = None, unit: int = UNIT, asked: Column | None = None) -> DataFrame:
    """a, b (nodes, a < b), s of every two names of a block with a Jaro-Winkler similarity s of `least` or more (and less
    than `below`). nodes: block, name, node. With `asked`, only pairs of which a node that it is true of takes part.

    The result is that of all pairs, however large a block is. A block's names are dealt into units by length and hash, and
    two units whose lengths cannot reach the bar do not meet. Two that do are a task's work: bounds from the letters that
    names have in common leave few pairs to compare, and with `asked` only those of names that ask are compared. A large block
    is thus many tasks of one size."""
    shortest = 3 * max(0.0, (least - 0.4) / 0.6) - 2  # least ratio of two lengths, with the greatest common start
    held = nodes.withColumn("_q", F.lit(False) if asked is None else asked)
    sized = held.withColumn("_len", F.length("name"))
    # Lengths beside each other share a unit where names are few.
    per_length = sized.groupBy("block", "_len").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("block").orderBy("_len")) - F.col("_n")
    shelves = per_length.select("block", "_len", F.floor(upto / unit).cast("int").alias("_shelf"), "_n")
    shelf = shelves.groupBy("block", "_shelf").agg(F.min("_len").alias("_lo"), F.max("_len").alias("_hi"), F.ceil(F.sum("_n") / unit).cast("int").alias("_units"))
    units = write_table(shelf.withColumn("_u", F.explode(F.sequence(F.lit(0), F.col("_units") - 1))).select("block", "_shelf", "_u", "_lo", "_hi", "_units"), "units")
    x, y = (units.select("block", *[F.col(c).alias(f"{c}{s}") for c in ("_shelf", "_u", "_lo", "_hi")]) for s in ("1", "2"))
    place = lambda s: F.struct(f"_shelf{s}", f"_u{s}")
    fit = (place("1") <= place("2")) & (F.least("_hi1", "_hi2") >= F.lit(shortest) * F.greatest("_lo1", "_lo2"))
    pairs = x.join(y.toDF(*y.columns), "block").filter(fit).select("block", place("1").alias("u1"), place("2").alias("u2"))
    dealt = sized.join(shelves.drop("_n"), ["block", "_len"]).join(shelf.select("block", "_shelf", "_units"), ["block", "_shelf"])
    dealt = dealt.select("block", "name", "node", "_q", F.struct(F.col("_shelf"), F.pmod(F.xxhash64("name"), F.col("_units")).cast("int").alias("_u")).alias("unit"))
    dealt = write_table(dealt, "dealt-names")
    asking = None if asked is None else dealt.filter("_q").select("block", "unit").distinct()
    if asking is not None:  # unit pairs in which somebody asks
        q1, q2 = (asking.select("block", F.col("unit").alias(f"u{k}"), F.lit(True).alias(f"_q{k}")) for k in (1, 2))
        pairs = pairs.join(q1, ["block", "u1"], "left").join(q2, ["block", "u2"], "left").filter("_q1 or _q2").drop("_q1", "_q2")
    pairs = write_table(pairs, "unit-pairs")
    # Names are few bytes and their comparison long, so tasks are dealt by unit pairs, not by bytes.
    tasks = max(nodes.sparkSession.sparkContext.defaultParallelism, min(pairs.count(), MOST_TASKS))
    by = ["block", "u1", "u2"]
    left, right = (pairs.join(dealt.withColumnRenamed("unit", f"u{k}"), ["block", f"u{k}"]).select(*by, "name", "node", "_q") for k in (1, 2))
    kind = nodes.schema["node"].dataType.simpleString()
    # Names of their own for columns, as both sides come from the same table.
    flat = lambda d: d.select("block", _spelled("u1"), _spelled("u2"), "name", "node", F.lit(True) if asked is None else F.coalesce("_q", F.lit(False))).toDF(*by, "name", "node", "_q").repartition(tasks, *by)
    return flat(left).groupBy(*by).cogroup(flat(right).groupBy(*by)).applyInPandas(_meet(least, below), f"a {kind}, b {kind}, s double")



def name_clusters(rows: DataFrame, id_col: str, block: list[Column], name: str, medium: float = MEDIUM, high: float = HIGH, unit: int = UNIT) -> tuple[DataFrame, DataFrame]:
    """(members, clusters). members: id, cluster (the least id), match_confidence (the best similarity by which a row is held,
    1 for one alone or one whose name others share), matched_on. clusters: cluster, members, confidence (the least of its
    members'), flagged: a link below `high`, or many members. Rows without a name are clusters of their own."""
    nodes = write_table(_blocks(rows, id_col, block, name), "names")
    pairs = write_table(alike_names(nodes, medium, unit=unit), "alike")
    ends = pairs.select(F.col("a").alias("node"), "s").unionByName(pairs.select(F.col("b").alias("node"), "s"))
    best = ends.groupBy("node").agg(F.max("s").alias("s"), (F.min("s") < high).alias("loose"))
    found = components(pairs, "a", "b")
    each = nodes.join(best, "node", "left").join(found, "node", "left")
    keyed = rows.select(F.col(id_col).alias("id"), F.concat_ws("|", *block).alias("block"), F.col(name).cast("string").alias("name"))
    placed = keyed.join(each.select("block", "name", "node", "rows", "s", "loose", "component"), ["block", "name"], "left")
    sure = F.when(F.coalesce("rows", F.lit(1)) > 1, 1.0).otherwise(F.coalesce("s", F.lit(1.0)))
    members = write_table(placed.select("id", F.coalesce("component", "node", "id").alias("cluster"), F.round(sure, 4).alias("match_confidence"), F.coalesce("loose", F.lit(False)).alias("loose")), "members")
    clusters = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.min("match_confidence").alias("confidence"), (F.bool_or("loose") | (F.count(F.lit(1)) > LARGE_CLUSTER)).alias("flagged"))
    on = F.when(F.col("members") == 1, "singleton").when(F.col("match_confidence") >= high, "name").otherwise("fuzzy")
    told = members.join(clusters.select("cluster", "members"), "cluster").select(F.col("id").alias(id_col), "cluster", "match_confidence", on.alias("matched_on"))
    return told, clusters


def near_misses(rows: DataFrame, id_col: str, block: list[Column], name: str, least: float = 0.6, below: float = MEDIUM, stride: int = 20) -> DataFrame:
    """a, b, s of pairs below the bar but not far from it: a stratum of gold pairs, in which a rule's misses lie. One name in
    `stride`, always the same ones, is held against all of its block: a sampling operator."""
    nodes = _blocks(rows, id_col, block, name)
    drawn = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", "block", "name")), 1, 8), 16, 10).cast("long"), F.lit(stride)) == 0
    return alike_names(nodes, least, below, asked=drawn)


def stratum_scores(pairs: DataFrame, stratum: str, truth: str, guess: str) -> DataFrame:
    """Counts, precision and recall of a rule (guess) against labels (truth), both 0 or 1, for each stratum of pairs and for all
    of them (stratum `all`). Pairs without a label are counted and take no part."""
    t, g = F.col(truth) == 1, F.col(guess) == 1
    rows = pairs.withColumn("_s", F.explode(F.array(F.col(stratum).cast("string"), F.lit("all"))))
    c = rows.groupBy(F.col("_s").alias("stratum")).agg(
        F.count(F.lit(1)).alias("pairs"), F.count(truth).alias("labelled"), F.count_if(t & g).alias("tp"), F.count_if((F.col(truth) == 0) & g).alias("fp"), F.count_if(t & ~F.coalesce(g, F.lit(False))).alias("fn")
    )
    share = lambda n, d: F.round(F.try_divide(F.col("tp").cast("double"), functools.reduce(Column.__add__, [F.col(x) for x in (n, d)]).cast("double")), 4)
    return c.withColumns({"precision": share("tp", "fp"), "recall": share("tp", "fn")})
