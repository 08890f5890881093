"""Entity resolution: blocked pairs, connected components, tiers, measured precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.working import write_table

#: Pairs that one task expands.
PAIRS_OF_A_TASK = 1 << 21


def components(edges: DataFrame, a: str, b: str, limit: int = 50) -> DataFrame:
    """node, component (least node) of each node of an edge: the least label spreads along edges, and labels of labels
    are followed, until nothing changes. A round is two aggregates; its result is a written table."""
    pairs = write_table(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "edges")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = both.groupBy("u").agg(F.least("u", F.min("v")).alias("c"))
    before = None
    for _ in range(limit):
        labels = write_table(labels, "labels")
        now = labels.agg(F.sum(F.xxhash64("u", "c").cast("decimal(38,0)"))).first()[0]
        if now == before:
            return labels.select(F.col("u").alias("node"), F.col("c").alias("component"))
        before = now
        heard = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("c").alias("m"))
        nearer = labels.join(heard, "u").select("u", F.least("c", "m").alias("c"))
        jump = nearer.select(F.col("u").alias("c"), F.col("c").alias("j"))
        labels = nearer.join(jump, "c", "left").select("u", F.least("c", F.coalesce("j", "c")).alias("c"))
    raise RuntimeError("components did not settle")


def blocked_pairs(rows: DataFrame, id_col: str, block: list[Column], keep: list[str], most: int | None = None, finer: Column | None = None, following: int = 10) -> DataFrame:
    """Pairs within blocks, the smaller id first. With a bound, blocks of more than `most` rows are cut by the finer key
    (by default the first four letters of the first kept column), and in those that are still too large each row meets
    the `following` rows behind it in the order of that column. Without one all pairs are given, so that blocks must be
    small by their nature."""
    keyed = rows.select(id_col, *keep, F.concat_ws("|", *block).alias("block"), *([] if most is None else [(F.substring(keep[0], 1, 4) if finer is None else finer).alias("_f")]))
    large = None
    if most is not None:
        wide = keyed.groupBy("block").count().filter(F.col("count") > most).select("block", F.lit(True).alias("_wide"))
        keyed = keyed.join(wide, "block", "left").withColumn("block", F.when(F.col("_wide"), F.concat_ws("|", "block", "_f")).otherwise(F.col("block"))).drop("_wide", "_f")
        still = keyed.groupBy("block").count().filter(F.col("count") > most).select("block")
        large, keyed = keyed.join(still, "block", "left_semi"), keyed.join(still, "block", "left_anti")
    left = keyed.select("block", F.col(id_col).alias("a"), *[F.col(c).alias(f"{c}_a") for c in keep])
    right = keyed.select("block", F.col(id_col).alias("b"), *[F.col(c).alias(f"{c}_b") for c in keep])
    pairs = left.join(right, "block").filter("a < b")
    if large is None:
        return pairs
    one = F.struct(F.col(id_col).alias("_id"), *keep)
    w = Window.partitionBy("block").orderBy(keep[0], id_col)
    ahead = large.select("block", one.alias("x"), F.array_compact(F.array(*[F.lead(one, k).over(w) for k in range(1, following + 1)])).alias("ys"))
    met = ahead.select("block", "x", F.explode("ys").alias("y"))
    first = F.col("x._id") < F.col("y._id")
    side = lambda c, mine: F.when(first == mine, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}"))
    return pairs.unionByName(met.select("block", side("_id", True).alias("a"), *[side(c, True).alias(f"{c}_a") for c in keep], side("_id", False).alias("b"), *[side(c, False).alias(f"{c}_b") for c in keep]))


def class_pairs(rows: DataFrame, id_col: str, block: list[str], value: str, score, near=None, task: int = PAIRS_OF_A_TASK) -> DataFrame:
    """a, b (the smaller id first) and what `score` adds, of the pairs within blocks that `score` keeps. Rows of a block with
    the same value are a class. `score` sees each two values that meet in some block once, as <value>_a and <value>_b in both
    orders, however many rows and blocks have them; only what it keeps is expanded into pairs of rows, by joins on block and
    value, so the work beyond the different values is that of the result. `near` gives the two values' classes that may meet
    (block columns, <value>_a, <value>_b) from classes (block columns, value); by default all of a block. Rows with a null in
    a block column or the value are in no pair.

    Rows are small and their pairs many, so tasks are dealt by the pairs that they make, not by bytes: about `task` pairs
    each, and a class with more is met by several tasks, each with a share of the rows on its left."""
    spark, both = rows.sparkSession, [f"{value}_a", f"{value}_b"]
    held = rows.select(id_col, *block, value).dropna(subset=[*block, value])
    classes = write_table(held.groupBy(*block, value).agg(F.count(F.lit(1)).alias("_n")), "classes")
    left, right = (classes.select(*block, F.col(value).alias(v), F.col("_n").alias(f"_n{v}")) for v in both)
    right = right.toDF(*right.columns)
    met = left.join(right, block) if near is None else near(classes.drop("_n")).join(left, [*block, both[0]]).join(right, [*block, both[1]])
    met = write_table(met.select(*block, *both, (F.col(f"_n{both[0]}") * F.col(f"_n{both[1]}")).alias("_pairs")), "met-classes")
    kept = score(met.select(*both).distinct().repartition(spark.sparkContext.defaultParallelism, *both))
    found = [c for c in kept.columns if c not in both]
    hits = write_table(met.join(kept, both), "class-pairs")
    n = max(spark.sparkContext.defaultParallelism, -(-(hits.agg(F.sum("_pairs")).first()[0] or 0) // task))
    shares = hits.groupBy(*block, both[1]).agg(F.ceil(F.sum("_pairs") / task).alias("_shares"))
    x, y = (held.select(*block, F.col(value).alias(v), F.col(id_col).alias(s)) for s, v in zip(("a", "b"), both))
    x = x.repartition(n, *block, both[0]).join(hits.join(shares, [*block, both[1]]), [*block, both[0]])
    x = x.withColumn("_share", F.pmod(F.xxhash64("a"), "_shares")).repartition(n, *block, both[1], "_share")
    y = y.toDF(*y.columns).join(shares, [*block, both[1]]).withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shares") - 1))).drop("_shares")
    return x.join(y.repartition(n, *block, both[1], "_share"), [*block, both[1], "_share"]).filter("a < b").select("a", "b", *found)


def shared_start(block: list[str], value: str, least: float):
    """Classes of a block that may have a Jaccard overlap of `least` or more, for `class_pairs`; values are sorted arrays of
    distinct tokens. Two such have most tokens in common, so one of the first few of each is the same."""
    first = F.slice(value, 1, F.size(value) - F.ceil(F.size(value) * least - 1e-9).cast("int") + 1)

    def near(classes: DataFrame) -> DataFrame:
        each = classes.filter(F.size(value) > 0).withColumn("_t", F.explode(first))
        left, right = (each.withColumnRenamed(value, f"{value}_{s}") for s in ("a", "b"))
        fit = F.least(F.size(f"{value}_a"), F.size(f"{value}_b")) >= least * F.greatest(F.size(f"{value}_a"), F.size(f"{value}_b")) - 1e-9
        return left.join(right.toDF(*right.columns), [*block, "_t"]).filter(fit).select(*block, f"{value}_a", f"{value}_b").distinct()

    return near


def class_counts(rows: DataFrame, id_col: str, block: list[str], keep: list[str]) -> DataFrame:
    """Pairs of classes within blocks instead of pairs of rows: <keep>_a, <keep>_b and n, how many pairs of rows with different
    ids of a block have these values, each two rows counted once. Work grows with the rows and the different values of a
    block. Which of two rows is the first is lost, so what is made of them must not depend on it. Rows with a null in a block
    column or the id are in no pair."""
    each = rows.dropna(subset=[*block, id_col]).groupBy(*block, id_col, *keep).agg(F.count(F.lit(1)).alias("_n"))

    def pairs(counts: DataFrame, by: list[str], sign: int) -> DataFrame:
        one = F.struct(*keep)  # an order of a block's classes, with nulls first
        left, right = (counts.select(*by, one.alias(f"_{s}"), F.col("_n").alias(f"_n{s}")) for s in ("a", "b"))
        met = left.join(right.toDF(*right.columns), by).filter("_a <= _b")
        n = F.when(F.col("_a") == F.col("_b"), F.expr("(_na * (_na - 1)) div 2")).otherwise(F.col("_na") * F.col("_nb"))
        return met.select(*[F.col(f"_{s}.{c}").alias(f"{c}_{s}") for s in ("a", "b") for c in keep], (sign * n).alias("n"))

    repeated = each.groupBy(*block, id_col).agg(F.sum("_n").alias("_all")).filter("_all > 1").drop("_all")
    classes = each.groupBy(*block, *keep).agg(F.sum("_n").alias("_n"))
    counted = pairs(classes, block, 1).unionByName(pairs(each.join(repeated, [*block, id_col]), [*block, id_col], -1))
    return counted.groupBy(*[f"{c}_{s}" for s in ("a", "b") for c in keep]).agg(F.sum("n").alias("n")).filter("n > 0")


def all_pairs(rows: DataFrame, id_col: str, value: Column, group: str, meet, schema: str, block: int = 2048, shape: Column | None = None) -> DataFrame:
    """a, b (the smaller id first), across (whether their groups differ) and what `meet` gives, of every two rows that
    it keeps. Rows are dealt into blocks, and each pair of blocks is a task of its own, so that each two rows meet once
    and none is skipped for its group or its number of likes. Only rows of one shape (say, a vector's length) meet.
    meet takes the values of both sides and gives places on the left, places on the right and the measure."""
    import numpy as np
    import pandas as pd

    name = schema.split()[0]
    blocks = max(1, -(-rows.count() // block))
    dealt = rows.select(F.col(id_col).cast("long").alias("id"), F.col(group).cast("string").alias("g"), value.alias("v"), F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("own"))
    every = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids, groups, own = frame["id"].to_numpy(np.int64), frame["g"].to_numpy(object), frame["own"].to_numpy()
        left, right = np.flatnonzero(own == key[0]), np.flatnonzero(own == key[1])
        x, y, s = meet(frame["v"].iloc[left], frame["v"].iloc[right])
        x, y = left[x], right[y]
        ok = ids[x] != ids[y] if key[0] != key[1] else ids[x] < ids[y]
        x, y, s = x[ok], y[ok], s[ok]
        return pd.DataFrame({"a": np.minimum(ids[x], ids[y]), "b": np.maximum(ids[x], ids[y]), "across": (groups[x] != groups[y]).astype(bool), name: s})

    by = every.groupBy(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.lit(0) if shape is None else shape).alias("shape"))
    return by.applyInPandas(run, f"a long, b long, across boolean, {schema}")


def cosine_at_least(rows: DataFrame, id_col: str, vector: str, group: str, least: float, block: int = 2048) -> DataFrame:
    """a, b, across, s of every two vectors with a cosine s of `least` or more. A matrix product finds them with room for
    its rounding; their cosines are then summed in order, as `vectors.cosine` does. Vectors that are null, zero or
    hold a null or non-finite component take no part; vectors of different lengths do not meet."""
    import numpy as np

    def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a))
        for d in range(a.shape[1]):
            out += a[:, d] * b[:, d]
        return out

    def meet(left, right) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        if len(left) and len(right):
            a, b = (np.stack(v.to_numpy()).astype(float) for v in (left, right))
            na, nb = np.sqrt(dots(a, a)), np.sqrt(dots(b, b))
            ub = (b / nb[:, None]).T
            for at in range(0, len(a), 256):
                x, y = np.nonzero((a[at : at + 256] / na[at : at + 256, None]) @ ub >= least - 1e-9)
                for k in range(0, len(x), 1 << 16):
                    u, v = x[k : k + (1 << 16)] + at, y[k : k + (1 << 16)]
                    s = dots(a[u], b[v]) / (na[u] * nb[v])
                    found.append((u[s >= least], v[s >= least], s[s >= least]))
        return tuple(np.concatenate(c) for c in zip(*found))

    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return all_pairs(rows.filter(F.col(id_col).isNotNull() & fine), id_col, F.col(vector), group, meet, "s double", block, F.size("v"))


def hamming_at_most(rows: DataFrame, id_col: str, bits: Column, group: str, most: int, block: int = 2048) -> DataFrame:
    """a, b, across, bits of every two hashes (long, up to 64 bits) that differ in `most` bits or fewer."""
    import numpy as np

    def meet(left, right) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int32))]
        a, b = (v.to_numpy(np.int64).view(np.uint64) for v in (left, right))
        for at in range(0, len(a), 256):
            n = np.bitwise_count(a[at : at + 256, None] ^ b[None])
            x, y = np.nonzero(n <= most)
            found.append((x + at, y, n[x, y].astype(np.int32)))
        return tuple(np.concatenate(c) for c in zip(*found))

    return all_pairs(rows.filter(F.col(id_col).isNotNull() & bits.isNotNull()), id_col, bits, group, meet, "bits int", block)


def strong_key_edges(rows: DataFrame, id_col: str, keys: dict[str, Column]) -> DataFrame:
    """Edges from each row to the least row that shares one of its strong keys: stars, not pairs."""
    pairs = F.array_compact(F.array(*[F.when(text.present(k), F.concat(F.lit(f"{n}:"), k.cast("string"))) for n, k in keys.items()]))
    held = rows.select(F.col(id_col).alias("a"), F.explode(pairs).alias("k"))
    least = held.groupBy("k").agg(F.min("a").alias("b"))
    return held.join(least, "k").filter("a <> b").select("a", "b").distinct()


def confusion(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    """Counts and precision, recall and F1 of a guess (0 or 1) against the truth."""
    t, g = F.col(truth) == 1, F.col(guess) == 1
    c = rows.agg(F.count_if(t & g).alias("tp"), F.count_if(~t & g).alias("fp"), F.count_if(t & ~g).alias("fn"), F.count_if(~t & ~g).alias("tn"))
    p = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    r = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    return c.select("tp", "fp", "fn", "tn", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 4).alias("f1"))


def pair_quality(rows: DataFrame, gold: str, assigned: str) -> DataFrame:
    """Precision and recall of an assignment against gold keys over all pairs, from counts: no pair is made."""
    choose = lambda n: F.col(n) * (F.col(n) - 1) / 2
    count = lambda *k: rows.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(choose("n")).alias("s"))
    both, g, a = (count(*k).withColumnRenamed("s", n) for k, n in (((gold, assigned), "tp"), ((gold,), "g"), ((assigned,), "a")))
    j = both.join(F.broadcast(g)).join(F.broadcast(a))
    return j.select(F.col("tp").cast("long").alias("tp"), F.round(F.try_divide("tp", "a"), 4).alias("precision"), F.round(F.try_divide("tp", "g"), 4).alias("recall"))
