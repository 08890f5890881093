"""Outlets and items of many sources brought together: union, identity, metros, offers, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import products, text
from ..functions.keys import md5_key
from ..sources.working import write_table
from .entities import components, strong_key_edges
from .masters import first_writer


def union_sources(sources: dict[str, tuple[DataFrame, dict[str, str]]], fields: list[str], key: list[str]) -> DataFrame:
    """Sources on one schema (field -> column of the source), first source wins by key; sources are given in priority."""
    out = None
    for rank, (name, (df, mapping)) in enumerate(sources.items()):
        columns = [(F.trim(F.col(mapping[f]).cast("string")) if f in mapping else F.lit(None).cast("string")).alias(f) for f in fields]
        one = df.select(*columns, F.lit(name).alias("_source"), F.lit(rank).alias("_rank"))
        out = one if out is None else out.unionByName(one)
    ident = md5_key(*[F.lower(F.col(k)) for k in key])
    return first_writer(out.withColumn("outlet_id", ident), ["outlet_id"], F.col("_rank"), *[F.col(f).asc_nulls_last() for f in fields]).drop("_rank")


def identify(outlets: DataFrame, id_col: str, strong: dict[str, Column]) -> DataFrame:
    """Outlets that share a strong key, directly or through others, are one: adds outlet, the least id."""
    c = components(strong_key_edges(outlets, id_col, strong), "a", "b")
    return outlets.join(c.withColumnRenamed("node", id_col), id_col, "left").withColumn("outlet", F.coalesce("component", id_col)).drop("component")


def tri_state(a: Column, b: Column) -> Column:
    """1 if both are present and agree, -1 if they are present and differ, 0 if one is unknown."""
    return F.when(~text.present(a) | ~text.present(b), 0).when(F.lower(a.cast("string")) == F.lower(b.cast("string")), 1).otherwise(-1)


def compare(pairs: DataFrame, fields: list[str]) -> DataFrame:
    """Pairs with columns <f>_a and <f>_b: any disagreement keeps them apart, enough agreement joins them."""
    marks = [tri_state(F.col(f"{f}_a"), F.col(f"{f}_b")) for f in fields]
    agree, differ = sum((F.when(m == 1, 1).otherwise(0) for m in marks), F.lit(0)), sum((F.when(m == -1, 1).otherwise(0) for m in marks), F.lit(0))
    j = pairs.withColumns({"agree": agree, "differ": differ})
    return j.withColumn("verdict", F.when(F.col("differ") > 0, "apart").when(F.col("agree") >= max(1, len(fields) - 1), "same").otherwise("unknown"))


#: Weights of spelling, shared words and sound; marks of a long shared word and of a name within the other.
SCORE_WEIGHTS = (0.40, 0.25, 0.35)
LONG_WORD, LONG_WORD_BASE, LONG_WORD_STEP, LONG_WORD_MOST = 5, 0.60, 0.03, 0.88
WITHIN, WITHIN_OTHER_NUMBERS, NEVER_SURE = 0.90, 0.82, 0.999


def item_score(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """How likely two names mean one product, 0 to 1: spelling, shared words and sound are weighed. Names with figures
    of which none is shared never meet; a long word in both, or a name whose words or letters are all in the second, lifts
    the score. The comparison is of the first name (a query) against the second (what is known); an empty name scores 0."""
    # What is made of one name is made once a name and written: within pairs it would be made again wherever it is looked at.
    words = F.array_distinct(F.filter(F.split("_spoken", " "), lambda w: w != ""))
    each = pairs.select(F.col(a).alias("_name")).union(pairs.select(b)).distinct().withColumn("_spoken", products.spoken(F.col("_name")))
    each = each.select("_name", "_spoken", words.alias("_words"), F.filter(words, lambda w: w.rlike("^[0-9]+$")).alias("_figures"), products.phonetic(F.col("_name")).alias("_sound"))
    each = write_table(each, "spoken-names")
    side = lambda n: each.toDF(f"{n}name", n, f"{n}w", f"{n}n", f"{n}s")
    j = pairs.join(side("_q"), F.col(a).eqNullSafe(F.col("_qname")), "left").join(side("_c"), F.col(b).eqNullSafe(F.col("_cname")), "left")
    j = j.withColumn("_both", F.array_intersect("_qw", "_cw"))
    apart = (F.size("_qn") > 0) & (F.size("_cn") > 0) & ~F.arrays_overlap("_qn", "_cn")
    plain = F.when((F.col("_q") == "") | (F.col("_c") == "") | apart, 0.0).when(F.col("_q") == F.col("_c"), 1.0)
    # The ratios run in Python, so what is decided without them does not go there.
    todo = plain.isNull()
    spelling = text.sequence_ratio(F.when(todo, F.col("_q")), F.when(todo, F.col("_c")))
    sound = text.sequence_ratio(F.when(todo, F.col("_qs")), F.when(todo, F.col("_cs")))
    longest = F.array_max(F.transform(F.filter("_both", lambda w: ~w.rlike("^[0-9]+$")), F.length))
    lifted = F.when(longest >= LONG_WORD, F.least(LONG_WORD_BASE + LONG_WORD_STEP * (longest - (LONG_WORD - 1)), F.lit(LONG_WORD_MOST)))
    inside = F.contains("_c", "_q") | (F.size("_both") == F.size("_qw"))
    held = F.when(inside, F.when(F.size(F.array_except("_qn", "_cn")) == 0, WITHIN).otherwise(WITHIN_OTHER_NUMBERS))
    weighed = sum(w * s for w, s in zip(SCORE_WEIGHTS, (spelling, text.jaccard(F.col("_qw"), F.col("_cw")), sound)))
    score = F.round(F.least(F.greatest(weighed, F.coalesce(lifted, F.lit(0.0)), F.coalesce(held, F.lit(0.0))), F.lit(NEVER_SURE)), 4)
    return j.withColumn("score", F.coalesce(plain, score)).drop("_q", "_c", "_qname", "_cname", "_qw", "_cw", "_qn", "_cn", "_qs", "_cs", "_both")


def apply_decisions(clusters: DataFrame, decisions: DataFrame) -> DataFrame:
    """Human decisions over machine clusters: a member moved goes to the cluster named, a member split gets its own."""
    j = clusters.join(decisions, "member", "left")
    return j.select("member", F.when(F.col("decision") == "move", F.col("target")).when(F.col("decision") == "split", F.col("member")).otherwise(F.col("cluster")).alias("cluster"), F.col("decision").isNotNull().alias("decided"))


def split_by_value(rows: DataFrame, group: str, value: str, tolerance: float) -> DataFrame:
    """Groups whose rows differ in a measure by more than the tolerance are cut by its rounded value."""
    spread = rows.groupBy(group).agg((F.max(value) - F.min(value)).alias("_d"))
    j = rows.join(spread, group)
    cut = F.when(F.col("_d") > tolerance, F.concat_ws("#", group, F.round(F.col(value) / tolerance).cast("long"))).otherwise(F.col(group).cast("string"))
    return j.withColumn("split_group", cut).drop("_d")


def metro_counts(outlets: DataFrame, places: DataFrame, on: str, metro: str, flag: str) -> DataFrame:
    """Doors by metro in three buckets: yes, no and unknown, which is not no; outlets without a metro are counted too."""
    j = outlets.join(places, on, "left")
    return j.groupBy(F.coalesce(F.col(metro).cast("string"), F.lit("(unknown)")).alias("metro")).agg(
        F.count(F.lit(1)).alias("doors"), F.count_if(F.col(flag)).alias("yes"), F.count_if(~F.col(flag)).alias("no"), F.count_if(F.col(flag).isNull()).alias("unknown")
    )


def assemble_offers(latest: DataFrame, *sides: tuple[DataFrame, list[str]]) -> DataFrame:
    """The latest observation with what other tables know of it; each side has one row a key."""
    for side, on in sides:
        latest = latest.join(side, on, "left")
    return latest


def due(builds: DataFrame, runs: DataFrame, upstream: DataFrame) -> DataFrame:
    """Builds whose upstream went well after their own last attempt, the least time apart observed.

    builds: build, gap_hours; runs: build, at; upstream: build, ok_at; times are timestamps."""
    last = runs.groupBy("build").agg(F.max("at").alias("last_try"))
    fresh = upstream.groupBy("build").agg(F.max("ok_at").alias("fresh"))
    j = builds.join(last, "build", "left").join(fresh, "build", "left")
    apart = (F.unix_seconds("fresh") - F.unix_seconds("last_try")) / 3600 >= F.col("gap_hours")
    return j.withColumn("due", F.coalesce(F.col("fresh").isNotNull() & (F.col("last_try").isNull() | ((F.col("fresh") > F.col("last_try")) & apart)), F.lit(False)))


def misfires(findings: DataFrame, eligible: int, share: float = 0.05) -> DataFrame:
    """A check that fires on too many rows at one confidence says that the check is wrong: one finding instead of many."""
    g = findings.groupBy("check").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("confidence").alias("levels"))
    return g.withColumn("misfire", (F.col("hits") > share * eligible) & (F.col("levels") == 1))


def identify_fuzzily(outlets: DataFrame, id_col: str, strong: dict[str, Column], cell: Column, name: str, least: float = 0.72, most: int = 250) -> DataFrame:
    """Clusters by exact keys and by alike names in one grid cell. Cells of more than `most` rows (malls, coordinates of a
    whole town) say nothing of identity and take no part in the second step."""
    placed = outlets.select(id_col, name, cell.alias("_cell")).filter(F.col("_cell").isNotNull() & (F.col(name) != ""))
    usable = placed.groupBy("_cell").count().filter(F.col("count").between(2, most)).select("_cell")
    inside = placed.join(usable, "_cell", "left_semi")
    left, right = (inside.select("_cell", F.col(id_col).alias(s), F.col(name).alias(f"_{s}")) for s in ("a", "b"))
    # The ratio is at most twice the shorter length over both, so most pairs need no comparison.
    short, both = F.least(F.length("_a"), F.length("_b")), F.length("_a") + F.length("_b")
    met = left.join(right, "_cell").filter((F.col("a") < F.col("b")) & (2 * short >= least * both))
    alike = met.withColumn("_s", text.sequence_ratio("_a", "_b")).filter(F.col("_s") >= least).select("a", "b")
    exact = strong_key_edges(outlets, id_col, strong)
    edges = alike.unionByName(exact.select(*[F.col(c).alias(n) for c, n in zip(exact.columns, ("a", "b"))]))
    found = components(edges, "a", "b")
    return outlets.join(found.withColumnRenamed("node", id_col), id_col, "left").withColumn("cluster", F.coalesce("component", F.col(id_col))).drop("component")
