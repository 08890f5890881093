"""Names, places and accounts resolved against masters: the composite steps of entity resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.working import write_table


def assign_to_clusters(fresh: DataFrame, members: DataFrame, block: str, name: str, least: float = 0.9) -> DataFrame:
    """Each new row's best cluster in its block by name similarity, or none below the bar. fresh: id, block, name;
    members: cluster, block, name (one row a spelling)."""
    m = members.select(F.col(block), F.col(name).alias("_m"), "cluster").distinct()
    # Rows of a block that have one name get one answer, and two names that meet in many blocks are compared once.
    asked = fresh.select(block, name).dropna().distinct()
    met = write_table(asked.join(m, block).select(block, name, "_m", "cluster"), "met-names")
    # Names of too different lengths cannot reach the bar, whatever they share: Jaro is at most (2 + shorter / longer) / 3,
    # and a common start adds at most four tenths of what is missing.
    shorter, longer = F.least(F.length(name), F.length("_m")), F.greatest(F.length(name), F.length("_m"))
    possible = shorter >= (3 * (least - 0.4) / 0.6 - 2) * longer - 1e-9
    scored = met.select(name, "_m").distinct().filter(possible).withColumn("_s", text.jaro_winkler(name, "_m")).filter(F.col("_s") >= least)
    best = met.join(scored, [name, "_m"]).groupBy(block, name).agg(F.max(F.struct(F.col("_s"), (-F.col("cluster")).alias("_c"))).alias("b"))
    return fresh.join(best, [block, name], "left").select("id", block, name, (-F.col("b._c")).alias("cluster"), F.round("b._s", 4).alias("similarity"))



def spelling_merges(rows: DataFrame, block: list[str], name: str, weight: str, least: float = 0.82) -> DataFrame:
    """In each block the heaviest name is the anchor; names near it are spellings of it. One anchor a block, no pairs."""
    w = Window.partitionBy(*block).orderBy(F.desc(weight), name)
    a = rows.withColumn("anchor", F.first(name).over(w)).filter(F.col(name) != F.col("anchor"))
    return a.withColumn("_s", text.sequence_ratio(name, "anchor")).filter(F.col("_s") >= least).select(*block, name, "anchor", F.round("_s", 4).alias("similarity"))


def merge_candidates(rows: DataFrame, by: list[str], code: str) -> DataFrame:
    """Groups that are one item by name but carry several codes, with how sure that is."""
    g = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(text.present(code), F.col(code))).alias("codes"), F.count_if(~text.present(code)).alias("blank"))
    return g.filter((F.col("n") > 1) & ((F.col("codes") > 1) | (F.col("blank") > 0))).withColumn("confidence", F.when(F.col("codes") <= 1, "high").when(F.col("codes") == 2, "medium").otherwise("low"))


def corroborate(clusters: DataFrame, market: DataFrame, brand: str, size: str, now: Column, seen: str, half_life: float = 180.0) -> DataFrame:
    """Clusters against a market: brand and size agree .9, brand alone .65; older sightings count less."""
    exact = market.groupBy(brand, size).agg(F.max(seen).alias("_e"))
    loose = market.groupBy(brand).agg(F.max(seen).alias("_l"))
    j = clusters.join(exact, [brand, size], "left").join(loose, brand, "left")
    base = F.when(F.col("_e").isNotNull(), 0.9).when(F.col("_l").isNotNull(), 0.65).otherwise(0.0)
    age = F.greatest(F.datediff(now, F.coalesce("_e", "_l")), F.lit(0))
    score = F.round(base * F.coalesce(F.pow(F.lit(0.5), age / half_life), F.lit(0.0)), 4)
    return j.withColumn("score", score).withColumn("tier", F.when(F.col("score") >= 0.6, 1).when(F.col("score") > 0, 2).otherwise(3)).drop("_e", "_l")


def longest_dictionary_match(rows: DataFrame, name: str, dictionary: DataFrame, term: str) -> DataFrame:
    """The longest dictionary term that stands in a name as whole words. Names are cut into runs of as many words as
    terms have, which meet the dictionary by equality; the dictionary is never scanned for each name."""
    counts = dictionary.filter(F.col(term).isNotNull()).select(F.size(F.split(term, " "))).distinct().collect()
    lengths = F.array(*[F.lit(n) for n in sorted(r[0] for r in counts) or [1]])
    words = F.split(F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " ")), " ")
    runs = F.array_distinct(F.flatten(F.transform(words, lambda w, i: F.transform(lengths, lambda n: F.array_join(F.slice(words, i + 1, n), " ")))))
    j = rows.withColumn("_k", F.monotonically_increasing_id()).withColumn("_run", F.explode_outer(runs))
    d = dictionary.select(F.lower(term).alias("_run"), F.col(term).alias("_term")).distinct()
    hit = j.join(d, "_run", "left").groupBy("_k", *rows.columns).agg(F.max(F.when(F.col("_term").isNotNull(), F.struct(F.length("_term").alias("l"), F.col("_term").alias("t")))).alias("b"))
    return hit.select(*rows.columns, F.col("b.t").alias("match"))


def scope(found: DataFrame, account: str, owner: str, least: int = 20, share: float = 0.6, margin: float = 3.0) -> DataFrame:
    """The owner that an account's keys point to: enough keys, most of them, and well ahead of the next."""
    counts = found.groupBy(account, owner).agg(F.count(F.lit(1)).alias("n"))
    g = counts.groupBy(account).agg(F.sum("n").alias("all"), F.max(F.struct("n", owner)).alias("b"))
    rest = counts.join(g.select(account, F.col(f"b.{owner}").alias("_o")), account).groupBy(account).agg(F.coalesce(F.max(F.when(F.col(owner) != F.col("_o"), F.col("n"))), F.lit(0)).alias("next"))
    j = g.join(rest, account)
    ok = (F.col("b.n") >= least) & (F.col("b.n") >= share * F.col("all")) & (F.col("b.n") >= margin * F.col("next"))
    return j.select(account, F.when(ok, F.col(f"b.{owner}")).alias("scope"), F.col("b.n").alias("votes"), "all", "next")


def venue_resolution(accounts: DataFrame, outlets: DataFrame, key: str, outlet: str) -> DataFrame:
    """located where a name key has one outlet, ambiguous where it has several, unlocated where it has none."""
    g = outlets.groupBy(key).agg(F.count_distinct(outlet).alias("_n"), F.min(outlet).alias("_o"))
    j = accounts.join(g, key, "left")
    return j.withColumn("status", F.when(F.col("_n") == 1, "located").when(F.col("_n") > 1, "ambiguous").otherwise("unlocated")).withColumn("outlet", F.when(F.col("_n") == 1, F.col("_o"))).drop("_n", "_o")


def dual_lookup(rows: DataFrame, first: DataFrame, first_on: list[str], second: DataFrame, second_on: list[str], target: str) -> DataFrame:
    """Two lookups, the first hit wins."""
    j = rows.join(first.select(*first_on, F.col(target).alias("_1")), first_on, "left").join(second.select(*second_on, F.col(target).alias("_2")), second_on, "left")
    return j.withColumn(target, F.coalesce("_1", "_2")).withColumn("via", F.when(F.col("_1").isNotNull(), "first").when(F.col("_2").isNotNull(), "second")).drop("_1", "_2")


def latest_of_group(rows: DataFrame, by: list[str], at: str) -> DataFrame:
    """All rows of each group's latest day."""
    last = rows.groupBy(*by).agg(F.max(at).alias(at))
    return rows.join(last, [*by, at], "left_semi")


def cells_of_many(points: DataFrame, cell: Column, source: str, least: int = 2) -> DataFrame:
    """Points of cells that several sources see."""
    p = points.withColumn("_cell", cell)
    many = p.groupBy("_cell").agg(F.count_distinct(source).alias("_n")).filter(F.col("_n") >= least)
    return p.join(many.select("_cell"), "_cell", "left_semi").drop("_cell")


def merge_packs(packs: list[DataFrame], key: str) -> DataFrame:
    """Tables of different measures side by side by key; the first that has a shared column gives its value."""
    out = packs[0]
    for p in packs[1:]:
        shared = [c for c in p.columns if c in out.columns and c != key]
        renamed = p.select(*[F.col(c).alias(f"_{c}" if c in shared else c) for c in p.columns])
        out = out.join(renamed, key, "full")
        out = out.select(key, *[F.coalesce(c, f"_{c}").alias(c) if c in shared else F.col(c) for c in out.columns if c != key and c not in [f"_{s}" for s in shared]])
    return out


def fill_once(rows: DataFrame, cache: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Values from a cache into nulls only; what is exact stays."""
    c = cache.select(*key, *[F.col(x).alias(f"_{x}") for x in columns])
    j = rows.join(c, key, "left")
    return j.withColumns({x: F.coalesce(x, f"_{x}") for x in columns}).drop(*[f"_{x}" for x in columns])
