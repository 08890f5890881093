"""Master data: hierarchy of keyed grains, associations, votes, crosswalks, registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.keys import md5_key


def grain_keys(grains: list[tuple[str, list[str]]], named: set[str]) -> dict[str, Column]:
    """Cumulative key of each grain; name-like fields lose years and edition words, so that those do not part rows."""
    parts: list[Column] = []
    keys = {}
    for grain, fields in grains:
        parts = parts + [text.identity(F.col(f)) if f in named else F.lower(F.col(f).cast("string")) for f in fields]
        keys[grain] = md5_key(*parts)
    return keys


def shred(staged: DataFrame, grains: list[tuple[str, list[str]]], grain: str, named: set[str], carried: list[str] = []) -> DataFrame:
    """One grain's rows: key, parent's key, least attribute values, counts and the list of sources."""
    keys = grain_keys(grains, named)
    names = [g for g, _ in grains]
    at = names.index(grain)
    aggs = [F.min(c).alias(c) for c in (*grains[at][1], *carried)]
    if at:
        aggs.insert(0, F.min(keys[names[at - 1]]).alias(f"{names[at - 1]}_key"))
    sources = F.array_join(F.sort_array(F.collect_set("_source")), ",").alias("source_list")
    return staged.groupBy(keys[grain].alias(f"{grain}_key")).agg(*aggs, F.count(F.lit(1)).alias("source_rows"), F.count_distinct("_source").alias("sources"), sources)


def association(staged: DataFrame, left: Column, name: str, right: str) -> DataFrame:
    """Pairs of a key and a present value, with how many rows and sources say so."""
    return (
        staged.filter(text.present(right))
        .groupBy(left.alias(name), F.col(right).alias(right))
        .agg(F.count(F.lit(1)).alias("source_rows"), F.array_join(F.sort_array(F.collect_set("_source")), ",").alias("source_list"))
    )


def majority(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent present value, the least of equals, and its share."""
    counts = rows.filter(text.present(value)).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    # Counts first, then one pass over them: the group's rows are never gathered.
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value))).alias("b"), F.sum("n").alias("all"))
    return best.select(*by, F.col(f"b.{value}").alias(value), (-F.col("b.n")).alias("votes"), F.round(-F.col("b.n") / F.col("all"), 4).alias("share"))


def entity_resolve(staged: DataFrame, strong: str, natural: list[str]) -> DataFrame:
    """One row an entity: by the strong key where it is present, by the natural key otherwise."""
    key = F.when(text.present(strong), F.concat(F.lit("S:"), F.col(strong).cast("string"))).otherwise(F.concat(F.lit("N:"), md5_key(*[F.lower(F.col(c).cast("string")) for c in natural])))
    return staged.groupBy(key.alias("entity_key")).agg(*[F.min(c).alias(c) for c in natural], F.count(F.lit(1)).alias("source_rows"), F.count_distinct("_source").alias("sources"))


def propagate_unique(rows: DataFrame, by: list[str], code: str) -> DataFrame:
    """Groups with exactly one distinct code give it to their rows without."""
    one = rows.filter(text.present(code)).groupBy(*by).agg(F.min(code).alias("_c"), F.count_distinct(code).alias("_n")).filter("_n = 1").drop("_n")
    joined = rows.join(one, by, "left")
    healed = ~text.present(code) & F.col("_c").isNotNull()
    return joined.withColumn("healed", healed).withColumn(code, F.when(healed, F.col("_c")).otherwise(F.col(code))).drop("_c")


def corroboration(rows: DataFrame, key: str) -> DataFrame:
    """Records, entities, and entities that two or more sources know."""
    per = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_source").alias("s"))
    return per.agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("entities"), F.count_if(F.col("s") >= 2).alias("corroborated")).withColumn("rate", F.round(F.col("corroborated") / F.col("entities"), 4))


def first_writer(rows: DataFrame, by: list[str], *priority: Column) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*priority)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def freshest(rows: DataFrame, by: list[str], at: str, columns: list[str], source: str) -> DataFrame:
    """Per key the freshest source and, column by column, the freshest present value."""
    pick = lambda c: F.max_by(F.when(text.present(c), F.col(c)), F.when(text.present(c), F.struct(at, source))).alias(c)
    return rows.groupBy(*by).agg(*[pick(c) for c in columns], F.max_by(source, F.struct(at, source)).alias("freshest_source"), F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"))


def register_ids(known: DataFrame, seen: DataFrame, key: str, prefix: str, today: str) -> DataFrame:
    """A durable registry: known keys keep their id and first day, new ones get an id made from the key."""
    fresh = seen.select(key).distinct().join(known, key, "left_anti")
    minted = fresh.select(key, F.concat(F.lit(prefix), F.upper(F.substring(F.md5(F.col(key).cast("string")), 1, 10))).alias("id"), F.lit(today).alias("first_seen"), F.lit(today).alias("last_seen"))
    again = known.join(seen.select(key).distinct().withColumn("_s", F.lit(True)), key, "left")
    kept = again.select(key, "id", "first_seen", F.when(F.col("_s"), F.lit(today)).otherwise(F.col("last_seen")).alias("last_seen"))
    return kept.unionByName(minted)


def prefix_owners(codes: DataFrame, code: str, owner: str, digits: int = 6) -> DataFrame:
    """The owner most codes of a prefix have."""
    return majority(codes.withColumn("prefix", F.substring(F.lpad(F.col(code).cast("string"), 12, "0"), 1, digits)), ["prefix"], owner)
