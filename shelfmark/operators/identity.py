"""Identity by discriminators: keys that differ only by what one of them does not say are one if a second signal confirms it,
and no group ever holds two members that disagree."""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import present
from ..sources.working import forget, write_table
from .entities import components

#: Edges of a component up to which one task walks them in order; larger ones are contracted by rounds of joins.
WALKED_EDGES = 50_000
ROUNDS = 200


def _merged(attributes: list[str]) -> list[Column]:
    """A group's value of each attribute, of which it holds one at most."""
    return [F.max(c).alias(c) for c in attributes]


def _agrees(attributes: list[str], a: str, b: str) -> Column:
    clash = [F.coalesce(F.col(f"{a}.{c}") != F.col(f"{b}.{c}"), F.lit(False)) for c in attributes]
    return ~functools.reduce(Column.__or__, clash, F.lit(False))


def _walk(attributes: list[str]):
    """Edges of one component, the strongest first: groups are joined unless their values of an attribute differ."""

    def run(key: tuple, edges: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        ids = sorted(nodes["g"])
        parent = {g: g for g in ids}
        values = {r[0]: [None if pd.isna(v) else v for v in r[1:]] for r in nodes[["g", *attributes]].itertuples(index=False)}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for u, v in edges.sort_values(["strength", "a", "b"], ascending=[False, True, True])[["u", "v"]].itertuples(index=False):
            u, v = sorted((root(u), root(v)))
            if u == v:
                continue
            both = list(zip(values[u], values[v]))
            if all(x is None or y is None or x == y for x, y in both):
                parent[v] = u
                values[u] = [y if x is None else x for x, y in both]
        return pd.DataFrame({"g": ids, "to": [root(g) for g in ids]})

    return run


def constrained_components(nodes: DataFrame, edges: DataFrame, id_col: str, attributes: list[str], walked: int = WALKED_EDGES) -> DataFrame:
    """id, component (the least id of its group) of every node. Edges (a, b, strength) are taken in the order of strength,
    then of a and b; one joins the groups of its ends unless a member of one and a member of the other have different values
    of an attribute, in which case it is refused for good, as groups only grow. Null and empty values agree with all.

    The order is kept without a walk over all edges. What is connected by no edge does not meet, so components are
    worked on apart, and one whose members all agree is joined as it is. A component of few edges is walked by one task. In
    a larger one each group looks at its strongest edge; where two groups look at the same edge nothing before it in the
    order can change either, so it is decided, all such edges at once, and the rest is looked at again. Repeated edges and
    edges from a node to itself change nothing; ends that are not among the nodes are left out; equal ids are one node and
    must agree.
    """
    clean = [F.when(present(c), F.col(c).cast("string")).alias(c) for c in attributes]
    base = write_table(nodes.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("g"), *clean).groupBy("g").agg(*_merged(attributes)), "nodes")
    kind = base.schema["g"].dataType.simpleString()
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("strength").cast("double").alias("strength")).filter("a <> b")
    ends = ends.groupBy("a", "b").agg(F.max("strength").alias("strength")).join(base.select(F.col("g").alias("a")), "a", "left_semi").join(base.select(F.col("g").alias("b")), "b", "left_semi")
    # An open edge has its own ends, which order it, and the groups u and v in which they are now.
    open_edges = write_table(ends.select("a", "b", "strength", F.col("a").alias("u"), F.col("b").alias("v")), "open-edges")
    groups = base
    placed = base.select(F.col("g").alias("id"), F.col("g").alias("now"))
    for _ in range(ROUNDS):
        sides = groups.alias("x"), groups.alias("y")
        fit = open_edges.alias("e").join(sides[0], F.col("e.u") == F.col("x.g")).join(sides[1], F.col("e.v") == F.col("y.g"))
        fit = write_table(fit.filter((F.col("e.u") != F.col("e.v")) & _agrees(attributes, "x", "y")).select("e.*"), "fit-edges")
        if fit.isEmpty():
            break
        parts = components(fit, "u", "v")
        held = write_table(groups.join(parts.withColumnRenamed("node", "g"), "g"), "held-groups")
        size = fit.join(parts.withColumnRenamed("node", "u"), "u").groupBy("component").agg(F.count(F.lit(1)).alias("edges"))
        differing = functools.reduce(Column.__or__, [F.min(c) != F.max(c) for c in attributes], F.lit(False))
        kinds = held.groupBy("component").agg(F.coalesce(differing, F.lit(False)).alias("differs")).join(size, "component")
        kinds = write_table(kinds.select("component", F.when(~F.col("differs"), "whole").when(F.col("edges") <= walked, "walk").otherwise("round").alias("how")), "kinds")
        held = held.join(kinds, "component")
        inside = fit.join(held.select(F.col("g").alias("u"), "component", "how"), "u")
        whole = held.filter("how = 'whole'").select("g", F.col("component").alias("to"))
        members = held.filter("how = 'walk'").select("component", "g", *attributes)
        walk = inside.filter("how = 'walk'").groupBy("component").cogroup(members.toDF(*members.columns).groupBy("component")).applyInPandas(_walk(attributes), f"g {kind}, to {kind}")
        rest = inside.filter("how = 'round'").drop("component", "how")
        order = F.struct(-F.col("strength"), "a", "b")
        looks = rest.select(F.col("u").alias("g"), order.alias("o"), "u", "v").unionByName(rest.select(F.col("v").alias("g"), order.alias("o"), "u", "v")).groupBy("g").agg(F.min(F.struct("o", "u", "v")).alias("top"))
        decided = looks.groupBy("top").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select(F.greatest("top.u", "top.v").alias("g"), F.least("top.u", "top.v").alias("to"))
        step = write_table(whole.unionByName(walk).unionByName(decided).filter("g <> to"), "moves")
        named = step.select(F.col("g").alias("_g"), "to")
        placed = write_table(placed.join(named, F.col("now") == F.col("_g"), "left").select("id", F.coalesce("to", "now").alias("now")), "placed")
        groups = write_table(groups.join(named, F.col("g") == F.col("_g"), "left").groupBy(F.coalesce("to", "g").alias("g")).agg(*_merged(attributes)), "groups")
        for side in ("u", "v"):
            rest = rest.join(named, F.col(side) == F.col("_g"), "left").withColumn(side, F.coalesce("to", side)).drop("_g", "to")
        open_edges = write_table(rest.filter("u <> v"), "open-edges")
        forget(fit)
    else:
        raise RuntimeError("groups did not settle")
    return placed.select(F.col("id").alias(id_col), F.col("now").alias("component"))


def category_keys(rows: DataFrame, block: list[str], attributes: list[str], source: str, code: str, price: str) -> DataFrame:
    """One row a key: a block and what is known of the discriminators. An unknown one is left out of the key, so a record
    that says less has a key of its own. With the sources, the codes, the median price and the number of records."""
    parts = [F.when(present(c), F.concat(F.lit(f"{c}="), F.lower(F.trim(F.col(c).cast("string"))))) for c in (*block, *attributes)]
    keyed = rows.withColumn("category_key", F.md5(F.concat_ws("|", *parts)))
    kept = [F.nullif(F.lower(F.trim(F.col(c).cast("string"))), F.lit("")).alias(c) for c in (*block, *attributes)]
    each = keyed.select("category_key", *kept, F.col(source).alias("_source"), F.col(code).cast("string").alias("_code"), F.col(price).cast("double").alias("_price"))
    return each.groupBy("category_key", *block, *attributes).agg(
        F.count(F.lit(1)).alias("members"), F.array_sort(F.collect_set("_source")).alias("sources"), F.array_sort(F.collect_set(F.when(present("_code"), F.col("_code")))).alias("codes"), F.median("_price").alias("price")
    )


def confirmed_edges(keys: DataFrame, block: list[str], attributes: list[str], tolerance: float = 0.35) -> DataFrame:
    """a, b, strength, why of two keys of a block that disagree on nothing and are confirmed: by a code that both carry (2)
    or by prices within the tolerance of the larger (1). Keys meet by their codes, and by cells of the price's logarithm and
    the cells beside it, within which two agreeing prices lie; pairs that disagree are dropped as they meet."""
    import math

    width = -math.log(1 - tolerance)
    one = F.struct("category_key", "price", *attributes)
    by_code = keys.select(*block, F.explode("codes").alias("_at"), one.alias("k"))
    cell = F.floor(F.log("price") / width)
    priced = keys.filter("price > 0").select(*block, cell.alias("_at"), one.alias("k"))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        l, r = left.withColumnRenamed("k", "x"), right.withColumnRenamed("k", "y")
        same = functools.reduce(Column.__and__, [l[c].eqNullSafe(r[c]) for c in (*block, "_at")])
        return l.join(r, same).filter(_agrees(attributes, "x", "y")).select("x", "y")

    codes = met(by_code, by_code.alias("o").select("o.*")).filter(F.col("x.category_key") < F.col("y.category_key")).withColumn("strength", F.lit(2.0))
    near = met(priced, priced.withColumn("_at", F.explode(F.array(F.col("_at") - 1, F.col("_at"), F.col("_at") + 1)))).filter(F.col("x.category_key") < F.col("y.category_key"))
    near = near.filter(F.abs(F.col("x.price") - F.col("y.price")) <= tolerance * F.greatest("x.price", "y.price")).withColumn("strength", F.lit(1.0))
    both = codes.unionByName(near).groupBy(F.col("x.category_key").alias("a"), F.col("y.category_key").alias("b")).agg(F.max("strength").alias("strength"))
    return both.withColumn("why", F.when(F.col("strength") == 2, "code").otherwise("price"))


def resolved_identities(rows: DataFrame, block: list[str], attributes: list[str], source: str, code: str, price: str, tolerance: float = 0.35) -> DataFrame:
    """category_key, resolved (its group's least key), members, n_sources of the group: keys are merged where a second
    signal confirms them, under the veto of their discriminators."""
    keys = write_table(category_keys(rows, block, attributes, source, code, price), "keys")
    found = constrained_components(keys, write_table(confirmed_edges(keys, block, attributes, tolerance), "confirmed"), "category_key", attributes)
    placed = keys.join(found, "category_key")
    groups = placed.groupBy("component").agg(F.sum("members").alias("group_members"), F.size(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("n_sources"))
    return placed.join(groups, "component").select("category_key", F.col("component").alias("resolved"), "members", "group_members", "n_sources")
