"""Field rules as columns: each rule of a declaration becomes one Catalyst expression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


@dataclass(frozen=True)
class Rule:
    """A declared rule. The names are those of the declaration; what a mode does not use it does not read."""

    mode: str = "transform"
    source_field: str | None = None
    expr: str = "NULL"
    pre: str = "none"
    post: str = "none"
    pattern: str = "(.*)"
    group: int = 1
    map: dict[str, str] = field(default_factory=dict)
    dict_entries: list[dict] = field(default_factory=list)
    dict_mode: str = "contains"
    dict_fallback: str = "original"

    @classmethod
    def parse(cls, declared: dict) -> Rule:
        """Unset and empty settings take their defaults; settings of no rule are left out."""
        return cls(**{k: v for k, v in declared.items() if k in cls.__dataclass_fields__ and v not in (None, "", {}, [])})

    @property
    def column(self) -> Column:
        if not self.source_field:
            raise ValueError("a rule needs its source_field")
        return F.col(f"`{self.source_field}`")


def _mapped(rule: Rule) -> Column:
    if not rule.map:
        return rule.column
    table = F.create_map(*[F.lit(x) for pair in rule.map.items() for x in pair])
    return F.coalesce(F.try_element_at(table, rule.column.cast("string")), rule.column.cast("string"))


#: One handler a mode.
MODES: dict[str, Callable[[Rule], Column]] = {
    "expr": lambda r: F.expr(r.expr),
    "copy": lambda r: r.column,
    "regex": lambda r: F.regexp_extract(r.column.cast("string"), r.pattern, int(r.group)),
    "map": _mapped,
    "dict": lambda r: text.dictionary(r.column, r.dict_entries, r.dict_mode, r.dict_fallback),
    "transform": lambda r: text.transform(r.post, text.transform(r.pre, r.column)),
}


def compile_rule(declared: dict) -> Column:
    """A declared rule's column."""
    rule = Rule.parse(declared)
    if rule.mode.lower() not in MODES:
        raise ValueError(f"no such mode: {rule.mode}")
    return MODES[rule.mode.lower()](rule)


def source_select(df: DataFrame, name: str, rules: dict[str, dict], fields: list[dict], where: str | None = None) -> DataFrame:
    """A source on the master's schema: every field in order (null where there is no rule), and _source."""
    if where:
        df = df.filter(where)
    columns = []
    for f in fields:
        rule = rules.get(f["name"])
        c = F.lit(None).cast("string") if rule is None else text.normalize(f.get("normalize"), compile_rule(rule))
        columns.append(c.cast(f.get("type", "string")).alias(f["name"]))
    return df.select(*columns, F.lit(name).alias("_source"))


def preview(df: DataFrame, rule: dict, limit: int = 12) -> DataFrame:
    """Distinct raw and derived values, the first of them."""
    raw = F.col(f"`{rule['source_field']}`").cast("string")
    return df.select(raw.alias("raw"), compile_rule(rule).cast("string").alias("derived")).distinct().orderBy("raw").limit(limit)


def coverage(df: DataFrame, field: str, entries: list[dict], mode: str = "contains") -> DataFrame:
    """By value of the dictionary how many rows it covers; the null value stands for what it does not."""
    hit = text.dictionary(F.col(field), entries, mode, "null")
    return df.filter(text.present(field)).groupBy(hit.alias("value")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(field).alias("distinct_raw"))
