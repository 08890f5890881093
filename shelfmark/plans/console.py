"""A read-only SQL surface: one statement, reading only, over catalog tables bound on demand, with a cap and a timeout."""

from __future__ import annotations

import re
import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..sources.catalog import Catalog

OPENERS = ("select", "with", "from", "values", "describe", "show", "table")
#: Words that must not stand outside literals and quoted names.
BANNED = frozenset(
    "insert update delete merge create drop alter truncate replace copy install load attach detach export import set reset "
    "pragma call grant revoke cache uncache refresh analyze msck add use reflect java_method".split()
)
_CAP, _TIMEOUT = 5000, 120.0
_LEX = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)


class Refused(ValueError):
    """The statement is not one that the console runs."""


def strip(sql: str, names: bool = True) -> str:
    """The statement without literals and comments; quoted names go too unless they are asked for."""

    def blank(m: re.Match) -> str:
        return m[0] if m[0][0] in "\"`" and not names else " "

    return _LEX.sub(blank, sql)


def guard(sql: str) -> str:
    """The statement if it is one, reading, without banned words; Refused otherwise."""
    bare = strip(sql).strip()
    if not bare:
        raise Refused("there is no statement")
    if ";" in bare.rstrip(";"):
        raise Refused("one statement at a time")
    words = re.findall(r"[a-z_][a-z_0-9]*", bare.lower())
    if not words or words[0] not in OPENERS:
        raise Refused(f"a statement must begin with one of {', '.join(OPENERS)}")
    if bad := BANNED.intersection(words):
        raise Refused(f"not allowed here: {', '.join(sorted(bad))}")
    return sql.strip().rstrip(";")


def names_in(sql: str, known: list[str]) -> list[str]:
    """Catalog tables that the statement names, bare or quoted."""
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", strip(sql, names=False)))
    return [n for n in known if n in words]


@dataclass
class Result:
    columns: list[str]
    rows: list[tuple]
    truncated: bool
    bound: dict[str, list[str]] = field(default_factory=dict)


class Console:
    def __init__(self, catalog: Catalog, cap: int = _CAP, timeout: float = _TIMEOUT, parts: int = 60):
        self.catalog, self.cap, self.timeout, self.parts = catalog, cap, timeout, parts

    def bind(self, sql: str, all_parts: bool = False) -> dict[str, list[str]]:
        """Views of the tables that the statement names. Tables of parts show their newest ones, unless all are asked for."""
        bound = {}
        for name in names_in(sql, self.catalog.names()):
            chosen: list[str] = []
            if self.catalog.layout(name) == "parts" and not all_parts:
                chosen = self.catalog.newest_parts(name, self.parts)
                self.catalog.read_parts(name, chosen).createOrReplaceTempView(name)
            else:
                self.catalog.table(name).createOrReplaceTempView(name)
            bound[name] = chosen
        return bound

    def plan(self, sql: str, all_parts: bool = False) -> tuple[DataFrame, dict[str, list[str]]]:
        sql = guard(sql)
        bound = self.bind(sql, all_parts)
        df = self.catalog.spark.sql(sql)
        root = df._jdf.queryExecution().analyzed()
        if "Command" in root.getClass().getSimpleName() and not re.match(r"\s*(describe|show)", sql, re.I):
            raise Refused("a command is not a query")
        return df, bound

    def run(self, sql: str, limit: int | None = None, all_parts: bool = False) -> Result:
        """At most cap rows, and whether there were more. Time runs from before tables are bound: what is over time is
        interrupted, and a statement whose binding took all of it is not begun."""
        spark = self.catalog.spark
        cap = min(limit or self.cap, self.cap)
        tag = f"console-{uuid.uuid4().hex}"
        over = threading.Event()

        def stop() -> None:
            over.set()
            spark.interruptTag(tag)

        timer = threading.Timer(self.timeout, stop)
        spark.addTag(tag)
        timer.start()
        try:
            df, bound = self.plan(sql, all_parts)
            if over.is_set():
                raise TimeoutError(f"binding took {self.timeout} s")
            rows = [tuple(r) for r in df.limit(cap + 1).collect()]
        finally:
            timer.cancel()
            spark.removeTag(tag)
        return Result(df.columns, rows[:cap], len(rows) > cap, bound)
