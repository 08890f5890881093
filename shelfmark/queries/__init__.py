"""Registered queries over the driver's tables and the SQL that each must equal, by topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import attach

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, each with its SQL where SQL has it."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    attach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def everything() -> Registry:
    from . import book, checks, curation, dq, entities, identity, joins, landing, masters, matching, observations, offers, outlets, reports, storage, text, windows

    out = Registry()
    for module in (curation, checks, identity, observations, book, joins, windows, masters, entities, matching, outlets, offers, landing, dq, text, reports, storage):
        out.queries |= module.register.queries
        out.sql |= module.register.sql
    return out
