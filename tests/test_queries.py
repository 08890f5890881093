"""Every registered query of the library equals its SQL on the driver's small tables."""

import decimal
import glob
import os

import duckdb
import pytest

from shelfmark.queries import everything

REGISTRY = everything()


def canonical(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.6g}"
    if isinstance(value, (list, tuple)):
        return str([canonical(v) for v in value])
    return str(value)


def rows_of(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_query_equals_sql(name, spark, sf_dir, tables):
    df = REGISTRY.queries[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if name in REGISTRY.sql:
        want = tables.sql(REGISTRY.sql[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert rows_of(df.columns, got) == rows_of(want.columns, want.fetchall())
    else:
        assert got


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["brand", "week"]
