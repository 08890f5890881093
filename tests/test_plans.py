import pytest

from shelfmark.plans import compose, rules
from shelfmark.plans.console import Console, Refused, guard
from shelfmark.sources.catalog import Catalog


@pytest.mark.parametrize("sql", ["SELECT 1", "with a as (select 1) select * from a", "select 'drop table x; delete'", "select 1 -- insert\n", "SELECT `update` FROM t;"])
def test_guard_allows(sql):
    assert guard(sql)


@pytest.mark.parametrize("sql", ["", "DROP TABLE x", "select 1; select 2", "insert into t select 1", "with a as (select 1) delete from a", "explain select 1", "select reflect('a', 'b')"])
def test_guard_refuses(sql):
    with pytest.raises(Refused):
        guard(sql)


def test_console_binds_caps_and_reports(spark, tmp_path):
    catalog = Catalog(spark, f"file://{tmp_path}")
    catalog.write("things", spark.range(30).toDF("id"))
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        catalog.write_part("parts", day, spark.range(2).toDF("id"))
    console = Console(catalog, cap=10, parts=2)
    r = console.run("SELECT id FROM things ORDER BY id")
    assert len(r.rows) == 10 and r.truncated and r.bound == {"things": []}
    assert console.run("SELECT count(*) FROM parts").rows == [(4,)]
    assert console.run("SELECT count(*) FROM parts", all_parts=True).rows == [(6,)]


def test_compose(spark):
    tables = {"a": ["k", "x"], "b": ["k", "y"], "c": ["z"]}
    sql = compose.build_sql(tables, [{"left": "a", "right": "b", "on": [("k", "k")], "kind": "left"}], {"a": ["k", "x"], "b": ["k", "y"]}, 5)
    assert sql == "SELECT `a`.`k` AS `a_k`, `a`.`x`, `b`.`k` AS `b_k`, `b`.`y` FROM `a` LEFT JOIN `b` ON `a`.`k` = `b`.`k` LIMIT 5"
    spark.createDataFrame([(1, 2)], "k int, x int").createOrReplaceTempView("a")
    spark.createDataFrame([(1, 3)], "k int, y int").createOrReplaceTempView("b")
    assert [tuple(r) for r in spark.sql(sql).collect()] == [(1, 2, 1, 3)]
    with pytest.raises(ValueError):
        compose.build_sql(tables, [], {"a": ["k"], "c": ["z"]})
    assert compose.links({"a": ["id", "name"], "b": ["id", "name"]})[0].on == (("id", "id"),)


def test_rules(spark):
    df = spark.createDataFrame([("750ML", "usa"), ("1.75L", "fr"), ("", "usa")], "size string, origin string")
    ml = df.select(rules.compile_rule({"source_field": "size", "pre": "size_to_ml"}).alias("v"))
    assert [r["v"] for r in ml.collect()] == [750, 1750, None]
    longest = rules.compile_rule({"mode": "dict", "source_field": "origin", "dict_entries": [{"match": "us", "value": "short"}, {"match": "usa", "value": "long"}], "dict_fallback": "null"})
    assert [r[0] for r in df.select(longest).collect()] == ["long", None, "long"]
    fields = [{"name": "size"}, {"name": "upc", "normalize": "upc"}]
    out = rules.source_select(df, "s", {"size": {"source_field": "size"}}, fields)
    assert out.columns == ["size", "upc", "_source"]
    with pytest.raises(ValueError):
        rules.compile_rule({"mode": "copy"})
