"""Every registered query with SQL against DuckDB on the smallest tables, and the entry points' contract."""

import math

import duckdb
import pytest

import __spark_entry__
from tallyloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = duck.sql(catalogue.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda names, found: sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found), key=str)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry_points(spark):
    assert __spark_entry__.entry(spark).count() > 0
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and set(catalogue.QUERIES) <= set(queries)
    assert catalogue.QUERIES["dossier_json"](spark, SF).count() > 100


def test_period_text_says_whether_it_is_a_period(spark, duck):
    got = catalogue.QUERIES["period_text"](spark, SF)
    assert "valid" in got.columns and got.filter("valid").count() == duck.sql("select count(*) from lineitem").fetchall()[0][0]


def test_time_of_day_filter_takes_little_disk(spark, tmp_path):
    got = catalogue.QUERIES["time_of_day_filter"](spark, "/root/testdata/sf0.01")
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()
    got.write.parquet(f"{tmp_path}/out")
    said = spark.read.parquet(f"{tmp_path}/out").selectExpr("sum(length(times)) AS n").first().n
    assert said > 6 * sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet"))
