"""The text operators' queries against their SQL on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from tallyloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF), duck.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda names, found: Counter(tuple(r[names.index(c)] for c in columns) for r in found)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
