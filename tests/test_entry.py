"""Driver contract: entry smoke, and every SQL-checked query equals its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tests.harness import compare, duck


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert "prediction" in df.columns and len(rows) > 0
    assert {r.prediction for r in rows} <= {0, 1}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    res = compare(spark, name, SF001, con)
    assert res["check"] == "ok", res
