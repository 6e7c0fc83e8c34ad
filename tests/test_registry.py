"""Every registered query against its DuckDB twin at sf0.01 (the driver's
correctness gate), plus the entry smoke check."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck
from paths import SF01
from tidemark.plans.registry import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, E.queries()[name], E.oracle_sql()[name], SF01)
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], (r.get("only_spark"), r.get("only_oracle"))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
