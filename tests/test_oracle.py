"""Every registered query against its DuckDB oracle (the driver's gate), sf0.001."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tests.harness import compare, duck

NAMES = sorted(E.oracle_sql())


def test_every_query_has_an_oracle_or_is_listed():
    assert {n for n in set(E.queries()) - set(E.oracle_sql()) if not n.startswith("op") and n != "pipeline"} == set()
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    r = compare(df, con, E.oracle_sql()[name])
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 160
    assert "total_revenue" in df.columns
