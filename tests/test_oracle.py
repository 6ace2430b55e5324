"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest
from conftest import SF_SMALL

from oracle_check import compare, duck
from tideline.plans.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert r["status"] in ("ok", "rows-only"), r
    if name in ORACLE:
        assert r["spark_rows"] == r["oracle_rows"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["Country", "start", "end", "Total_sales"]
    assert df.count() > 0
    assert set(e.queries()) >= set(QUERIES)
