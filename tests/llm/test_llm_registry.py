"""Registered queries of this subpackage on the smallest tables."""

import pytest
from conftest import SF_SMALL
from oracle_check import compare, duck

from tideline.llm.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["status"] == "ok", r
