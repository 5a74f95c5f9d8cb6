"""Corpus queries that SQL can express against their statements, on the smallest tables."""

import pytest

from oracle_compare import compare, duck_connect
from twintally.llm.oracles import ORACLES
from twintally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert r["status"] == "MATCH", r
