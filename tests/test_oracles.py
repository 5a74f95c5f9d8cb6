"""Every reconciliation query against its SQL statement (DuckDB) on the
smallest driver tables: same columns, row count and value hash."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck_connect
from twintally.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# beyond SQL; held against a brute-force version in the module named
BRUTE_FORCE = {"match_fallback_one_to_one_tolerance": "test_pairing"}


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) | set(BRUTE_FORCE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "recon_status" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert r["status"] == "MATCH", r
