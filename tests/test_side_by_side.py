"""Steps that run side by side, and inputs that are derived once."""

import threading

import pytest
from pyspark.sql import functions as F

from twintally.operators import platform as PL
from twintally.plans import pipeline as P
from twintally.plans import queries as Q
from twintally.session import together
from twintally.sources import fixture, fixture_files
from twintally.sources.tables import list_dirs


@pytest.fixture()
def orders(spark, tmpdir_path):
    rows = spark.range(3000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 90).alias("o_custkey"),
                                    F.when(F.col("id") % 2 == 0, "O").otherwise("F").alias("o_orderstatus"))
    rows.write.parquet(f"{tmpdir_path}/orders.parquet")
    return tmpdir_path


def test_steps_run_side_by_side_and_keep_their_order(spark):
    both = threading.Barrier(2, timeout=60)         # broken unless two steps wait for each other
    assert together(spark, [lambda: (both.wait(), "a")[1], lambda: (both.wait(), "b")[1]]) == ["a", "b"]
    ended = []

    def fails():
        raise ValueError("step")

    with pytest.raises(ValueError, match="step"):
        together(spark, [fails, lambda: ended.append(spark.range(10).count())])
    assert ended == [10]


def test_change_tables_are_merged_side_by_side(spark, orders, tmpdir_path, monkeypatch):
    zones = fixture_files.write_landing(fixture.load(spark, orders), f"{tmpdir_path}/landing")
    all_in = threading.Barrier(4, timeout=120)
    monkeypatch.setattr(P, "merge_upsert", lambda *a, **k: (all_in.wait(), {"partitions": []})[1])
    log = P.ingest_cdc(spark, zones["internal"], P.Lake(f"{tmpdir_path}/lake"), P.landed_arrival_dates(spark, zones))
    assert list(log) == ["sub_initial", "sub_recursion_success", "sub_recursion_failure", "user_churn_events"]


def test_a_query_renders_only_the_files_it_reads(spark, orders):
    root = Q.landing_root(spark, orders, feeds=False, tables=("sub_recursion_failure",))
    assert list_dirs(spark, root["operator_feeds"]) == []
    assert {d.rsplit("_telco", 1)[0].rsplit("_wallet", 1)[0] for d in list_dirs(spark, root["internal"])} == {"sub_recursion_failure"}
    assert Q.landing_root(spark, orders) == root    # the rest, in the same place
    assert len(list_dirs(spark, root["operator_feeds"])) == 6 and len(list_dirs(spark, root["internal"])) == 19


def test_rendered_rows_are_those_of_the_fixture(spark, orders, tmpdir_path, monkeypatch):
    fx, derived = fixture.load(spark, orders), []
    table = fixture.Fixture.table
    monkeypatch.setattr(fixture.Fixture, "table", lambda self, name: (derived.append(name), table(self, name))[1])
    fixture_files.write_cdc_files(fx, tmpdir_path + "/internal", ("sub_recursion_success",))
    assert sorted(derived) == ["fx_churn", "fx_platform_all"]
    image = PL.read_cdc(spark, tmpdir_path + "/internal", "sub_recursion_success")
    want = fx.platform_all().where("event_type = 'recursion_success'")
    key = [F.col("operator_code"), F.col("user_id"), F.col("sub_id"), F.col("partner_txn_id"), F.col("amount").cast("double")]
    got, exp = (image.select("recursion_id", *key), want.select("platform_event_id", *key))
    assert got.count() == exp.count() > 1000 and got.exceptAll(exp).isEmpty()


def test_planted_rows_are_repeated_without_a_second_computation(spark):
    df = spark.createDataFrame([("telco_a", 1), ("telco_a", 1), ("telco_b", 2), (None, 3)], "operator_code string, n int")
    out = Q._repeated(df, F.col("operator_code") == Q.PLANTED)
    plain = df.unionByName(df.where(F.col("operator_code") == Q.PLANTED))
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect())) and out.count() == 6
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_streams_to_colocate_are_derived_once(spark, orders, monkeypatch):
    written = []
    replace = Q.B.replace_days
    monkeypatch.setattr(Q.B, "replace_days", lambda df, *a, **k: (written.append(df), replace(df, *a, **k))[1])
    Q._colocated(spark, orders)
    assert len(written) == 6
    assert all("orders.parquet" not in f for df in written for f in df.inputFiles())
