"""Checks tied to a run: counts, the decision, and what is left behind when a run is stopped."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from test_restatement import DAYS, RUN, deliver, put_feed, tables, zones
from twintally.config import ReconConfig
from twintally.operators import gate as G
from twintally.plans import pipeline as P
from twintally.sinks.partitions import read_table

ROWS = [("a", "1", 5), ("a", "1", None), ("a", "2", -1), ("b", None, -2), ("b", None, 7), ("b", "3", 0), (None, "1", 3), (None, "1", -9)]
RULES = [G.Constraint("no_negative", "t", violation=lambda: F.col("v") < 0),
         G.Constraint("v_given", "t", violation=lambda: F.col("v").isNull(), severity="warn"),
         G.Constraint("k_once", "t", unique=("op", "k")),
         G.Constraint("k_once_given", "t", unique=("op", "k"), among=lambda: F.col("k").isNotNull() & (F.col("v") > 0)),
         G.Constraint("never", "t", violation=lambda: F.col("v") > 100)]
WANT = {"no_negative": 3, "v_given": 1, "k_once": 3, "k_once_given": 0, "never": 0}


def test_all_constraints_of_a_table_in_one_scan(spark, tmpdir_path):
    spark.createDataFrame(ROWS, "op string, k string, v int").write.parquet(f"{tmpdir_path}/t")
    df = spark.read.parquet(f"{tmpdir_path}/t")
    got = G.report({"t": df}, RULES)
    assert {r["constraint_name"]: r["violations"] for r in got.collect()} == WANT
    assert {r["constraint_name"] for r in got.where("passed").collect()} == {n for n, v in WANT.items() if not v}
    plan = G.findings(df, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    empty = {r["violations"] for r in G.report({"t": df.limit(0)}, RULES).collect()}
    assert empty == {0}


def test_rules_are_checked_when_they_are_made():
    with pytest.raises(ValueError, match="either a row predicate or a key"):
        G.Constraint("x", "t")
    with pytest.raises(ValueError, match="unknown severity"):
        G.Constraint("x", "t", unique=("a",), severity="fatal")
    out = G.decide(RULES, {("t", "v_given"): 4, ("t", "k_once"): 2})
    assert [r["constraint_name"] for r in G.refused(out)] == ["k_once"] and not out[1]["passed"] and out[0]["passed"]


def test_a_violation_leaves_the_published_tables_and_the_next_run_catches_up(spark, tmpdir_path):
    root, day = f"{tmpdir_path}/landing", lambda d: [dt.date(2024, 1, int(d[6:]))]
    for d in DAYS:
        deliver(root, d)
    lake = P.Lake(f"{tmpdir_path}/lake")
    log = P.restate(spark, zones(root), lake, day(DAYS[0]), run_ts=RUN)
    assert all(r["passed"] for r in log["checks"]) and dict(log["status_summary"])["MATCHED"] == 2
    before = {n: t for n, t in tables(spark, lake).items() if n in ("fact", "daily", "monthly")}
    planted = [*G.default_constraints(), G.Constraint("no_t5", G.FACT, violation=lambda: F.col("partner_txn_id") == "t5")]
    with pytest.raises(G.QualityGateError, match="fact_reconciliation_break.no_t5") as stopped:
        P.restate(spark, zones(root), lake, day(DAYS[1]), run_ts=RUN, constraints=planted)
    assert [r["constraint_name"] for r in G.refused(stopped.value.results)] == ["no_t5"]
    after = tables(spark, lake)
    assert {n: after[n] for n in before} == before
    assert P.pending_dates(spark, lake) == {dt.date(2024, 1, 16)}
    kept = {(r["constraint_name"], r["published"]) for r in read_table(spark, lake.check_results).where("not passed").collect()}
    assert kept == {("no_t5", False), ("matched_rows_balanced", False)} or kept == {("no_t5", False)}
    # the next run, of other arrivals, publishes the stopped dates as well
    P.restate(spark, zones(root), lake, [dt.date(2024, 1, int(d[6:])) for d in DAYS[2:]], run_ts=RUN)
    assert P.pending_dates(spark, lake) == set()
    one = P.Lake(f"{tmpdir_path}/one")
    P.restate(spark, zones(root), one, None, run_ts=RUN)
    assert tables(spark, lake) == tables(spark, one)


def test_a_moved_correction_counts_twice_until_versions_are_ranked_across_dates(spark, tmpdir_path):
    root = f"{tmpdir_path}/landing"
    for op in P.FEEDS:
        os.makedirs(f"{root}/operator_feeds/{op}", exist_ok=True)
    put_feed(root, "telco_a", "20240115", [(f"t{i}", "a", "SUB", "10.00", f"2024-01-{10 + i} 12:00:00") for i in range(5)])
    put_feed(root, "telco_a", "20240120", [("t2", "a", "SUB", "10.00", "2024-01-18 12:00:00")])
    first, second = [dt.date(2024, 1, 15)], [dt.date(2024, 1, 20)]
    plain = P.Lake(f"{tmpdir_path}/plain")
    P.restate(spark, zones(root), plain, first, run_ts=RUN)
    with pytest.raises(G.QualityGateError, match="partner_counted_once"):      # t2 is published on the 12th and new on the 18th
        P.restate(spark, zones(root), plain, second, run_ts=RUN)
    log = P.restate(spark, zones(root), plain, second, run_ts=RUN, stop=False)
    assert {r["constraint_name"] for r in log["checks"] if not r["passed"]} == {"partner_counted_once"}

    cfg = ReconConfig(rank_before_date_filter=True)
    lake = P.Lake(f"{tmpdir_path}/lake")
    P.restate(spark, zones(root), lake, first, cfg, RUN)
    log = P.restate(spark, zones(root), lake, second, cfg, RUN)
    assert log["business_dates"] == 2 and all(r["passed"] for r in log["checks"])          # the 12th and the 18th
    got = {(r["partner_txn_id"], r["business_date"].day) for r in read_table(spark, lake.fact).collect()}
    assert got == {("t0", 10), ("t1", 11), ("t2", 18), ("t3", 13), ("t4", 14)}


def test_current_versions_follow_every_arrival(spark, tmpdir_path):
    root, lake = f"{tmpdir_path}/landing", P.Lake(f"{tmpdir_path}/lake")
    for op in P.FEEDS:
        os.makedirs(f"{root}/operator_feeds/{op}", exist_ok=True)
    cfg = ReconConfig(rank_before_date_filter=True)

    def arrive(day, rows, cfg=cfg):
        """Days touched, and where each transaction then lies."""
        put_feed(root, "telco_a", f"202401{day}", [(i, "a", "SUB", "10.00", f"2024-01-{d} 12:00:00") for i, d in rows])
        log = P.ingest_operator_feeds(spark, f"{root}/operator_feeds", lake, [dt.date(2024, 1, day)], RUN, cfg)
        P.build_silver_partner(spark, lake, log["business_dates"], cfg)
        held = {(r["partner_txn_id"], r["business_date"].day) for r in P.silver_partner(spark, lake).collect()}
        return [d.day for d in log["business_dates"]], held

    start = {(f"t{i}", 10 + i) for i in range(4)}
    assert arrive(15, sorted(start)) == ([10, 11, 12, 13], start)
    assert arrive(20, [("t2", 18)]) == ([12, 18], start - {("t2", 12)} | {("t2", 18)})
    # an older arrival comes late: what is current stays
    assert arrive(16, [("t2", 14)])[1] == start - {("t2", 12)} | {("t2", 18)}
    # the correction is withdrawn: its file comes again with another row; the latest remaining version is current
    assert arrive(20, [("t9", 19)]) == ([14, 18, 19], start - {("t2", 12)} | {("t2", 14), ("t9", 19)})
    # re-dated within a file of the same arrival date: the new content counts, also on an earlier day
    assert arrive(20, [("t9", 17)]) == ([17, 19], start - {("t2", 12)} | {("t2", 14), ("t9", 17)})
    # an arrival without cross-date ranking drops the directory; the next one with it builds it anew
    arrive(21, [("t9", 16)], ReconConfig())
    assert not P.transaction_directory(spark, lake).usable()
    assert arrive(22, [("t1", 22)]) == ([11, 22], start - {("t2", 12), ("t1", 11)} | {("t2", 14), ("t9", 16), ("t9", 17), ("t1", 22)})


def test_a_run_registers_and_exports_its_tables(spark, tmpdir_path):
    root = f"{tmpdir_path}/landing"
    deliver(root, DAYS[0])
    lake = P.Lake(f"{tmpdir_path}/lake")
    P.restate(spark, zones(root), lake, None, run_ts=RUN, register_as="gate_")
    for d in DAYS[1:]:
        deliver(root, d)
    log = P.restate(spark, zones(root), lake, [dt.date(2024, 1, int(d[6:])) for d in DAYS[1:]], run_ts=RUN, register_as="gate_",
                    export_to=f"{tmpdir_path}/export")
    assert "gate_gold.fact_reconciliation_break" in log["registered"] and len(log["registered"]) >= 8
    for (layer, table), path in lake.tables().items():
        if f"gate_{layer}.{table}" in log["registered"]:
            key = lambda f: sorted(map(str, f.collect()))
            stored = read_table(spark, path)
            cols = sorted(stored.columns)
            assert key(spark.table(f"gate_{layer}.{table}").select(*cols)) == key(stored.select(*cols)), table
            assert key(spark.read.parquet(f"{tmpdir_path}/export/{layer}/{table}").select(*cols)) == key(stored.select(*cols)), table
