"""Landing files in the feeds' own shapes, and restatement against one-shot builds."""

import json
import os

import pytest
from pyspark.sql import functions as F

from twintally.config import FEEDS
from twintally.operators import normalize as N
from twintally.operators import platform as PL
from twintally.plans import pipeline as P
from twintally.sinks.partitions import in_partitions, merge_upsert, read_table, replace_partitions
from twintally.sources.landing import scan_feed
from twintally.sources.tables import table_exists
from twintally.streaming.arrivals import restate_on_arrival

RUN = "2024-02-01 00:00:00"


def put_feed(root, op, day, rows, extra=(), ext=None, folder=False):
    """rows: (id, account, code, amount, time text) in the feed's own layout."""
    feed = FEEDS[op]
    names = list(feed.column_map)
    full = [dict(zip(names, (i, a, c, "p", v, "", t))) | dict(extra) for i, a, c, v, t in rows]
    ext = ext or feed.file_format
    base = f"{root}/operator_feeds/{op}"
    path = f"{base}/batch={op}_{day}/part-0.{ext}" if folder else f"{base}/{op}_{day}.{ext}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        if feed.file_format == "csv":
            sep = feed.csv_options["sep"]
            head = names + [k for k, _ in extra]
            f.write("\n".join([sep.join(head), *[sep.join(str(r[k]) for k in head) for r in full]]) + "\n")
        else:
            f.write("".join(json.dumps(r) + "\n" for r in full))


def put_changes(root, table, op, day, rows):
    folder = f"{table}_{op}" if op else table
    os.makedirs(f"{root}/internal/{folder}", exist_ok=True)
    with open(f"{root}/internal/{folder}/{folder}_{day}.json", "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows))


def sub(i, user, txn, at, amount=10.0, status="active", **more):
    return dict(sub_id=i, user_id=user, operator_code="telco_a", plan_id="p", partner_txn_id=txn, status=status,
                created_ts=at, amount=amount, **more)


def zones(root):
    for z in ("operator_feeds", "internal"):
        os.makedirs(f"{root}/{z}", exist_ok=True)
    return {z: f"{root}/{z}" for z in ("operator_feeds", "internal")}


def deliver(root, day):
    """What arrives on each day; a second delivery of a day replaces its files."""
    t = lambda d, h=12: f"2024-01-{d:02d} {h:02d}:00:00"
    if day == "20240115":
        put_feed(root, "telco_a", day, [("t1", "a1", "SUB", "10.00", t(15)), ("t3", "a3", "SUB", "10.00", t(15)),
                                        ("t4", "a4", "SUB", "10.00", t(20)), ("t9", "a9", "SUB", "10.00", "n/a")])
        put_changes(root, "sub_initial", "telco_a", day, [sub("s1", "u1", "t1", "2024-01-15T07:00:00"),
                                                          sub("s3", "u3", "t3", "2024-01-15T07:00:00"),
                                                          sub("s9", "u9", "t9", "garbage")])
    elif day == "20240116":                              # no recursion files, one pending then active
        put_feed(root, "telco_a", day, [("t5", "a5", "SUB", "10.00", t(16))])
        put_changes(root, "sub_initial", "telco_a", day, [sub("s5", "u5", None, "2024-01-16T10:00:00", 10.04, "pending"),
                                                          sub("s5", "u5", None, "2024-01-16T11:00:00", 10.04)])
    elif day == "20240117":                              # s1 fails later: the charge is withdrawn
        put_changes(root, "sub_initial", "telco_a", day, [sub("s7", "u7", "t7", "2024-01-17T10:00:00", status="failed")])
        put_changes(root, "sub_recursion_success", "telco_b", day, [
            dict(recursion_id="r1", sub_id="s1", user_id="u1", operator_code="telco_b", partner_txn_id="b1", amount=5.0,
                 recurrence_ts="2024-01-17T10:00:00", billing_cycle=2)])
    elif day == "20240118":                              # late churn of u1, and s3 is re-dated
        put_changes(root, "user_churn_events", None, day, [
            dict(user_id="u1", operator_code="telco_a", churn_ts="2024-01-14T00:00:00", churn_reason="x", last_known_sub_id="s1")])
        put_changes(root, "sub_initial", "telco_a", day, [sub("s3", "u3", "t3", "2024-01-16T07:00:00")])


DAYS = ["20240115", "20240116", "20240117", "20240118"]


def tables(spark, lake):
    out = {}
    for name in ("silver_partner", "silver_platform", "fact", "daily", "monthly", "quarantine_partner"):
        path = getattr(lake, name)
        frame = read_table(spark, path) if table_exists(spark, path) else None
        cols = sorted(c for c in frame.columns if not c.startswith("_")) if frame else []
        out[name] = sorted(tuple(str(v) for v in r) for r in frame.select(*cols).collect()) if frame else []
    return out


def restated(spark, root, where, steps):
    lake = P.Lake(where)
    for step in steps:
        P.restate(spark, zones(root), lake, None if step is None else [P._dt.date(2024, 1, int(d[6:])) for d in step], run_ts=RUN)
    return lake


def test_any_order_of_arrivals_equals_one_build(spark, tmpdir_path):
    root = f"{tmpdir_path}/landing"
    for d in DAYS:
        deliver(root, d)
    want = tables(spark, restated(spark, root, f"{tmpdir_path}/one", [None]))
    assert {r[0] for r in want["quarantine_partner"]} and want["fact"]
    # latest first, then an early day, the rest, and the early day once more
    steps = [[DAYS[3]], [DAYS[1], DAYS[0]], [DAYS[2]], [DAYS[0]]]
    got = tables(spark, restated(spark, root, f"{tmpdir_path}/steps", steps))
    for name in want:
        assert got[name] == want[name], name
    status = {r["partner_txn_id"]: r["recon_status"] for r in read_table(spark, f"{tmpdir_path}/one/gold/fact_reconciliation_break")
              .where("partner_txn_id is not null").select("partner_txn_id", "recon_status").collect()}
    assert status["t1"] == "ORPHAN_CHURN" and status["t4"] == "MISSING_ON_PLATFORM"


def test_withdrawn_rows_and_an_unfinished_run(spark, tmpdir_path):
    root = f"{tmpdir_path}/landing"
    for d in DAYS:
        deliver(root, d)
    lake = restated(spark, root, f"{tmpdir_path}/lake", [None])
    # the file of the 15th comes again without t4, whose date is the 20th
    put_feed(root, "telco_a", "20240115", [("t1", "a1", "SUB", "10.00", "2024-01-15 12:00:00")])
    P.restate(spark, zones(root), lake, [P._dt.date(2024, 1, 15)], run_ts=RUN)
    want = tables(spark, restated(spark, root, f"{tmpdir_path}/one", [None]))
    assert tables(spark, lake)["fact"] == want["fact"] and tables(spark, lake)["silver_partner"] == want["silver_partner"]
    # a run that ended before its index was complete: the partition is read all the same
    P._append_index(spark, lake, [("telco_a", P._dt.date(2024, 1, 16), None, 2**62, False)])
    P.build_silver_partner(spark, lake, [P._dt.date(2024, 1, 16)])
    assert tables(spark, lake)["silver_partner"] == want["silver_partner"]


def test_rank_across_dates_reads_every_arrival(spark, tmpdir_path):
    from twintally.config import ReconConfig
    root = f"{tmpdir_path}/landing"
    deliver(root, DAYS[0])
    cfg = ReconConfig(rank_before_date_filter=True)
    lake = P.Lake(f"{tmpdir_path}/lake")
    P.restate(spark, zones(root), lake, None, cfg, RUN)
    P.build_silver_partner(spark, lake, [P._dt.date(2024, 1, 20)], cfg)
    got = {r[0] for r in read_table(spark, lake.silver_partner).select("partner_txn_id").collect()}
    assert got == {"t1", "t3", "t4"}


def test_files_keep_their_columns_and_strays_are_ignored(spark, tmpdir_path):
    root = f"{tmpdir_path}/landing"
    row = lambda i, t="2024-01-15 10:00:00": (i, "a", "SUB", "1.00", t)
    put_feed(root, "telco_a", "20240115", [row("x1")])
    put_feed(root, "telco_a", "20240116", [row("x2")], extra=(("extra", "more"),), folder=True)
    put_feed(root, "telco_c", "20240115", [row("c1", "2024-01-15T10:00:00+04:00")], extra=(("new_field", "n"),))
    put_feed(root, "telco_c", "20240119", [row("c2", "2024-01-15T10:00:00+04:00")], ext="txt")
    for op in set(FEEDS) - {"telco_a", "telco_c"}:
        os.makedirs(f"{root}/operator_feeds/{op}", exist_ok=True)
    a = {r.transaction_id: r.extra for r in scan_feed(spark, f"{root}/operator_feeds", FEEDS["telco_a"]).collect()}
    assert a == {"x1": None, "x2": "more"}
    c = scan_feed(spark, f"{root}/operator_feeds", FEEDS["telco_c"]).collect()
    assert [(r.id, r.new_field) for r in c] == [("c1", "n")]
    bronze = N.bronze_operator_feeds(spark, f"{root}/operator_feeds", ingested_at=RUN)
    assert {"extra", "new_field"} <= set(bronze.columns) and N.normalize_partner(bronze).count() == 3
    put_changes(root, "sub_initial", "telco_a", "20240115", [sub("s1", "u", None, "2024-01-15T07:00:00", channel="app")])
    assert [r.channel for r in PL.read_cdc(spark, f"{root}/internal", "sub_initial").collect()] == ["app"]
    with open(f"{root}/operator_feeds/telco_a/telco_a_20240117.csv", "w") as f:
        f.write("transaction_id,plan\nq,p\n")
    with pytest.raises(ValueError, match="lacks the contract columns"):
        scan_feed(spark, f"{root}/operator_feeds", FEEDS["telco_a"])


def test_stream_takes_plain_files_and_refuses_undated_ones(spark, tmpdir_path):
    root = f"{tmpdir_path}/landing"
    for d in DAYS[:2]:
        deliver(root, d)
    lake = P.Lake(f"{tmpdir_path}/lake")
    assert restate_on_arrival(spark, zones(root), lake, f"{tmpdir_path}/ckpt", run_ts=RUN)
    assert tables(spark, lake) == tables(spark, restated(spark, root, f"{tmpdir_path}/one", [None]))
    assert restate_on_arrival(spark, zones(root), lake, f"{tmpdir_path}/ckpt", run_ts=RUN) == []
    with open(f"{root}/operator_feeds/telco_a/telco_a.csv", "w") as f:
        f.write("transaction_id\n")
    with pytest.raises(Exception, match="without an arrival date"):
        restate_on_arrival(spark, zones(root), lake, f"{tmpdir_path}/ckpt", run_ts=RUN)


def test_thousands_of_partitions(spark, tmpdir_path):
    dates = [(f"d{i:04d}",) for i in range(2000)]
    pairs = [(f"o{i % 30}", f"d{i:04d}") for i in range(3000)] + [("o1", None), (None, "d1")]
    frame = spark.createDataFrame([("o1", "d0001", 1), ("o1", None, 2), (None, "d1", 3), ("o9", "zz", 4)], "op string, d string, v int")
    assert sorted(r.v for r in frame.where(in_partitions(["op", "d"], pairs)).collect()) == [1, 2, 3]
    path = f"{tmpdir_path}/t"
    replace_partitions(spark.createDataFrame([("d0001", 1), ("d0002", 2)], "d string, v int"), path, ["d"], dates)
    replace_partitions(spark.createDataFrame([("d0002", 5)], "d string, v int"), path, ["d"], dates)
    assert [tuple(r) for r in read_table(spark, path).select("d", "v").collect()] == [("d0002", 5)]


def test_merge_keeps_the_newer_version(spark, tmpdir_path):
    path, cols = f"{tmpdir_path}/m", "k string, p string, at string, ts string, v string"
    make = lambda *rows: spark.createDataFrame(rows, cols)
    merge = lambda f: merge_upsert(f, path, ["k"], ["p"], ["at", "ts"])
    merge(make(("a", "x1", "15", "10", "pending"), ("b", "x1", "15", "10", "x")))
    out = merge(make(("a", "x2", "16", "10", "failed")))
    assert sorted(out["partitions"]) == [("x1",), ("x2",)]
    merge(make(("a", "x1", "15", "10", "pending")))                      # a replay of the older change
    merge(make(("c", "x1", "16", "10", "pending"), ("c", "x1", "16", "11", "active")))
    got = sorted((r.k, r.p, r.v) for r in read_table(spark, path).collect())
    assert got == [("a", "x2", "failed"), ("b", "x1", "x"), ("c", "x1", "active")]
