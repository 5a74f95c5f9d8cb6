"""Hand-made edge tables for the matcher, overlays, parsing and sinks."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D0, dec, frames, i_row, p_row
from twintally.config import FEEDS, ReconConfig
from twintally.functions.money import amounts_match
from twintally.operators import normalize as N
from twintally.operators import quality as Q
from twintally.operators.matching import AmountBuckets, Match
from twintally.operators.reconcile import fact_breaks


def statuses(df):
    return sorted((r["partner_txn_id"], r["platform_event_id"], r["recon_status"], r["match_confidence"])
                  for r in df.collect())


def test_strong_and_tolerance_boundaries(spark):
    # exactly 0.01 apart, exactly 0.5 %, just over 0.5 %, NULL amount
    p, i, _ = frames(spark, [
        p_row("a", 100.00), p_row("b", 200.00), p_row("c", 200.00), p_row("d", None)],
        [i_row("e1", 100.01, "a"), i_row("e2", 199.00, "b"), i_row("e3", 198.99, "c"), i_row("e4", 5, "d")])
    got = {r["partner_txn_id"]: r["recon_status"] for r in Match(p, i).strong.collect()}
    assert got == {"a": "MATCHED", "b": "MATCHED", "c": "AMOUNT_MISMATCH", "d": "AMOUNT_MISMATCH"}


def test_null_partner_ids_are_each_classified(spark):
    # two NULL-id partner rows: neither strong; each gets its own outcome
    p, i, _ = frames(spark, [p_row(None, 99, acct="x"), p_row(None, 149, acct="y")],
                     [i_row("e1", 99, None)])
    f = fact_breaks(p, i, None)
    rows = sorted((r["partner_amount"], r["recon_status"]) for r in f.collect())
    assert rows == [(dec(99), "MATCHED"), (dec(149), "MISSING_ON_PLATFORM")]


def test_same_id_at_two_operators(spark):
    p, i, _ = frames(spark, [p_row("x", 99, op="telco_a"), p_row("x", 99, op="telco_b")],
                     [i_row("e1", 99, "x", op="telco_a")])
    f = fact_breaks(p, i, None)
    got = sorted((r["operator_code"], r["recon_status"]) for r in f.collect())
    assert got == [("telco_a", "MATCHED"), ("telco_b", "MISSING_ON_PLATFORM")]


def test_two_platform_events_on_one_key_fan_out_and_are_reported(spark):
    p, i, _ = frames(spark, [p_row("x", 99)], [i_row("e1", 99, "x"), i_row("e2", 99, "x")])
    f = fact_breaks(p, i, None)
    assert f.count() == 2
    assert Q.dq_no_double_counting(f).count() == 1


def test_fallback_best_per_partner_and_platform_reuse(spark):
    # both partners pick the same closest platform row (fan-out is kept)
    p, i, _ = frames(spark, [p_row("a", 100.00), p_row("b", 100.00)],
                     [i_row("e2", 100.00), i_row("e1", 100.00), i_row("e9", 100.30)])
    f = fact_breaks(p, i, None)
    fb = sorted((r["partner_txn_id"], r["platform_event_id"]) for r in f.where("match_confidence='fallback'").collect())
    assert fb == [("a", "e1"), ("b", "e1")]
    # e2 and e9 were not used -> MISSING_AT_PARTNER
    mp = sorted(r["platform_event_id"] for r in f.where("recon_status='MISSING_AT_PARTNER'").collect())
    assert mp == ["e2", "e9"]
    assert Q.dq_platform_reused(f).count() == 1


def test_fallback_prefers_closest_amount_then_smallest_id(spark):
    p, i, _ = frames(spark, [p_row("a", 200.00)],
                     [i_row("e5", 199.50), i_row("e3", 200.50), i_row("e4", 200.90)])
    fb = Match(p, i).fallback.collect()
    assert [(r["platform_event_id"], r["internal_amount"]) for r in fb] == [("e3", dec(200.50))]


def test_declines_are_not_missing_at_partner(spark):
    p, i, _ = frames(spark, [], [i_row("f1", 0, None, ty="recursion_failure")])
    assert fact_breaks(p, i, None).count() == 0


def test_churn_overlay_dates_and_amount_sign(spark):
    churn = [("u-1", "telco_a", dt.datetime(2024, 1, 10, 8), "voluntary", None),
             ("u-1", "telco_a", dt.datetime(2024, 1, 20, 8), "voluntary", None),
             ("u-2", "telco_a", dt.datetime(2024, 1, 16, 8), "voluntary", None)]
    p, i, c = frames(spark, [p_row("a", 99, acct="x"), p_row("b", 99), p_row("z", 0)],
                     [i_row("e1", 99, "a", user="u-1"), i_row("e2", 99, "b", user="u-2"),
                      i_row("e3", 0, "z", user="u-1")], churn)
    got = {r["partner_txn_id"]: r["recon_status"] for r in fact_breaks(p, i, c).collect()}
    # u-1 churned before the date (first churn counts); u-2 only after; zero amount never orphan
    assert got == {"a": "ORPHAN_CHURN", "b": "MATCHED", "z": "MATCHED"}


def test_late_arrival_only_overrides_matched(spark):
    late = D0 + dt.timedelta(days=3)
    p, i, _ = frames(spark, [p_row("a", 99, arrival=late), p_row("b", 99, arrival=late)],
                     [i_row("e1", 99, "a"), i_row("e2", 150, "b")])
    got = {r["partner_txn_id"]: (r["recon_status"], r["is_late_arrival"]) for r in fact_breaks(p, i, None).collect()}
    assert got == {"a": ("LATE_ARRIVAL", True), "b": ("AMOUNT_MISMATCH", True)}


def test_negative_amounts_and_refunds(spark):
    p, i, _ = frames(spark, [p_row("r", -99, ty="refund"), p_row("n", -100.00)],
                     [i_row("e1", -100.40, "n")])
    got = {r["partner_txn_id"]: r["recon_status"] for r in fact_breaks(p, i, None).collect()}
    assert got == {"r": "MISSING_ON_PLATFORM", "n": "MATCHED"}


def test_amount_buckets_cover_every_matching_pair():
    bk = AmountBuckets.for_config(ReconConfig())
    import math

    def b(a):
        return math.floor(math.log(max(abs(a), bk.floor)) / bk.width)

    rnd = random.Random(7)
    for _ in range(20000):
        p = Decimal(rnd.randint(-10**7, 10**7)) / 100
        d = Decimal(rnd.randint(-600, 600)) / 100000 * abs(p) + Decimal(rnd.randint(-2, 2)) / 100
        i = (p + d).quantize(Decimal("0.01"))
        diff = abs(p - i)
        ok = diff <= Decimal("0.01") or diff <= Decimal("0.005") * max(abs(p), Decimal("0.01"))
        if ok and (p >= 0) == (i >= 0):
            assert abs(b(float(p)) - b(float(i))) <= 1, (p, i)


def test_bucketed_fallback_equals_brute_force(spark):
    rnd = random.Random(11)
    prow, irow = [], []
    for n in range(300):
        op = rnd.choice(["telco_a", "telco_b"])
        base = rnd.choice([99, 149, 299, 499, 1000, 0.5, 2.0])
        prow.append(p_row(f"p{n:03d}", round(base * (1 + rnd.uniform(-0.01, 0.01)), 2), op=op,
                          bd=D0 + dt.timedelta(days=rnd.randint(0, 1))))
    for n in range(200):
        op = rnd.choice(["telco_a", "telco_b"])
        base = rnd.choice([99, 149, 299, 499, 1000, 0.5, 2.0])
        irow.append(i_row(f"e{n:03d}", round(base * (1 + rnd.uniform(-0.01, 0.01)), 2), None, op=op,
                          bd=D0 + dt.timedelta(days=rnd.randint(0, 1))))
    p, i, _ = frames(spark, prow, irow)
    got = sorted((r["partner_txn_id"], r["platform_event_id"]) for r in Match(p, i).fallback.collect())
    # brute force in Python
    want = []
    for pr in prow:
        best = None
        for ir in irow:
            if (pr[0], pr[9]) != (ir[0], ir[9]):
                continue
            a, b = pr[5], ir[7]
            diff = abs(a - b)
            if diff <= Decimal("0.01") or diff <= Decimal("0.005") * max(abs(a), Decimal("0.01")):
                key = (diff, ir[1])
                best = key if best is None or key < best else best
        if best is not None:
            want.append((pr[1], best[1]))
    assert got == sorted(want)


def test_windowed_fallback_reaches_adjacent_day(spark):
    p, i, _ = frames(spark, [p_row("a", 99, bd=D0)], [i_row("e1", 99, None, bd=D0 + dt.timedelta(days=1))])
    assert Match(p, i).fallback.count() == 0
    fb = Match(p, i, ReconConfig(fallback_window_days=1)).fallback.collect()
    assert [r["platform_event_id"] for r in fb] == ["e1"]


def test_latest_arrival_and_moved_correction(spark):
    d1 = D0 + dt.timedelta(days=1)
    rows = [p_row("a", 99, bd=D0, arrival=D0), p_row("a", 100, bd=D0, arrival=d1),
            p_row("m", 99, bd=D0, arrival=D0), p_row("m", 99, bd=d1, arrival=d1)]
    p, _, _ = frames(spark, rows, [])
    per_date = N.latest_arrival(p, per_business_date=True)
    got = sorted((r["partner_txn_id"], str(r["business_date"]), r["amount"]) for r in per_date.collect())
    # default (one day at a time): the moved correction leaves both copies
    assert got == [("a", "2024-01-15", dec(100)), ("m", "2024-01-15", dec(99)), ("m", "2024-01-16", dec(99))]
    across = N.latest_arrival(p, per_business_date=False)
    assert sorted(r["partner_txn_id"] for r in across.collect()) == ["a", "m"]


def test_quarantine_keeps_bad_text_out_of_silver(spark):
    feed = FEEDS["telco_a"]
    raw = spark.createDataFrame(
        [("t1", "acct", "SUB", "P", "99.0", "pkr", "2024-01-15 10:00:00", D0),
         ("t2", "acct", "SUB", "P", "n/a", None, "2024-01-15 10:00:00", D0),
         ("t3", "acct", "XX", "P", "10", "", "not-a-time", D0)],
        "transaction_id string, phone_number string, event_type string, plan string, value string, "
        "ccy string, created_at string, file_arrival_date date")
    bronze = N.stamp_ingest_metadata(raw, feed)
    silver = N.silver_partner_events(bronze).collect()
    assert [(r["partner_txn_id"], r["currency"], str(r["txn_ts_utc"])) for r in silver] == \
        [("t1", "PKR", "2024-01-15 05:00:00")]
    q = sorted((r["partner_txn_id"], r["reason"]) for r in N.quarantined(N.normalize_partner(bronze)).collect())
    assert q == [("t2", "unparsable_amount"), ("t3", "unparsable_time")]


def test_zulu_text_is_utc_whatever_the_session_zone(spark):
    from twintally.config import FEEDS
    from twintally.functions.timestamps import parse_feed_time
    spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
    try:
        df = spark.createDataFrame([("2024-01-15T10:00:00Z",)], "t string")
        epoch = df.select(F.unix_timestamp(parse_feed_time(F.col("t"), FEEDS["wallet_x"])[0]).alias("e")).first()["e"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert epoch == int(dt.datetime(2024, 1, 15, 10, tzinfo=dt.timezone.utc).timestamp())


def test_unknown_format_is_an_error(spark):
    from dataclasses import replace

    from twintally.sources.landing import scan_feed
    with pytest.raises(ValueError):
        scan_feed(spark, "/nonexistent", replace(FEEDS["telco_a"], file_format="xml"))


def test_json_cdc_with_all_null_key_column(spark, tmpdir_path):
    from twintally.operators.platform import CDC_SCHEMAS
    from twintally.sources.landing import scan_json_cdc
    d = f"{tmpdir_path}/sub_initial_telco_a/batch=sub_initial_telco_a_20240115"
    import os
    os.makedirs(d)
    with open(f"{d}/part-0.json", "w") as fh:
        fh.write('{"sub_id": "s1", "partner_txn_id": null, "amount": 99.0}\n')
    df = scan_json_cdc(spark, tmpdir_path, "sub_initial_telco_a", CDC_SCHEMAS["sub_initial"])
    assert dict(df.dtypes)["partner_txn_id"] == "string"
    assert df.first()["file_arrival_date"] == D0


def test_replace_partitions_clears_empty_and_rejects_strays(spark, tmpdir_path):
    from twintally.sinks.partitions import read_table, replace_partitions
    from twintally.sources.tables import table_exists
    path = f"{tmpdir_path}/t"
    d1, d2 = D0, D0 + dt.timedelta(days=1)
    df = spark.createDataFrame([(1, d1), (2, d2)], "v int, business_date date")
    replace_partitions(df, path, ["business_date"], [(d1,), (d2,)])
    assert table_exists(spark, path)
    # empty replacement of d2 removes it; d1 untouched
    empty = spark.createDataFrame([], "v int, business_date date")
    m = replace_partitions(empty, path, ["business_date"], [(d2,)])
    assert m["partitions_cleared"] == 1
    assert [r["v"] for r in read_table(spark, path).collect()] == [1]
    with pytest.raises(Exception):
        replace_partitions(spark.createDataFrame([(9, d1)], "v int, business_date date"), path,
                           ["business_date"], [(d2,)])
    assert [r["v"] for r in read_table(spark, path).collect()] == [1]


def test_merge_upsert_updates_inserts_and_null_keys(spark, tmpdir_path):
    from twintally.sinks.partitions import merge_upsert, read_table
    path = f"{tmpdir_path}/m"
    ddl = "id string, operator_code string, v int, file_arrival_date date"
    merge_upsert(spark.createDataFrame([("a", "x", 1, D0), ("b", "x", 1, D0)], ddl), path, ["id", "operator_code"],
                 ["operator_code"])
    d1 = D0 + dt.timedelta(days=1)
    merge_upsert(spark.createDataFrame([("a", "x", 2, d1), ("a", "x", 3, D0), (None, "x", 7, d1)], ddl), path,
                 ["id", "operator_code"], ["operator_code"])
    got = sorted((r["id"] or "-", r["v"]) for r in read_table(spark, path).collect())
    assert got == [("-", 7), ("a", 2), ("b", 1)]


def test_match_rate_rounds_half_up(spark):
    from twintally.operators.marts import match_rate
    df = spark.createDataFrame([(1, 32), (2, 3), (0, 0), (5, 160)], "m long, n long")
    got = [r[0] for r in df.select(match_rate(F.col("m"), F.col("n"))).collect()]
    assert got == [0.0313, 0.6667, None, 0.0313]


def test_amounts_match_is_null_aware(spark):
    df = spark.createDataFrame([(dec(1), None)], "p decimal(12,2), i decimal(12,2)")
    assert df.select(amounts_match(F.col("p"), F.col("i")).alias("m")).first()["m"] is None


def test_merge_upsert_moves_a_redated_key(spark, tmpdir_path):
    from twintally.sinks.partitions import merge_upsert, read_table
    path = f"{tmpdir_path}/moved"
    ddl = "id string, operator_code string, event_date date, v int, file_arrival_date date"
    d1, d2 = D0, D0 + dt.timedelta(days=1)
    merge_upsert(spark.createDataFrame([("a", "x", d1, 1, d1), ("b", "x", d2, 1, d1)], ddl), path,
                 ["id", "operator_code"], ["operator_code", "event_date"])
    # "a" is re-dated to d2: its old copy in d1 must go, and d1 becomes empty
    m = merge_upsert(spark.createDataFrame([("a", "x", d2, 2, d2)], ddl), path, ["id", "operator_code"],
                     ["operator_code", "event_date"])
    got = sorted((r["id"], str(r["event_date"]), r["v"]) for r in read_table(spark, path).collect())
    assert got == [("a", "2024-01-16", 2), ("b", "2024-01-16", 1)]
    assert m["partitions_cleared"] == 1


def test_arrival_tokens_dashed_or_compact(spark, tmpdir_path):
    import os

    from twintally.sources.landing import scan_csv_feed
    feed = FEEDS["telco_a"]
    for name, day in (("telco_a_20240115.csv", "15"), ("telco_a_2024-01-16.csv", "16")):
        os.makedirs(f"{tmpdir_path}/telco_a", exist_ok=True)
        with open(f"{tmpdir_path}/telco_a/{name}", "w") as fh:
            fh.write(",".join(feed.raw_columns) + "\n")
            fh.write(f"t{day},acct,SUB,P,99.0,PKR,2024-01-{day} 10:00:00\n")
    all_ = scan_csv_feed(spark, tmpdir_path, feed)
    assert sorted(str(r["file_arrival_date"]) for r in all_.collect()) == ["2024-01-15", "2024-01-16"]
    one = scan_csv_feed(spark, tmpdir_path, feed, dates=["2024-01-16"])
    assert [r["transaction_id"] for r in one.collect()] == ["t16"]
    assert scan_csv_feed(spark, tmpdir_path, feed, dates=["2024-02-01"]) is None


def test_tier1_hot_platform_key_is_skew_split_and_equals_full_outer(spark):
    # a sentinel partner id on a third of the platform rows: the left outer +
    # anti join form gives the full outer join's rows, and adaptive execution
    # splits the hot partition (a full outer join is never split)
    n = 30000
    prow = [p_row(f"k{j}", 10 + j % 50) for j in range(n // 2)] + [p_row("", 99)]
    irow = [i_row(f"e{j}", 10 + j % 50, f"k{j}" if j % 3 else "") for j in range(n)]
    # a NULL key part never matches: both rows stay, each as a remainder
    prow.append(p_row("k1", 5, op=None))
    irow.append(i_row("eN", 5, "k1", op=None))
    p, i, _ = frames(spark, prow, irow)

    def tier1(cfg):
        return Match(p, i, cfg, persist=False).tier1.select("p.partner_txn_id", "i.platform_event_id")

    conf = {"spark.sql.shuffle.partitions": "64",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        keys = ["business_date", "operator_code", "partner_txn_id"]
        joined = p.select(*keys, F.col("partner_txn_id").alias("x")).join(
            i.select(*keys, "platform_event_id"), keys, "full_outer").select("x", "platform_event_id")
        want = sorted(map(tuple, joined.collect()), key=str)
        t = tier1(ReconConfig())
        got = sorted(map(tuple, t.collect()), key=str)
        plan = t._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    # 30000 platform rows (10000 paired with the sentinel) + 5000 partner-only
    # + the two NULL-operator rows
    assert got == want and len(got) == 35002
    assert ("k1", None) in got and (None, "eN") in got
    assert "FullOuter" not in plan
    assert "skew=true" in plan
