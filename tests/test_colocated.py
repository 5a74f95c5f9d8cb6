"""Bucketed silver tables: no exchange under the strong match, days replaced alone, hot keys."""

import uuid

import pytest
from helpers import PARTNER_DDL, PLATFORM_DDL, D0, i_row, p_row
from twintally.operators.matching import ColocatedMatch, Match
from twintally.session import scratch_path
from twintally.sinks import colocated as B


@pytest.fixture()
def streams(spark):
    db = f"colo_{uuid.uuid4().hex[:8]}"
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/db'")
    return db, root


def put(spark, streams, partner, platform, dates=(D0,), **more):
    db, root = streams
    for name, rows, ddl in (("p", partner, PARTNER_DDL), ("i", platform, PLATFORM_DDL)):
        B.replace_days(spark.createDataFrame(rows, ddl), f"{db}.{name}", f"{root}/{name}", dates, 4, **more)


def matched(spark, streams, **more):
    db = streams[0]
    return ColocatedMatch(B.read_days(spark, f"{db}.p"), B.read_days(spark, f"{db}.i"), persist=False, **more)


def rows_of(df):
    return sorted(map(str, df.collect()))


PARTNER = [p_row(f"t{n}", n + 1) for n in range(40)] + [p_row(None, 7), p_row(None, 8)]
PLATFORM = [i_row(f"e{n}", n + 1, f"t{n}") for n in range(10, 60)] + [i_row(f"x{n}", n, None) for n in range(9)]


def test_same_rows_as_the_plain_match_without_an_exchange(spark, streams):
    put(spark, streams, PARTNER, PLATFORM)
    plain = Match(spark.createDataFrame(PARTNER, PARTNER_DDL), spark.createDataFrame(PLATFORM, PLATFORM_DDL), persist=False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = matched(spark, streams)
        plan = m.tier1._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
        assert "Exchange" in plain.tier1._jdf.queryExecution().executedPlan().toString()
        assert rows_of(m.strong) == rows_of(plain.strong) and m.strong.count() == 30
        assert rows_of(m.classified) == rows_of(plain.classified)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_day_is_replaced_alone_and_may_end_empty(spark, streams):
    other = D0.replace(day=16)
    put(spark, streams, PARTNER + [p_row("late", 5, bd=other)], PLATFORM + [i_row("late", 5, "late", bd=other)], (D0, other))
    put(spark, streams, [p_row("t1", 1), p_row("stray", 1, bd=other)], [], (D0,))
    db = streams[0]
    keyed, unkeyed = B.read_days(spark, f"{db}.p")
    assert sorted(r.partner_txn_id for r in keyed.collect()) == ["late", "t1"] and unkeyed.count() == 0
    keyed, unkeyed = B.read_days(spark, f"{db}.i")
    assert [r.platform_event_id for r in keyed.collect()] == ["late"] and unkeyed.count() == 0
    assert matched(spark, streams).strong.count() == 1


def test_a_hot_key_gets_a_plain_table_and_the_same_rows(spark, streams):
    platform = PLATFORM + [i_row(f"h{n}", 3, "t3") for n in range(900)]
    put(spark, streams, PARTNER, platform, hot_rows=100)
    db, root = streams
    assert B.buckets_of(spark, f"{db}.p_keyed") == 4
    # with 4 buckets no share can reach the factor, so the layout is decided again over more
    assert B.buckets_of(spark, f"{db}.i_keyed") == 4
    B.relayout(spark, f"{db}.i", f"{root}/i2", 64, hot_rows=100)
    assert B.buckets_of(spark, f"{db}.i_keyed") == 0
    plain = Match(spark.createDataFrame(PARTNER, PARTNER_DDL), spark.createDataFrame(platform, PLATFORM_DDL), persist=False)
    assert rows_of(matched(spark, streams).strong) == rows_of(plain.strong)
    B.relayout(spark, f"{db}.i", f"{root}/i3", 4, hot_rows=100)
    assert B.buckets_of(spark, f"{db}.i_keyed") == 4
    assert rows_of(matched(spark, streams).strong) == rows_of(plain.strong)


def test_empty_streams(spark, streams):
    put(spark, streams, [], [])
    m = matched(spark, streams)
    assert m.strong.count() == 0 and m.classified.count() == 0
