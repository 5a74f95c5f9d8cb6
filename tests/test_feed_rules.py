"""Feed rules as data: equal to the feed specifications, read by their date, plan size."""

import datetime as dt

from twintally.config import FEEDS
from twintally.operators import feed_rules as FR
from twintally.operators import normalize as N
from twintally.plans import queries

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 15)


def test_rules_of_the_feeds_equal_the_specifications(spark):
    bronze = queries._bronze(spark, SF)
    by_spec = N.normalize_partner(bronze)
    by_rule = FR.normalize_by_rules(bronze, FR.rules_of_feeds(spark)).select(*by_spec.columns)
    assert by_rule.schema.simpleString() == by_spec.schema.simpleString()
    assert by_spec.count() > 0
    assert by_rule.exceptAll(by_spec).count() == 0 and by_spec.exceptAll(by_rule).count() == 0


def bronze_of(spark, rows):
    cols = "operator_code string, partner_txn_id string, file_arrival_date date, `id` string, `kind.of` string, `sum` string, `t` string"
    return spark.createDataFrame(rows, cols)


def base(spark, more=()):
    rows = [("z", "column", "partner_txn_id", "id", None, None), ("z", "column", "txn_type", "kind.of", None, None),
            ("z", "column", "amount", "sum", None, None), ("z", "column", "txn_ts_local", "t", None, None),
            ("z", "type", "S", "subscription_success", None, None), ("z", "time", "", "yyyy-MM-dd HH:mm:ss", None, None),
            ("z", "zone", "", "Asia/Dubai", None, None), ("z", "currency", "", "AED", None, None), *more]
    return spark.createDataFrame(rows, FR.RULE_SCHEMA)


def test_a_rule_is_read_by_the_arrival_date(spark):
    d = [DAY + dt.timedelta(days=n) for n in range(4)]
    rows = [("z", f"r{n}", on, f"r{n}", "S", "1.00", "2024-01-10 02:00:00") for n, on in enumerate(d)]
    rows.append(("z", "none", None, "none", "S", "1.00", "2024-01-10 02:00:00"))
    more = [("z", "type", "S", "refund", d[1], d[3]), ("z", "type", "S", "cancel", d[2], None),
            ("z", "type", "S", "cancel", d[2], None), ("z", "zone", "", "UTC", d[3], None)]
    got = {r["partner_txn_id"]: r for r in FR.normalize_by_rules(bronze_of(spark, rows), base(spark, more)).collect()}
    assert [got[k]["txn_type"] for k in ("r0", "r1", "r2", "r3", "none")] == [
        "subscription_success", "refund", "cancel", "cancel", "subscription_success"]
    assert got["r0"]["txn_ts_utc"] == dt.datetime(2024, 1, 9, 22) and got["r0"]["business_date"] == dt.date(2024, 1, 9)
    assert got["r3"]["txn_ts_utc"] == dt.datetime(2024, 1, 10, 2) and got["r3"]["business_date"] == dt.date(2024, 1, 10)
    assert {r["currency"] for r in got.values()} == {"AED"}


def test_renamed_column_and_time_format(spark):
    rows = [("z", "a", DAY, "a", "1.50", "S", "1704852000000"), ("z", "b", DAY, "b", "x", "S", "soon"),
            ("unruled", "c", DAY, "c", "S", "1.00", "2024-01-10 02:00:00")]
    more = [("z", "column", "amount", "kind.of", DAY, None), ("z", "column", "txn_type", "sum", DAY, None),
            ("z", "time", "", "epoch_millis", DAY, None)]
    got = {r["partner_txn_id"] or r["operator_code"]: r for r in FR.normalize_by_rules(bronze_of(spark, rows), base(spark, more)).collect()}
    assert str(got["a"]["amount"]) == "1.50" and got["a"]["txn_type"] == "subscription_success"
    assert got["a"]["txn_ts_utc"] == dt.datetime(2024, 1, 10, 2) and got["a"]["txn_ts_local"] == dt.datetime(2024, 1, 10, 6)
    assert got["b"]["_quarantine_reason"] == "unparsable_time"
    assert got["unruled"]["_quarantine_reason"] == "unparsable_time" and got["unruled"]["txn_type"] == "unknown"


def test_empty_tables_and_null_rules(spark):
    nothing = spark.createDataFrame([], FR.RULE_SCHEMA)
    rows = [("z", "a", DAY, "a", "S", "1.00", "2024-01-10 02:00:00")]
    assert FR.normalize_by_rules(bronze_of(spark, rows), nothing).where("_quarantine_reason IS NULL").count() == 0
    assert FR.normalize_by_rules(bronze_of(spark, []), base(spark)).count() == 0
    broken = [(None, "type", "S", "refund", None, None), ("z", None, "S", "refund", None, None),
              ("z", "type", "S", None, DAY, None), ("z", "type", None, "refund", None, None)]
    got = FR.normalize_by_rules(bronze_of(spark, rows), base(spark, broken)).collect()
    assert [r["txn_type"] for r in got] == ["subscription_success"]


def test_problems_of_rules_are_named(spark):
    more = [("z", "type", "S", "refund", None, None), ("z", "colour", "", "red", None, None),
            ("z", "type", "Q", "refund", DAY, DAY), ("z", "type", None, None, None, None)]
    got = sorted((r["kind"], r["reason"]) for r in FR.rule_problems(base(spark, more)).collect())
    assert got == [("colour", "unknown_kind"), ("type", "empty_interval"), ("type", "missing_part"), ("type", "two_values")]
    assert FR.rule_problems(FR.rules_of_feeds(spark)).count() == 0


def test_plan_does_not_grow_with_the_feeds(spark):
    rows = [(f"f{n}", kind, name, value, None, None) for n in range(500) for kind, name, value in (
        ("column", "amount", "sum"), ("type", "S", "refund"), ("time", "", "epoch_millis"))]
    many = spark.createDataFrame(rows, FR.RULE_SCHEMA)
    size = [len(FR.normalize_by_rules(bronze_of(spark, []), r)._jdf.queryExecution().analyzed().treeString())
            for r in (FR.rules_of_feeds(spark, dict(list(FEEDS.items())[:1])), many)]
    assert size[1] < size[0] * 1.1


def test_a_book_too_large_to_broadcast_gives_the_same_rows(spark, monkeypatch):
    bronze, rules = queries._bronze(spark, SF), FR.rules_of_feeds(spark)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = FR.normalize_by_rules(bronze, rules)
    assert "BroadcastHashJoin" in plan(small)
    monkeypatch.setattr(FR, "BROADCAST_RULES", 3)
    large = FR.normalize_by_rules(bronze, rules)
    assert "BroadcastHashJoin" not in plan(large)
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
