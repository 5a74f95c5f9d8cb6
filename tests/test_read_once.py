"""Landing text is read and parsed once: no copy of an expression or of a scan for rows without a key."""

import datetime as dt

from twintally.config import FEEDS
from twintally.operators import normalize as N
from twintally.operators import platform as PL


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_times_are_parsed_once(spark):
    raw = sorted({c for f in FEEDS.values() for c in f.raw_columns} - {"operator_code", "file_arrival_date"})
    schema = ", ".join(f"`{c}` string" for c in raw) + ", operator_code string, file_arrival_date date"
    a, b = FEEDS["telco_a"], ("a", "acct", "SUB", "P", "99", "PKR", "2024-01-03 10:00:00")
    named = dict(zip([a.raw_for(c) for c in ("partner_txn_id", "msisdn_or_account", "txn_type", "plan_code", "amount", "currency",
                                             "txn_ts_local")], b))
    row = lambda txn, time, day: (*[{**named, a.raw_for("partner_txn_id"): txn, a.raw_for("txn_ts_local"): time}.get(c) for c in raw],
                                  "telco_a", dt.date(2024, 1, day))
    time = named[a.raw_for("txn_ts_local")]
    bronze = spark.createDataFrame([row("a", time, 3), row("a", time, 4), row(None, time, 3), row(None, time, 3),
                                    row("b", "not-a-time", 3)], schema)
    silver = N.silver_partner_events(bronze, dates=[dt.date(2024, 1, 3)])
    patterns = [f for f in FEEDS.values() if f.ts_format != "epoch_millis"]
    assert _plan(silver).count("gettimestamp") <= 2 * len(patterns)
    got = sorted((str(r["partner_txn_id"]), r["file_arrival_date"].day) for r in silver.collect())
    assert got == [("None", 3), ("None", 3), ("a", 4)]         # rows without an id are not one transaction


def test_change_folders_of_all_operators_are_one_scan(spark, tmp_path):
    for op, line in (("telco_a", '{"failure_id": "1", "user_id": "u"}'), ("wallet_x", '{"failure_id": "1", "more": 5}\n{"user_id": "v"}\n{"user_id": "v"}')):
        folder = tmp_path / f"sub_recursion_failure_{op}" / f"batch=sub_recursion_failure_{op}_20240105"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text(line)
    changes = PL.read_cdc(spark, str(tmp_path), "sub_recursion_failure", ingested_at="2024-02-01 00:00:00")
    image = PL.latest_image(changes, ("failure_id", "operator_code"), "attempt_ts")
    assert "Union" not in _plan(image)
    key = lambda r: tuple(str(x) for x in r)
    got = sorted(map(key, image.select("failure_id", "operator_code", "user_id", "more", "file_arrival_date").collect()))
    assert got == [("1", "telco_a", "u", "None", "2024-01-05"), ("1", "wallet_x", "None", "5", "2024-01-05"),
                   ("None", "wallet_x", "v", "None", "2024-01-05"), ("None", "wallet_x", "v", "None", "2024-01-05")]
