"""Per-day sums of the monthly close, and catalog entries kept up to date in place."""

import datetime as dt
import random
from decimal import Decimal

from twintally.operators import marts as M
from twintally.operators.overlays import FACT_COLUMNS
from twintally.sinks.partitions import register_external_table, replace_partitions

STATUSES = ("MATCHED", "LATE_ARRIVAL", "AMOUNT_MISMATCH", "MISSING_ON_PLATFORM", "MISSING_AT_PARTNER", "ORPHAN_CHURN")


def fact_rows(rng, day, n):
    cents = lambda: Decimal(rng.randrange(0, 99999)) / 100
    return [(day, rng.choice(("telco_a", "telco_b")), rng.choice(STATUSES), rng.choice(("refund", "subscription_success")),
             cents(), cents(), cents() - 300) for _ in range(n)]


def fact(spark, rows):
    ddl = ("business_date date, operator_code string, recon_status string, txn_type string, partner_amount decimal(12,2), "
           "internal_amount decimal(12,2), amount_variance decimal(12,2)")
    return spark.createDataFrame(rows, ddl)


def test_close_from_days_equals_the_close_after_any_restatement(spark):
    rng = random.Random(3)
    days = [dt.date(2024, 1, 28) + dt.timedelta(days=i) for i in range(8)]
    held = {d: fact_rows(rng, d, rng.randrange(1, 9)) for d in days}
    state = M.close_by_day(fact(spark, [r for d in days for r in held[d]])).collect()
    schema = M.close_by_day(fact(spark, [])).schema
    for _ in range(3):
        again = rng.sample(days, 3)
        for d in again:
            held[d] = fact_rows(rng, d, rng.choice((0, 1, 5)))
        new = M.close_by_day(fact(spark, [r for d in again for r in held[d]])).collect()
        state = [r for r in state if r["business_date"] not in again] + new
        rows = lambda f: sorted(map(str, f.drop("_built_at").collect()))
        assert rows(M.close_from_days(spark.createDataFrame(state, schema))) == rows(
            M.mart_monthly_close(fact(spark, [r for d in days for r in held[d]])))
    assert set(schema.names) - {"business_date", "operator_code"} == {"recognized_txn_count", *M.CLOSE_SUMS}
    assert {"business_date", "operator_code", "recon_status"} <= set(FACT_COLUMNS)


def test_registration_follows_the_table_without_dropping_it(spark, tmpdir_path):
    path, ddl = f"{tmpdir_path}/t", "v int, op string, d date"
    days = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    put = lambda rows, parts, ddl=ddl: replace_partitions(spark.createDataFrame(rows, ddl), path, ["op", "d"], parts)
    name = "close_reg.t"
    assert not register_external_table(spark, "close_reg", "t", path)
    put([(1, "a", days[0]), (2, "a'b", days[1]), (3, "a", None)], [("a", days[0]), ("a'b", days[1]), ("a", None)])
    assert register_external_table(spark, "close_reg", "t", path, [("a", days[0])])          # a new entry takes in all folders
    made = lambda: [r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Created Time"]
    rows = lambda *c: sorted((tuple(r) for r in spark.table(name).select(*c).collect()), key=str)
    assert rows("v", "op") == [(1, "a"), (2, "a'b"), (3, "a")]
    first = made()
    put([(9, "b", days[2])], [("b", days[2]), ("a'b", days[1])])                              # one new, one emptied
    put([(5, "c", days[2])], [("c", days[2])])                                                 # not named below: not looked at
    assert register_external_table(spark, "close_reg", "t", path, [("b", days[2]), ("a'b", days[1])])
    assert rows("v") == [(1,), (3,), (9,)] and made() == first
    put([(4, "more", "b", days[0])], [("b", days[0])], "v int, extra string, op string, d date")
    register_external_table(spark, "close_reg", "t", path, [("b", days[0])])
    assert rows("v", "extra") == [(1, None), (3, None), (4, "more"), (9, None)] and made() == first
    register_external_table(spark, "close_reg", "t", path)                                     # all folders
    assert rows("v") == [(1,), (3,), (4,), (5,), (9,)] and made() == first
    replace_partitions(spark.createDataFrame([(1, "a", days[0])], ddl), path, ["op"], [("a",)])     # another layout: made anew
    register_external_table(spark, "close_reg", "t", path, [("a",)])
    assert rows("v", "op") == [(1, "a")]
    spark.sql("DROP DATABASE close_reg CASCADE")


def test_an_emptied_outer_folder_does_not_change_the_layout(spark, tmpdir_path):
    path, ddl = f"{tmpdir_path}/t", "v int, op string, d string"
    put = lambda rows, parts: replace_partitions(spark.createDataFrame(rows, ddl), path, ["op", "d"], parts)
    put([(1, "a", "1"), (2, "b", "1"), (3, "c", "12:30")], [("a", "1"), ("b", "1"), ("c", "12:30")])
    put([(4, "b", "2")], [("a", "1"), ("c", "12:30"), ("b", "2")])
    put([(5, "b", "3")], [("b", "3")])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 4, 5]
