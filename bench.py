"""Benchmark the headline operators.

Setup (not timed): the fixture derived from ``$BENCH_SF_DIR`` is written as
the lakehouse would hold it: landing files -> bronze Parquet (partitioned by
operator and arrival date), silver partner / platform events and the churn
table (partitioned by business date), and the gold fact. Each timed query
reads those tables and runs to completion into Spark's ``noop`` sink (no
driver collect). Reported value: the sum of the warm medians.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.window import Window  # noqa: E402

from twintally.config import DEFAULT_RECON, ReconConfig  # noqa: E402
from twintally.functions.money import amounts_match  # noqa: E402
from twintally.operators import marts as M  # noqa: E402
from twintally.operators import normalize as N  # noqa: E402
from twintally.operators.matching import Match  # noqa: E402
from twintally.operators.reconcile import fact_breaks  # noqa: E402
from twintally.plans import pipeline as P  # noqa: E402
from twintally.session import build_session  # noqa: E402
from twintally.sinks.partitions import full_overwrite, read_table  # noqa: E402
from twintally.sources import fixture, fixture_files  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "5"))
RUN_TS = "2024-02-01 00:00:00"
CFG = ReconConfig(cache_tier1=os.environ.get("BENCH_CACHE_TIER1", "1") == "1")


def theta_fallback(partner, platform):
    """The plain form of the fallback tier, for comparison only: a theta join
    on operator, type and date with the tolerance predicate, then a
    row_number window per partner row."""
    m = Match(partner, platform, CFG)
    p = m.partner_left.alias("p")
    i = m.platform_left.where(F.col("partner_txn_id").isNull()).alias("i")
    j = p.join(i, (F.col("p.operator_code") == F.col("i.operator_code"))
               & (F.col("p.txn_type") == F.col("i.event_type"))
               & (F.col("p.business_date") == F.col("i.business_date"))
               & amounts_match(F.col("p.amount"), F.col("i.amount"), DEFAULT_RECON), "inner")
    w = Window.partitionBy("p.business_date", "p.operator_code", "p.partner_txn_id").orderBy(
        F.abs(F.col("p.amount") - F.col("i.amount")), F.col("i.platform_event_id"))
    return (j.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select("p.business_date", "p.operator_code", "p.partner_txn_id", "i.platform_event_id"))


def dense_day(spark, share):
    """One operator-day whose amounts are the distinct prices of ``lineitem``
    (that share of them by hash): partner rows, and platform rows a cent above."""
    price = (spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select(F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))
             .distinct().where(F.pmod(F.xxhash64("amount"), F.lit(100)) < int(100 * share)))
    day, noon = F.lit("2024-01-10").cast("date"), F.lit("2024-01-10 12:00:00").cast("timestamp")
    text = F.col("amount").cast("string")
    partner = price.select(F.lit("telco_a").alias("operator_code"), F.concat(F.lit("p"), text).alias("partner_txn_id"),
                           text.alias("msisdn_or_account"), F.lit("subscription_success").alias("txn_type"), "amount",
                           F.lit("PKR").alias("currency"), noon.alias("txn_ts_utc"), day.alias("business_date"),
                           day.alias("file_arrival_date"))
    platform = price.select(F.lit("telco_a").alias("operator_code"), F.concat(F.lit("e"), text).alias("platform_event_id"),
                            F.lit("subscription_success").alias("event_type"), text.alias("user_id"),
                            F.lit(None).cast("string").alias("partner_txn_id"),
                            (F.col("amount") + F.lit("0.01").cast("decimal(12,2)")).cast("decimal(12,2)").alias("amount"),
                            noon.alias("event_ts_utc"), day.alias("business_date"))
    return partner, platform


def main():
    scratch = tempfile.mkdtemp(prefix="twintally-bench-")
    spark = build_session(
        "twintally-bench", master=f"local[{CPUS}]", shuffle_partitions=CPUS * 2,
        extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": f"{scratch}/ckpt",
               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    fx = fixture.load(spark, SF_DIR)
    lake = P.Lake(f"{scratch}/lake")

    # ---- setup (untimed) -------------------------------------------------
    landing = fixture_files.write_landing(fx, f"{scratch}/landing")
    bronze = N.bronze_operator_feeds(spark, landing["operator_feeds"], ingested_at=RUN_TS)
    full_overwrite(bronze, lake.bronze_feeds, ["operator_code", "file_arrival_date"])
    full_overwrite(fx.partner_events(), lake.silver_partner, ["business_date"])
    full_overwrite(fx.platform_events(), lake.silver_platform, ["business_date"])
    churn_path = lake.bronze_cdc("user_churn_events")
    full_overwrite(fx.churn(), churn_path)
    partner, platform = read_table(spark, lake.silver_partner), read_table(spark, lake.silver_platform)
    churn = read_table(spark, churn_path)
    full_overwrite(fact_breaks(partner, platform, churn, run_ts=RUN_TS), lake.fact, ["business_date"])
    fact = read_table(spark, lake.fact)
    n_fact = fact.count()
    n_partner = partner.count()

    queries = {
        "fact_breaks": lambda: fact_breaks(partner, platform, churn, CFG, run_ts=RUN_TS),
        "match_fallback": lambda: Match(partner, platform, CFG).fallback,
        "match_fallback_theta": lambda: theta_fallback(partner, platform),
        "silver_partner_events": lambda: N.silver_partner_events(read_table(spark, lake.bronze_feeds)),
        "mart_daily": lambda: M.mart_daily(M.stg_partner_events(partner), M.stg_platform_events(platform),
                                           M.stg_reconciliation_break(fact), built_at=RUN_TS),
        "mart_monthly_close": lambda: M.mart_monthly_close(M.stg_reconciliation_break(fact), built_at=RUN_TS),
    }
    # A hot day: every row of one operator on one day repeated HOT times with
    # distinct ids (the theta join's pair count grows with HOT^2 there).
    hot = int(os.environ.get("BENCH_HOT", "40"))

    def amplify(df, idcol):
        day = F.lit("2024-01-10").cast("date")
        is_hot = (F.col("operator_code") == "telco_a") & (F.col("business_date") == day)
        rep = F.explode(F.when(is_hot, F.sequence(F.lit(1), F.lit(hot))).otherwise(F.array(F.lit(0))))
        out = df.select("*", rep.alias("_rep"))
        return out.withColumn(idcol, F.when(F.col("_rep") > 0, F.concat_ws("~", F.col(idcol), F.col("_rep")))
                              .otherwise(F.col(idcol))).drop("_rep")

    full_overwrite(amplify(partner, "partner_txn_id"), f"{scratch}/hot_p", ["business_date"])
    full_overwrite(amplify(platform, "platform_event_id"), f"{scratch}/hot_i", ["business_date"])
    hp, hi = read_table(spark, f"{scratch}/hot_p"), read_table(spark, f"{scratch}/hot_i")
    queries["hot_day_fallback_bucketed"] = lambda: Match(hp, hi, CFG).fallback
    if os.environ.get("BENCH_THETA", "1") == "1":
        queries["hot_day_fallback_theta"] = lambda: theta_fallback(hp, hi)
    queries["hot_day_fact_breaks"] = lambda: fact_breaks(hp, hi, churn, CFG, run_ts=RUN_TS)

    # linear in the distinct amounts of one operator-day
    for name, share in (("dense_day_fallback_half", 0.5), ("dense_day_fallback", 1.0)):
        queries[name] = lambda share=share: Match(*dense_day(spark, share), CFG).fallback

    headline = ("fact_breaks", "match_fallback", "silver_partner_events", "mart_daily", "mart_monthly_close")

    times = {}
    for name, q in queries.items():
        reps = REPS if name in headline else 1   # comparison-only queries: one run after a warm-up
        q().write.format("noop").mode("overwrite").save()  # warm-up
        spark.catalog.clearCache()
        ts = []
        for _ in range(reps):
            t0 = time.perf_counter()
            q().write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
            spark.catalog.clearCache()  # the matcher caches its tier-1 table per run
        times[name] = round(statistics.median(ts), 3)

    total = round(sum(times[k] for k in headline), 3)
    print(json.dumps({
        "metric": "sum_of_warm_median_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS,
        "rows": {"orders": fx.orders().count(), "silver_partner": n_partner, "fact": n_fact},
        "notes": ("match_fallback_theta is the plain theta-join form and hot_day_* repeat one operator-day "
                  f"{hot}x with distinct ids; dense_day_* is one operator-day with as many amounts as lineitem has "
                  "prices; all for comparison, not in value"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
