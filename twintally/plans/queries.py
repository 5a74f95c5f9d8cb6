"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (through the fixture derivation, or
files Spark writes from it), runs a library operator over all of it, and has
a plain-SQL statement of the same result in ``oracles.py`` unless noted.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CDC_TABLES, DEFAULT_RECON, FEEDS, ReconConfig
from ..functions import money
from ..operators import feed_rules as FR
from ..operators import gate as G
from ..operators import marts as M
from ..operators import normalize as N
from ..operators import overlays
from ..operators import platform as PL
from ..operators import quality as Q
from ..operators.matching import ColocatedMatch, DateRange, Match
from ..operators.reconcile import fact_breaks, status_summary
from ..session import scratch_path, together
from ..sinks import colocated as B
from ..sinks import partitions as K
from ..sources import fixture, fixture_files, landing
from ..sources import tables as T
from . import oracles as O
from . import pipeline as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _fx(spark: SparkSession, sf_dir: str) -> fixture.Fixture:
    return fixture.load(spark, sf_dir)


def _match(spark, sf_dir, cfg: ReconConfig = DEFAULT_RECON) -> Match:
    f = _fx(spark, sf_dir)
    return Match(f.partner_events(), f.platform_events(), cfg)


def _piece(spark, sf_dir, name: str, cfg: ReconConfig = DEFAULT_RECON) -> DataFrame:
    """One piece of a match; what it has cached goes when the piece goes."""
    m = _match(spark, sf_dir, cfg)
    return m.release_with(getattr(m, name))


def _fact(spark, sf_dir, cfg: ReconConfig = DEFAULT_RECON) -> DataFrame:
    f = _fx(spark, sf_dir)
    return fact_breaks(f.partner_events(), f.platform_events(), f.churn(), cfg, run_ts=O.RUN_TS)


# ---------------------------------------------------------------------------
# Gold: matching tiers, overlays, the fact
# ---------------------------------------------------------------------------

@register("fact_breaks", O.engine("SELECT * FROM o_fact"))
def q_fact_breaks(spark, sf_dir):
    return _fact(spark, sf_dir)


@register("status_summary", O.engine(
    "SELECT recon_status, CAST(count(*) AS BIGINT) AS n_rows FROM o_fact GROUP BY recon_status "
    "ORDER BY n_rows DESC, recon_status"))
def q_status_summary(spark, sf_dir):
    return status_summary(_fact(spark, sf_dir))


@register("match_strong", O.engine(f"SELECT {O.PAIR_COLS} FROM o_strong"))
def q_match_strong(spark, sf_dir):
    return _piece(spark, sf_dir, "strong")


def _colocated(spark, sf_dir):
    """Both silver streams as bucketed tables: all days, then the test week once more, from half of its rows and
    then whole."""
    f, week = _fx(spark, sf_dir), _week_dates()
    db = f"colocated_{_uuid.uuid4().hex[:8]}"
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/db'")
    def stored(df: DataFrame) -> DataFrame:        # read five times below, derived once
        path = scratch_path(spark, "silver")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    out = []
    for name, df in zip(("partner", "platform"), together(spark, [lambda: stored(f.partner_events()), lambda: stored(f.platform_events())])):
        days = [r[0] for r in df.select("business_date").where("business_date IS NOT NULL").distinct().collect()]
        half = df.where((F.hash("operator_code", "partner_txn_id", "business_date") % 2 == 0) & (F.dayofweek("business_date") > 3))
        for rows, dates in ((df, days), (half, week), (df, week)):
            B.replace_days(rows, f"{db}.{name}", f"{root}/{name}", dates, buckets=16)
        out.append(B.read_days(spark, f"{db}.{name}"))
    return ColocatedMatch(*out)


@register("match_strong_colocated", O.engine(f"SELECT {O.PAIR_COLS} FROM o_strong"))
def q_match_strong_colocated(spark, sf_dir):
    m = _colocated(spark, sf_dir)
    return m.release_with(m.strong)


@register("match_classified_colocated", O.engine(f"SELECT {O.PAIR_COLS} FROM o_classified"))
def q_match_classified_colocated(spark, sf_dir):
    m = _colocated(spark, sf_dir)
    return m.release_with(m.classified)


@register("partner_unmatched", O.engine("SELECT * FROM o_pleft"))
def q_partner_unmatched(spark, sf_dir):
    return _piece(spark, sf_dir, "partner_left")


@register("platform_unmatched", O.engine("SELECT * FROM o_ileft"))
def q_platform_unmatched(spark, sf_dir):
    return _piece(spark, sf_dir, "platform_left")


@register("match_fallback", O.engine(f"SELECT {O.PAIR_COLS} FROM o_fallback"))
def q_match_fallback(spark, sf_dir):
    return _piece(spark, sf_dir, "fallback")


@register("match_fallback_windowed", O.engine(f"SELECT {O.PAIR_COLS} FROM o_fallback", window=1))
def q_match_fallback_windowed(spark, sf_dir):
    return _piece(spark, sf_dir, "fallback", ReconConfig(fallback_window_days=1))


@register("missing_on_platform", O.engine(f"SELECT {O.PAIR_COLS} FROM o_mop"))
def q_missing_on_platform(spark, sf_dir):
    return _piece(spark, sf_dir, "missing_on_platform")


@register("missing_at_partner", O.engine(f"SELECT {O.PAIR_COLS} FROM o_map"))
def q_missing_at_partner(spark, sf_dir):
    return _piece(spark, sf_dir, "missing_at_partner")


@register("churned_users", O.fx(
    "SELECT user_id, operator_code, min(CAST(churn_ts AS DATE)) AS churn_date FROM fx_churn "
    "GROUP BY user_id, operator_code"))
def q_churned_users(spark, sf_dir):
    return overlays.churned_users(_fx(spark, sf_dir).churn())


@register("overlay_orphan_churn", O.engine(
    "SELECT business_date, operator_code, status2 AS recon_status, match_confidence, match_key, "
    "partner_txn_id, platform_event_id, user_id, msisdn_or_account, txn_type, partner_amount, "
    "internal_amount, currency, partner_txn_ts_utc, platform_event_ts_utc, file_arrival_date FROM o_churned"))
def q_overlay_orphan_churn(spark, sf_dir):
    f = _fx(spark, sf_dir)
    m = Match(f.partner_events(), f.platform_events())
    return m.release_with(overlays.overlay_orphan_churn(m.classified, f.churn()))


@register("overlay_late_arrival", O.engine(f"SELECT {O.FACT_COLS} FROM o_fact WHERE is_late_arrival"))
def q_overlay_late_arrival(spark, sf_dir):
    return _fact(spark, sf_dir).where(F.col("is_late_arrival"))


@register("amount_tolerance", O.engine(
    "SELECT business_date, operator_code, partner_txn_id, platform_event_id, partner_amount, internal_amount, "
    f"{O.match_sql('partner_amount', 'internal_amount')} AS within_tolerance FROM o_strong"))
def q_amount_tolerance(spark, sf_dir):
    s = _piece(spark, sf_dir, "strong")
    return s.select("business_date", "operator_code", "partner_txn_id", "platform_event_id",
                    "partner_amount", "internal_amount",
                    money.amounts_match(F.col("partner_amount"), F.col("internal_amount")).alias("within_tolerance"))


@register("amount_variance", O.engine(
    "SELECT business_date, operator_code, recon_status, partner_txn_id, platform_event_id, amount_variance "
    "FROM o_fact"))
def q_amount_variance(spark, sf_dir):
    return _fact(spark, sf_dir).select("business_date", "operator_code", "recon_status", "partner_txn_id",
                                       "platform_event_id", "amount_variance")


@register("late_flag", O.fx(
    "SELECT operator_code, partner_txn_id, business_date, file_arrival_date, "
    "coalesce(file_arrival_date IS NOT NULL AND date_diff('day', business_date, file_arrival_date) > 2, FALSE) "
    "AS is_late_arrival FROM fx_partner"))
def q_late_flag(spark, sf_dir):
    p = _fx(spark, sf_dir).partner_events()
    return p.select("operator_code", "partner_txn_id", "business_date", "file_arrival_date",
                    money.late_flag(F.col("file_arrival_date"), F.col("business_date")).alias("is_late_arrival"))


# ---------------------------------------------------------------------------
# Marts and data-quality checks
# ---------------------------------------------------------------------------


def _stg(spark, sf_dir):
    f = _fx(spark, sf_dir)
    fact = fact_breaks(f.partner_events(), f.platform_events(), f.churn(), run_ts=O.RUN_TS)
    return (M.stg_partner_events(f.partner_events()), M.stg_platform_events(f.platform_events()),
            M.stg_reconciliation_break(fact))


def _daily(spark, sf_dir):
    p, i, fact = _stg(spark, sf_dir)
    return M.mart_daily(p, i, fact, built_at=O.RUN_TS)


def _monthly(spark, sf_dir):
    return M.mart_monthly_close(_stg(spark, sf_dir)[2], built_at=O.RUN_TS)


@register("stg_partner_events", O.marts("SELECT * FROM o_stgp"))
def q_stg_partner_events(spark, sf_dir):
    return _stg(spark, sf_dir)[0]


@register("stg_platform_events", O.marts("SELECT * FROM o_stgi"))
def q_stg_platform_events(spark, sf_dir):
    return _stg(spark, sf_dir)[1]


@register("stg_reconciliation_break", O.engine(f"SELECT {O.FACT_COLS} FROM o_fact"))
def q_stg_reconciliation_break(spark, sf_dir):
    return _stg(spark, sf_dir)[2]


@register("partner_population", O.marts(
    "SELECT business_date, operator_code, partner_txn_count, CAST(partner_amount_raw AS DECIMAL(18,2)) "
    "AS partner_amount_raw FROM o_pp"))
def q_partner_population(spark, sf_dir):
    return M.partner_population(_stg(spark, sf_dir)[0])


@register("platform_population", O.marts(
    "SELECT business_date, operator_code, internal_txn_count, CAST(internal_amount_raw AS DECIMAL(18,2)) "
    "AS internal_amount_raw FROM o_ip"))
def q_platform_population(spark, sf_dir):
    return M.platform_population(_stg(spark, sf_dir)[1])


@register("source_population", O.marts("SELECT * FROM o_pop"))
def q_source_population(spark, sf_dir):
    p, i, _ = _stg(spark, sf_dir)
    return M.source_population(p, i)


@register("break_counts_by_category", O.marts("SELECT * FROM o_cat"))
def q_break_counts_by_category(spark, sf_dir):
    return M.break_counts_by_category(_stg(spark, sf_dir)[2])


@register("mart_daily", O.marts("SELECT * FROM o_daily"))
def q_mart_daily(spark, sf_dir):
    return _daily(spark, sf_dir)


@register("mart_monthly_close", O.marts("SELECT * FROM o_monthly"))
def q_mart_monthly_close(spark, sf_dir):
    return _monthly(spark, sf_dir)


@register("month_bucket", O.fx(
    "SELECT operator_code, partner_txn_id, business_date, CAST(date_trunc('month', business_date) AS DATE) "
    "AS close_month FROM fx_partner"))
def q_month_bucket(spark, sf_dir):
    from ..functions.timestamps import month_bucket
    p = _fx(spark, sf_dir).partner_events()
    return p.select("operator_code", "partner_txn_id", "business_date",
                    month_bucket(F.col("business_date")).alias("close_month"))


@register("drilldown_breaks", O.marts(
    f"SELECT f.*, d.break_count, d.match_rate FROM o_fact f JOIN o_daily d "
    f"ON f.business_date = d.business_date AND f.operator_code = d.operator_code "
    f"WHERE f.recon_status NOT IN ('MATCHED', 'LATE_ARRIVAL')"))
def q_drilldown_breaks(spark, sf_dir):
    p, i, fact = _stg(spark, sf_dir)
    return M.drilldown_breaks(M.mart_daily(p, i, fact, built_at=O.RUN_TS), fact)


# The checks below run over tables with planted violations (the tables as built
# have none): one operator's counts blanked, its days repeated, its mismatches
# called matched. The SQL plants the same rows.
PLANTED = "telco_a"


def _repeated(df: DataFrame, some) -> DataFrame:
    """The rows, and those for which ``some`` holds once more; ``df`` is computed once."""
    copies = F.when(some, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


@register("dq_not_null", O.marts(
    O.null_count_sql("reconciliation_daily",
                     f"(SELECT * REPLACE (CASE WHEN operator_code <> '{PLANTED}' THEN matched_count END AS matched_count) "
                     "FROM o_daily) d", Q.DAILY_NOT_NULL) + " UNION ALL " +
    O.null_count_sql("revenue_monthly_close",
                     f"(SELECT * REPLACE (nullif(operator_code, '{PLANTED}') AS operator_code) FROM o_monthly) m",
                     Q.MONTHLY_NOT_NULL)))
def q_dq_not_null(spark, sf_dir):
    other = F.col("operator_code") != PLANTED
    daily = _daily(spark, sf_dir).withColumn("matched_count", F.when(other, F.col("matched_count")))
    monthly = _monthly(spark, sf_dir).withColumn("operator_code", F.when(other, F.col("operator_code")))
    return Q.dq_not_null(daily, monthly)


@register("dq_unique_combination", O.marts(
    "SELECT business_date, operator_code, count(*) AS n_rows FROM (SELECT * FROM o_daily UNION ALL "
    f"SELECT * FROM o_daily WHERE operator_code = '{PLANTED}') u GROUP BY business_date, operator_code HAVING count(*) > 1"))
def q_dq_unique_combination(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    return Q.dq_unique_combination(_repeated(daily, F.col("operator_code") == PLANTED))


@register("dq_matched_balanced", O.engine(
    "SELECT business_date, operator_code, partner_txn_id, partner_amount, internal_amount, amount_variance "
    "FROM o_fact WHERE recon_status = 'MATCHED' AND abs(amount_variance) > 0.01"))
def q_dq_matched_balanced(spark, sf_dir):
    return Q.dq_matched_balanced(_stg(spark, sf_dir)[2])


@register("dq_no_double_counting", O.engine(
    "SELECT operator_code, partner_txn_id, count(*) AS occurrences FROM (SELECT * FROM o_fact UNION ALL "
    f"SELECT * FROM o_fact WHERE operator_code = '{PLANTED}' AND recon_status = 'AMOUNT_MISMATCH') u "
    "WHERE partner_txn_id IS NOT NULL AND partner_amount > 0 "
    "GROUP BY operator_code, partner_txn_id HAVING count(*) > 1"))
def q_dq_no_double_counting(spark, sf_dir):
    fact = _stg(spark, sf_dir)[2]
    return Q.dq_no_double_counting(_repeated(fact, (F.col("operator_code") == PLANTED) & (F.col("recon_status") == "AMOUNT_MISMATCH")))


def _gate_sql() -> str:
    """The default constraints counted one by one over the planted tables."""
    called = f"operator_code = '{PLANTED}' AND recon_status = 'AMOUNT_MISMATCH'"
    fact = (f"SELECT * REPLACE (CASE WHEN {called} THEN 'MATCHED' ELSE recon_status END AS recon_status) FROM o_fact "
            f"UNION ALL SELECT * FROM o_fact WHERE {called}")
    daily = (f"SELECT * REPLACE (CASE WHEN operator_code <> '{PLANTED}' THEN matched_count END AS matched_count) FROM o_daily "
             f"UNION ALL SELECT * FROM o_daily WHERE operator_code = '{PLANTED}'")
    monthly = f"SELECT * REPLACE (nullif(operator_code, '{PLANTED}') AS operator_code) FROM o_monthly"
    rows = [(G.FACT, "matched_rows_agree", "error", f"SELECT count(*) FROM ({fact}) t WHERE recon_status = 'MATCHED' "
             f"AND NOT coalesce({O.match_sql('partner_amount', 'internal_amount')}, FALSE)"),
            (G.FACT, "matched_rows_balanced", "warn", f"SELECT count(*) FROM ({fact}) t WHERE recon_status = 'MATCHED' AND abs(amount_variance) > 0.01"),
            (G.FACT, "partner_counted_once", "error", f"SELECT count(*) FROM (SELECT 1 FROM ({fact}) t WHERE partner_txn_id IS NOT NULL "
             "AND partner_amount > 0 GROUP BY operator_code, partner_txn_id HAVING count(*) > 1) u"),
            (G.DAILY, "one_row_a_day_and_operator", "error", f"SELECT count(*) FROM (SELECT 1 FROM ({daily}) t "
             "GROUP BY business_date, operator_code HAVING count(*) > 1) u"),
            (G.PARTNER, "unknown_txn_type", "warn", "SELECT count(*) FROM fx_partner WHERE txn_type = 'unknown'")]
    rows += [(t, f"not_null_{c}", "error", f"SELECT count(*) FROM ({body}) t WHERE {c} IS NULL")
             for t, body, columns in ((G.DAILY, daily, Q.DAILY_NOT_NULL), (G.MONTHLY, monthly, Q.MONTHLY_NOT_NULL)) for c in columns]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS constraint_name, '{s}' AS severity, CAST(n AS BIGINT) AS violations, n = 0 AS passed "
        f"FROM ({n.replace('count(*)', 'count(*) AS n', 1)}) v" for t, c, s, n in rows)


@register("dq_gate", O.marts(_gate_sql()))
def q_dq_gate(spark, sf_dir):
    """All checks of a run over the planted tables: one scan per table, one row per constraint."""
    partner, platform, fact = _stg(spark, sf_dir)
    path = scratch_path(spark, "gate-fact")
    fact.write.parquet(path)
    fact = spark.read.schema(fact.schema).parquet(path)
    called = (F.col("operator_code") == PLANTED) & (F.col("recon_status") == "AMOUNT_MISMATCH")
    planted = fact.withColumn("recon_status", F.when(called, F.lit("MATCHED")).otherwise(F.col("recon_status")))
    daily = M.mart_daily(partner, platform, fact)
    other = F.col("operator_code") != PLANTED
    monthly = M.mart_monthly_close(fact).withColumn("operator_code", F.when(other, F.col("operator_code")))
    return G.report({G.FACT: planted.unionByName(fact.where(called)),
                     G.DAILY: daily.withColumn("matched_count", F.when(other, F.col("matched_count"))).unionByName(daily.where(~other)),
                     G.MONTHLY: monthly, G.PARTNER: _fx(spark, sf_dir).partner_events()}, G.default_constraints())


@register("dq_unknown_txn_type", O.fx(
    "SELECT business_date, operator_code, count(*) AS unknown_count FROM fx_partner "
    "WHERE txn_type = 'unknown' GROUP BY business_date, operator_code"))
def q_dq_unknown_txn_type(spark, sf_dir):
    return Q.dq_unknown_txn_type(_fx(spark, sf_dir).partner_events())


@register("dq_platform_reused", O.engine(
    "SELECT operator_code, platform_event_id, count(*) AS partner_rows, "
    "CAST(sum(internal_amount) AS DECIMAL(18,2)) AS internal_amount_counted FROM o_fact "
    "WHERE match_confidence = 'fallback' GROUP BY operator_code, platform_event_id HAVING count(*) > 1"))
def q_dq_platform_reused(spark, sf_dir):
    return Q.dq_platform_reused(_fact(spark, sf_dir))


# ---------------------------------------------------------------------------
# Raw landing files -> bronze -> silver partner stream
# ---------------------------------------------------------------------------


_LANDING: dict = {}
# The arrival / business date window used by the date-set operators.
WEEK = ("2024-01-03", "2024-01-09")


def landing_root(spark: SparkSession, sf_dir: str, feeds: bool = True, tables=tuple(CDC_TABLES)) -> dict:
    """Landing files rendered from the fixture, each written once per session: the feeds, and the change
    files of the tables. A query names those that it reads."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDING:
        _LANDING[key] = (scratch_path(spark, "landing"), set())
    root, written = _LANDING[key]
    zones = {"operator_feeds": f"{root}/operator_feeds", "internal": f"{root}/internal"}
    wanted = ({"operator_feeds"} if feeds else set()) | set(tables)
    fx, lacking = _fx(spark, sf_dir), wanted - written
    steps = [lambda: fixture_files.write_partner_feeds(fx, zones["operator_feeds"])] if "operator_feeds" in lacking else []
    if changes := [t for t in CDC_TABLES if t in lacking]:
        steps.append(lambda: fixture_files.write_cdc_files(fx, zones["internal"], changes))
    together(spark, steps)
    written |= wanted
    return zones


def feeds_root(spark: SparkSession, sf_dir: str) -> str:
    return landing_root(spark, sf_dir, tables=())["operator_feeds"]


def _bronze(spark, sf_dir, dates=None):
    return N.bronze_operator_feeds(spark, feeds_root(spark, sf_dir), dates=dates,
                                   ingested_at=O.RUN_TS)


def _normalized(spark, sf_dir):
    return N.normalize_partner(_bronze(spark, sf_dir))


def _week_dates():
    lo, hi = (_dt.date.fromisoformat(d) for d in WEEK)
    return [lo + _dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


@register("scan_by_arrival_token", O.raw(
    f"SELECT operator_code, r_id AS partner_txn_id, file_arrival_date FROM o_raw "
    f"WHERE file_arrival_date BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}'"))
def q_scan_by_arrival_token(spark, sf_dir):
    root = feeds_root(spark, sf_dir)
    frames = []
    for feed in FEEDS.values():
        df = landing.scan_feed(spark, root, feed, dates=_week_dates())
        if df is not None:
            frames.append(df.select(F.lit(feed.operator_code).alias("operator_code"),
                                    F.col(feed.raw_for("partner_txn_id")).alias("partner_txn_id"),
                                    "file_arrival_date"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("scan_csv_feed", O.raw_feed_select("telco_b"))
def q_scan_csv_feed(spark, sf_dir):
    return landing.scan_csv_feed(spark, feeds_root(spark, sf_dir), FEEDS["telco_b"])


@register("scan_json_feed", O.raw_feed_select("telco_c"))
def q_scan_json_feed(spark, sf_dir):
    return landing.scan_json_feed(spark, feeds_root(spark, sf_dir), FEEDS["telco_c"])


@register("bronze_natural_key", O.raw(
    "SELECT operator_code, r_id AS partner_txn_id, file_arrival_date FROM o_raw"))
def q_bronze_natural_key(spark, sf_dir):
    root = feeds_root(spark, sf_dir)
    frames = [N.bronze_natural_key(landing.scan_feed(spark, root, f), f)
              .select(F.lit(op).alias("operator_code"), "partner_txn_id", "file_arrival_date")
              for op, f in FEEDS.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("stamp_ingest_metadata", O.raw(
    "SELECT operator_code, r_id AS partner_txn_id, file_arrival_date, "
    "CASE WHEN operator_code IN ('telco_c', 'wallet_x') THEN 'json' ELSE 'csv' END AS _source_format, "
    f"TIMESTAMP '{O.RUN_TS}' AS _ingested_at FROM o_raw"))
def q_stamp_ingest_metadata(spark, sf_dir):
    root = feeds_root(spark, sf_dir)
    frames = [N.stamp_ingest_metadata(landing.scan_feed(spark, root, f), f, ingested_at=O.RUN_TS)
              .select(*N.BRONZE_META) for f in FEEDS.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("dedupe_batch", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, r_amount, r_time FROM o_raw"))
def q_dedupe_batch(spark, sf_dir):
    n = N.normalize_columns(_bronze(spark, sf_dir))
    return n.select("operator_code", "partner_txn_id", "file_arrival_date",
                    F.col("amount").alias("r_amount"), F.col("txn_ts_local").alias("r_time"))


@register("normalize_columns", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, r_account AS msisdn_or_account, r_type AS txn_type, "
    "r_plan AS plan_code, r_amount AS amount, r_currency AS currency, r_time AS txn_ts_local, "
    "file_arrival_date FROM o_raw"))
def q_normalize_columns(spark, sf_dir):
    return N.normalize_columns(_bronze(spark, sf_dir))


@register("map_txn_type", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, r_type AS raw_type, "
    "canon_type AS txn_type FROM o_raw"))
def q_map_txn_type(spark, sf_dir):
    n = N.normalize_columns(_bronze(spark, sf_dir))
    return n.select("operator_code", "partner_txn_id", "file_arrival_date", F.col("txn_type").alias("raw_type"),
                    N.map_txn_type().alias("txn_type"))


@register("normalize_currency", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, r_currency AS raw_currency, "
    "currency FROM o_raw"))
def q_normalize_currency(spark, sf_dir):
    n = N.normalize_columns(_bronze(spark, sf_dir))
    return n.select("operator_code", "partner_txn_id", "file_arrival_date", F.col("currency").alias("raw_currency"),
                    N.normalize_currency().alias("currency"))


def _time_query(ops, column: str):
    def q(spark, sf_dir):
        n = _normalized(spark, sf_dir).where(F.col("operator_code").isin(*ops))
        return n.select("operator_code", "partner_txn_id", "file_arrival_date",
                        F.col("_time_text").alias("raw_time"), column)
    return q


def _time_sql(ops, expr, name):
    inlist = ", ".join(f"'{o}'" for o in ops)
    return O.raw(f"SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, r_time AS raw_time, "
                 f"CASE WHEN bad_ts THEN NULL ELSE {expr} END AS {name} FROM o_raw "
                 f"WHERE operator_code IN ({inlist})")


NAIVE_OPS = ("telco_a", "telco_b", "wallet_y")
INSTANT_OPS = ("telco_c", "telco_d", "wallet_x")

register("parse_ts_epoch_millis", _time_sql(("telco_d",), "txn_ts_utc", "txn_ts_utc"))(
    _time_query(("telco_d",), "txn_ts_utc"))
register("parse_ts_offset", _time_sql(("telco_c",), "txn_ts_utc", "txn_ts_utc"))(
    _time_query(("telco_c",), "txn_ts_utc"))
register("parse_ts_zulu", _time_sql(("wallet_x",), "txn_ts_utc", "txn_ts_utc"))(
    _time_query(("wallet_x",), "txn_ts_utc"))
register("parse_ts_naive", _time_sql(NAIVE_OPS, "txn_ts_local", "txn_ts_local"))(
    _time_query(NAIVE_OPS, "txn_ts_local"))
register("tz_to_utc", _time_sql(NAIVE_OPS, "txn_ts_utc", "txn_ts_utc"))(
    _time_query(NAIVE_OPS, "txn_ts_utc"))
register("tz_from_utc", _time_sql(INSTANT_OPS, "txn_ts_local", "txn_ts_local"))(
    _time_query(INSTANT_OPS, "txn_ts_local"))
register("derive_business_date", _time_sql(tuple(FEEDS), "business_date", "business_date"))(
    _time_query(tuple(FEEDS), "business_date"))


@register("cast_amount", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, r_amount AS raw_amount, "
    "CASE WHEN bad_amt THEN NULL ELSE amount END AS amount FROM o_raw"))
def q_cast_amount(spark, sf_dir):
    return _normalized(spark, sf_dir).select("operator_code", "partner_txn_id", "file_arrival_date",
                                             F.col("_amount_text").alias("raw_amount"), "amount")


@register("dq_quarantine", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, r_time AS raw_time, "
    "r_amount AS raw_amount, CASE WHEN bad_ts THEN 'unparsable_time' ELSE 'unparsable_amount' END AS reason "
    "FROM o_raw WHERE bad_ts OR bad_amt"))
def q_dq_quarantine(spark, sf_dir):
    return N.quarantined(_normalized(spark, sf_dir))


@register("silver_partner_events", O.fx("SELECT * FROM fx_partner"))
def q_silver_partner_events(spark, sf_dir):
    return N.silver_partner_events(_bronze(spark, sf_dir))


@register("filter_business_dates", O.fx(
    f"SELECT * FROM fx_partner WHERE business_date BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}'"))
def q_filter_business_dates(spark, sf_dir):
    return N.silver_partner_events(_bronze(spark, sf_dir), dates=DateRange(*WEEK))


@register("latest_arrival", O.fx("SELECT * FROM fx_partner"))
def q_latest_arrival(spark, sf_dir):
    b = _fx(spark, sf_dir).partner_bronze().where(~F.col("bad_ts") & ~F.col("bad_amt"))
    return N.latest_arrival(b.select(*N.SILVER_PARTNER_COLUMNS))


MOVED_SQL = (" SELECT * REPLACE (txn_ts_utc + INTERVAL 1 DAY AS txn_ts_utc, txn_ts_local + INTERVAL 1 DAY AS txn_ts_local, "
             "CAST(business_date + 1 AS DATE) AS business_date, CAST(file_arrival_date + 2 AS DATE) AS file_arrival_date) "
             "FROM fx_partner_bronze WHERE k % 41 = 0 AND resend = 0")


class _Moved(fixture.Fixture):
    """The fixture with corrections that move a transaction to the next day."""

    def partner_bronze(self) -> DataFrame:
        rows = super().partner_bronze()
        later = rows.where("k % 41 = 0 AND resend = 0").withColumns({
            "utc_s": F.col("utc_s") + 86400, "local_s": F.col("local_s") + 86400,
            "file_arrival_date": F.date_add("file_arrival_date", 2)})
        return rows.unionByName(later)


@register("latest_arrival_across_dates", O.fx(
    "SELECT operator_code, partner_txn_id, msisdn_or_account, txn_type, plan_code, amount, currency, txn_ts_utc, txn_ts_local, "
    "business_date, file_arrival_date FROM (SELECT *, row_number() OVER (PARTITION BY operator_code, partner_txn_id "
    f"ORDER BY file_arrival_date DESC) AS rn_ FROM (SELECT * FROM fx_partner_bronze UNION ALL {MOVED_SQL}) b "
    "WHERE NOT bad_ts AND NOT bad_amt) q WHERE rn_ = 1"))
def q_latest_arrival_across_dates(spark, sf_dir):
    """Silver by arrivals in three steps, ranked across dates: a correction that moves a transaction takes it
    from its old day, which only the transaction directory knows."""
    cfg = ReconConfig(rank_before_date_filter=True)
    root = scratch_path(spark, "landing-moved")
    fixture_files.write_partner_feeds(_Moved(spark, sf_dir), root)
    lake = P.Lake(scratch_path(spark, "lake-moved"))
    for lo, hi in (("2023-12-25", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-02-10")):
        log = P.ingest_operator_feeds(spark, root, lake, _dates_between(lo, hi), O.RUN_TS, cfg)
        P.build_silver_partner(spark, lake, log["business_dates"], cfg)
    return P.silver_partner(spark, lake).select(*N.SILVER_PARTNER_COLUMNS)


@register("normalize_partner_rows", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, "
    "canon_type AS txn_type FROM o_raw WHERE NOT (bad_ts OR bad_amt)"))
def q_normalize_partner_rows(spark, sf_dir):
    n = _normalized(spark, sf_dir).where(F.col("_quarantine_reason").isNull())
    return n.select("operator_code", "partner_txn_id", "file_arrival_date", "txn_type")


# ---------------------------------------------------------------------------
# Internal change files -> bronze images -> silver platform stream
# ---------------------------------------------------------------------------


def _cdc(spark, sf_dir, table, dates=None):
    root = landing_root(spark, sf_dir, feeds=False, tables=(table,))["internal"]
    return PL.read_cdc(spark, root, table, dates=dates, ingested_at=O.RUN_TS)


def _image(spark, sf_dir, table):
    return PL.latest_image(_cdc(spark, sf_dir, table), CDC_TABLES[table].keys, CDC_TABLES[table].event_ts)


@register("scan_json_cdc", O.fx(
    "SELECT platform_event_id AS sub_id, user_id, operator_code, plan_id, partner_txn_id, status, "
    "strftime(make_timestamp(CAST(utc_s AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') AS created_ts, "
    "CAST(amount AS DOUBLE) AS amount FROM fx_platform_all WHERE event_type = 'subscription_success' "
    "UNION ALL SELECT platform_event_id, user_id, operator_code, plan_id, partner_txn_id, 'pending', "
    "strftime(make_timestamp(CAST(utc_s AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S'), CAST(amount AS DOUBLE) "
    "FROM fx_platform_all WHERE event_type = 'subscription_success' AND k % 5 = 0"))
def q_scan_json_cdc(spark, sf_dir):
    return _cdc(spark, sf_dir, "sub_initial").drop("file_arrival_date", "_ingested_at")


@register("platform_sub_initial", O.fx("SELECT * EXCLUDE (business_date) FROM fx_platform "
                                       "WHERE event_type = 'subscription_success'"))
def q_platform_sub_initial(spark, sf_dir):
    return PL.platform_sub_initial(_image(spark, sf_dir, "sub_initial"))


@register("platform_recursion_success", O.fx("SELECT * EXCLUDE (business_date) FROM fx_platform "
                                             "WHERE event_type = 'recursion_success'"))
def q_platform_recursion_success(spark, sf_dir):
    return PL.platform_recursion_success(_image(spark, sf_dir, "sub_recursion_success"))


@register("platform_recursion_failure", O.fx("SELECT * EXCLUDE (business_date) FROM fx_platform "
                                             "WHERE event_type = 'recursion_failure'"))
def q_platform_recursion_failure(spark, sf_dir):
    return PL.platform_recursion_failure(_image(spark, sf_dir, "sub_recursion_failure"))


@register("silver_platform_events", O.fx("SELECT * FROM fx_platform"))
def q_silver_platform_events(spark, sf_dir):
    return PL.silver_platform_events(_image(spark, sf_dir, "sub_initial"),
                                     _image(spark, sf_dir, "sub_recursion_success"),
                                     _image(spark, sf_dir, "sub_recursion_failure"))


@register("churn_events", O.fx("SELECT * FROM fx_churn"))
def q_churn_events(spark, sf_dir):
    return PL.churn_events(_image(spark, sf_dir, "user_churn_events").drop("file_arrival_date", "_ingested_at"))


# ---------------------------------------------------------------------------
# Sinks, table sources and the restatement pipeline
# ---------------------------------------------------------------------------


_LAKE: dict = {}
# The arrival dates re-delivered in the second (restatement) run.
RERUN = ("2024-01-20", "2024-01-31")


def _dates_between(lo: str, hi: str):
    a, b = _dt.date.fromisoformat(lo), _dt.date.fromisoformat(hi)
    return [a + _dt.timedelta(days=i) for i in range((b - a).days + 1)]


def lake_for(spark: SparkSession, sf_dir: str) -> P.Lake:
    """A lakehouse built incrementally from the landing files: the arrival
    dates up to the split, then the rest (late files and change-file
    corrections for already built days arrive here), then a re-run of the
    later arrival dates, which must not change any table. The result must
    equal a one-shot build."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKE:
        landing_ = landing_root(spark, sf_dir)
        lake = P.Lake(scratch_path(spark, "lake"))
        arrivals = P.landed_arrival_dates(spark, landing_)
        split = _dt.date.fromisoformat(RERUN[0])
        P.restate(spark, landing_, lake, [d for d in arrivals if d < split], run_ts=O.RUN_TS)
        P.restate(spark, landing_, lake, [d for d in arrivals if d >= split], run_ts=O.RUN_TS)
        P.restate(spark, landing_, lake, _dates_between(*RERUN), run_ts=O.RUN_TS)
        _LAKE[key] = lake
    return _LAKE[key]


@register("restate_dates", O.engine("SELECT * FROM o_fact"))
def q_restate_dates(spark, sf_dir):
    return K.read_table(spark, lake_for(spark, sf_dir).fact).select(*overlays.FACT_COLUMNS)


@register("mart_incremental_daily", O.marts("SELECT * FROM o_daily"))
def q_mart_incremental_daily(spark, sf_dir):
    d = K.read_table(spark, lake_for(spark, sf_dir).daily)
    return d.select(*[c for c in d.columns if c != "business_date"], "business_date")


@register("mart_full_rebuild", O.marts("SELECT * FROM o_monthly"))
def q_mart_full_rebuild(spark, sf_dir):
    return K.read_table(spark, lake_for(spark, sf_dir).monthly)


@register("ingest_row_counts", O.marts(
    "SELECT 'bronze.operator_feeds' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM fx_partner_bronze "
    "UNION ALL SELECT 'silver.partner_events', count(*) FROM fx_partner "
    "UNION ALL SELECT 'silver.platform_events', count(*) FROM fx_platform "
    "UNION ALL SELECT 'gold.fact_reconciliation_break', count(*) FROM o_fact"))
def q_ingest_row_counts(spark, sf_dir):
    """Rows written per layer, observed inside the write jobs (no re-count)."""
    landing_ = landing_root(spark, sf_dir)
    lake = P.Lake(scratch_path(spark, "lake-counts"))
    log = P.restate(spark, landing_, lake, None, run_ts=O.RUN_TS)
    rows = [("bronze.operator_feeds", log["bronze_feeds"]["rows"]),
            ("silver.partner_events", log["silver_partner"]["rows"]),
            ("silver.platform_events", log["silver_platform"]["rows"]),
            ("gold.fact_reconciliation_break", log["gold"]["rows"])]
    return spark.createDataFrame(rows, "table_name string, n_rows bigint")


@register("scan_partition_pruned", O.raw(
    "SELECT DISTINCT operator_code, r_id AS partner_txn_id, file_arrival_date, r_amount AS value "
    "FROM o_raw WHERE operator_code = 'telco_a'"))
def q_scan_partition_pruned(spark, sf_dir):
    b = T.scan_partition_pruned(spark, lake_for(spark, sf_dir).bronze_feeds, "operator_code", ["telco_a"])
    return b.select("operator_code", "partner_txn_id", "file_arrival_date", "value")


@register("read_optional_table", O.fx("SELECT * FROM fx_partner"))
def q_read_optional_table(spark, sf_dir):
    from ..operators.normalize import SILVER_PARTNER_COLUMNS
    lake = lake_for(spark, sf_dir)
    contract = _fx(spark, sf_dir).partner_events().schema
    present = T.read_optional_table(spark, lake.silver_partner, contract)
    absent = T.read_optional_table(spark, lake.path("silver", "no_such_table"), contract)
    return present.unionByName(absent).select(*SILVER_PARTNER_COLUMNS)


def _registered(spark, sf_dir, db: str) -> str:
    lake = lake_for(spark, sf_dir)
    K.register_external_table(spark, db, "partner_events", lake.silver_partner)
    return f"`{db}`.`partner_events`"


@register("register_external_tables", O.fx("SELECT * FROM fx_partner"))
def q_register_external_tables(spark, sf_dir):
    from ..operators.normalize import SILVER_PARTNER_COLUMNS
    return spark.table(_registered(spark, sf_dir, "silver_reg")).select(*SILVER_PARTNER_COLUMNS)


@register("read_catalog_table", O.fx(
    "SELECT business_date, operator_code, count(*) AS n_rows FROM fx_partner GROUP BY 1, 2"))
def q_read_catalog_table(spark, sf_dir):
    t = T.read_catalog_table(spark, _registered(spark, sf_dir, "silver_cat"))
    return t.groupBy("business_date", "operator_code").agg(F.count(F.lit(1)).alias("n_rows"))


def _silver_copy(spark, sf_dir, name, partition_by=("business_date",)):
    path = scratch_path(spark, name)
    K.full_overwrite(_fx(spark, sf_dir).partner_events(), path, list(partition_by))
    return path


@register("sink_replace_partition", O.fx(
    f"SELECT * FROM fx_partner WHERE NOT (business_date BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}') "
    f"OR (txn_type <> 'recursion_success' AND business_date <> DATE '{WEEK[1]}')"))
def q_sink_replace_partition(spark, sf_dir):
    """Replace a week of dates; the last day gets no rows and must vanish."""
    from ..operators.normalize import SILVER_PARTNER_COLUMNS
    path = _silver_copy(spark, sf_dir, "replace")
    week = _week_dates()
    new = (_fx(spark, sf_dir).partner_events()
           .where(F.col("business_date").between(F.lit(WEEK[0]).cast("date"), F.lit(WEEK[1]).cast("date")))
           .where((F.col("txn_type") != "recursion_success") & (F.col("business_date") != F.lit(WEEK[1]).cast("date"))))
    K.replace_partitions(new, path, ["business_date"], [(d,) for d in week])
    return K.read_table(spark, path).select(*SILVER_PARTNER_COLUMNS)


@register("sink_full_overwrite", O.fx("SELECT * FROM fx_partner"))
def q_sink_full_overwrite(spark, sf_dir):
    """A table re-written with another partition layout (reset, not merge)."""
    from ..operators.normalize import SILVER_PARTNER_COLUMNS
    path = _silver_copy(spark, sf_dir, "overwrite")
    K.replace_partitions(_fx(spark, sf_dir).partner_events(), path, ["operator_code"],
                         [(op,) for op in FEEDS])
    return K.read_table(spark, path).select(*SILVER_PARTNER_COLUMNS)


SUB_IMAGE_SQL = (
    "SELECT platform_event_id AS sub_id, user_id, operator_code, plan_id, partner_txn_id, status, "
    "strftime(make_timestamp(CAST(utc_s AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') AS created_ts, "
    "CAST(amount AS DOUBLE) AS amount, "
    "CAST(DATE '1970-01-01' + CAST(utc_s // 86400 + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS DATE) "
    "AS file_arrival_date FROM fx_platform_all WHERE event_type = 'subscription_success'")


@register("sink_merge_upsert", O.fx(SUB_IMAGE_SQL))
def q_sink_merge_upsert(spark, sf_dir):
    """Change files merged in two passes (early arrivals, then the rest)."""
    changes = _cdc(spark, sf_dir, "sub_initial").drop("_ingested_at")
    path = scratch_path(spark, "merge")
    cut = F.lit(WEEK[1]).cast("date")
    K.merge_upsert(changes.where(F.col("file_arrival_date") <= cut), path, CDC_TABLES["sub_initial"].keys,
                   ["operator_code"])
    K.merge_upsert(changes.where(F.col("file_arrival_date") > cut), path, CDC_TABLES["sub_initial"].keys,
                   ["operator_code"])
    return K.read_table(spark, path).select(*changes.columns)


@register("sink_merge_indexed", O.fx(SUB_IMAGE_SQL))
def q_sink_merge_indexed(spark, sf_dir):
    """Change files merged in three passes, the last out of order, into an image by event date; the key
    directory finds the older versions. The image must end as one of all changes, and the directory with it."""
    changes = _cdc(spark, sf_dir, "sub_initial").drop("_ingested_at")
    spec = CDC_TABLES["sub_initial"]
    changes = changes.withColumn("event_date", F.to_date(F.try_to_timestamp(F.col(spec.event_ts))))
    path = scratch_path(spark, "merge-indexed")
    day = F.dayofmonth("file_arrival_date")
    for part in (day.between(8, 14), day > 14, day < 8):
        K.merge_upsert(changes.where(part), path, spec.keys, P.CDC_PARTITIONS, ["file_arrival_date", spec.event_ts], use_directory=True)
    image = K.read_table(spark, path)
    wrong = K.directory_of(spark, path, image, P.CDC_PARTITIONS).audit(K.key_places(image, spec.keys, P.CDC_PARTITIONS))
    # a key that the directory has elsewhere than the image would show up as a row of its own
    return image.drop("event_date").unionByName(wrong.select(F.col("what").alias("sub_id")), allowMissingColumns=True)


@register("sink_schema_evolution", O.fx(
    "SELECT sub_id, user_id, operator_code, plan_id, partner_txn_id, "
    "CASE WHEN operator_code = 'telco_b' THEN upper(status) ELSE status END AS status, created_ts, amount, "
    "file_arrival_date, CASE WHEN operator_code = 'telco_b' THEN 'app' END AS channel "
    f"FROM ({SUB_IMAGE_SQL}) z"))
def q_sink_schema_evolution(spark, sf_dir):
    """A narrower source with a new column: matched rows keep the columns
    the source lacks, the new column widens the table."""
    changes = _cdc(spark, sf_dir, "sub_initial").drop("_ingested_at")
    path = scratch_path(spark, "evolve")
    keys = CDC_TABLES["sub_initial"].keys
    K.merge_upsert(changes, path, keys, ["operator_code"])
    image = K.read_table(spark, path)
    upd = (image.where(F.col("operator_code") == "telco_b")
           .select("sub_id", "operator_code", F.upper("status").alias("status"), "file_arrival_date",
                   F.lit("app").alias("channel")))
    K.merge_upsert(upd, path, keys, ["operator_code"])
    return K.read_table(spark, path).select(*changes.columns, "channel")


@register("sink_parquet_snapshot", O.engine("SELECT * FROM o_fact"))
def q_sink_parquet_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    K.export_snapshot(K.read_table(spark, lake_for(spark, sf_dir).fact), path)
    return spark.read.parquet(path).select(*overlays.FACT_COLUMNS)


# ---------------------------------------------------------------------------
# Streaming: restate on file arrival
# ---------------------------------------------------------------------------

@register("stream_restate_on_arrival", O.engine("SELECT * FROM o_fact"))
def q_stream_restate_on_arrival(spark, sf_dir):
    """Landing files discovered by a checkpointed file stream; a second run
    finds nothing new and leaves the tables as they are."""
    from ..streaming.arrivals import restate_on_arrival
    landing_ = landing_root(spark, sf_dir)
    lake = P.Lake(scratch_path(spark, "lake-stream"))
    ckpt = scratch_path(spark, "stream-ckpt")
    restate_on_arrival(spark, landing_, lake, ckpt, run_ts=O.RUN_TS)
    again = restate_on_arrival(spark, landing_, lake, ckpt, run_ts=O.RUN_TS)
    assert again == [], "files already seen were processed again"
    return K.read_table(spark, lake.fact).select(*overlays.FACT_COLUMNS)


@register("match_fallback_one_to_one", O.engine_one_to_one(f"SELECT {O.PAIR_COLS} FROM o_zip"))
def q_match_fallback_one_to_one(spark, sf_dir):
    f = fixture.load(spark, sf_dir, jitter=False)      # the SQL states the exact phase alone
    from ..operators.reconcile import matcher
    m = matcher(f.partner_events(), f.platform_events(), ReconConfig(pairing="one_to_one"))
    return m.release_with(m.fallback)


@register("match_fallback_one_to_one_tolerance")
def q_match_fallback_one_to_one_tolerance(spark, sf_dir):
    """The same over amounts at and around the tolerances, where leftovers are allocated chain by chain.
    The greedy order is beyond SQL; tests hold the result against a row-level version."""
    f = _fx(spark, sf_dir)
    from ..operators.reconcile import matcher
    m = matcher(f.partner_events(), f.platform_events(), ReconConfig(pairing="one_to_one"))
    return m.release_with(m.fallback)


@register("tolerance_chains", O.engine(O.CHAINS))
def q_tolerance_chains(spark, sf_dir):
    """Distinct amounts of both remainders, cut where no valid pair can span the gap."""
    from ..operators.matching import AMOUNT_KEY
    from ..operators.pairing import tolerance_chains
    from ..operators.reconcile import matcher
    f = _fx(spark, sf_dir)
    m = matcher(f.partner_events(), f.platform_events(), ReconConfig(pairing="one_to_one"))
    amounts = m._counts.select(*AMOUNT_KEY, "amount")
    return m.release_with(tolerance_chains(amounts, AMOUNT_KEY, m.cfg))


def _dated_rules(spark):
    """The feeds' rules, with two codes that telco_a re-maps in the test week."""
    dates = "CAST(valid_from AS DATE) AS valid_from, CAST(valid_to AS DATE) AS valid_to"
    more = spark.sql(f"SELECT operator_code, kind, name, value, {dates} FROM VALUES "
                     f"('telco_a', 'type', 'RENEW_OK', 'refund', '{WEEK[0]}', '{WEEK[1]}'), "
                     f"('telco_a', 'type', 'SUB', 'cancel', '{WEEK[1]}', NULL) AS t(operator_code, kind, name, value, valid_from, valid_to)")
    return FR.rules_of_feeds(spark).unionByName(more)


@register("silver_by_feed_rules", O.fx(
    "SELECT * REPLACE (CASE WHEN operator_code = 'telco_a' AND txn_type = 'recursion_success' "
    f"AND file_arrival_date >= DATE '{WEEK[0]}' AND file_arrival_date < DATE '{WEEK[1]}' THEN 'refund' "
    f"WHEN operator_code = 'telco_a' AND txn_type = 'subscription_success' AND file_arrival_date >= DATE '{WEEK[1]}' "
    "THEN 'cancel' ELSE txn_type END AS txn_type) FROM fx_partner"))
def q_silver_by_feed_rules(spark, sf_dir):
    return FR.silver_by_rules(_bronze(spark, sf_dir), _dated_rules(spark))


@register("dq_matched_balanced_tolerance", O.engine(
    "SELECT business_date, operator_code, partner_txn_id, partner_amount, internal_amount, amount_variance "
    f"FROM o_fact WHERE (recon_status = 'MATCHED' OR (operator_code = '{PLANTED}' AND recon_status = 'AMOUNT_MISMATCH')) "
    f"AND NOT coalesce({O.match_sql('partner_amount', 'internal_amount')}, FALSE)"))
def q_dq_matched_balanced_tolerance(spark, sf_dir):
    """The balance test with the matcher's own predicate (no false alarms on
    rows matched by the relative rule)."""
    fact = _stg(spark, sf_dir)[2]
    called = (F.col("operator_code") == PLANTED) & (F.col("recon_status") == "AMOUNT_MISMATCH")
    fact = fact.withColumn("recon_status", F.when(called, F.lit("MATCHED")).otherwise(F.col("recon_status")))
    return Q.dq_matched_balanced(fact, tolerance_aware=True)
