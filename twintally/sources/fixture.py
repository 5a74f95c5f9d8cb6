"""Two-sided payment tables derived from the driver's ``orders`` table.

The driver's data has no partner/platform split, so one is derived by integer
arithmetic on the order key: a scenario number ``s = (k*7919) % 1000`` picks
matched / mismatched / missing / churned / late / null-key / re-sent rows.
The derivation is one SQL template rendered for two dialects (Spark SQL and
DuckDB), so the Spark pipeline and the SQL oracle start from identical rows.
Times are integer seconds; canonical timestamps and dates are computed from
them directly, while the raw feed renderer turns them into each feed's text.

``extended=False`` gives the base form (the status counts in FIXTURES.md);
``extended=True`` (the default) adds unknown type codes, declined renewals,
pending/failed subscriptions, dated churn, cross-midnight platform times,
corrections that re-send a fixed amount, in-file duplicates, and unparsable
time/amount text for the quarantine path. ``jitter`` (on with it) moves the
platform's amounts by differences at, just under and just over the absolute and
the relative tolerance, in both directions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Dialect macros: (spark, duckdb)
_MACROS = {
    "ts": ("timestamp_seconds({})", "make_timestamp(CAST({} AS BIGINT) * 1000000)"),
    "day": ("date_from_unix_date(CAST({} AS INT))", "CAST(DATE '1970-01-01' + CAST({} AS INTEGER) AS DATE)"),
    "idiv": ("({} div {})", "({} // {})"),
}


class Dialect:
    def __init__(self, name: str):
        assert name in ("spark", "duckdb")
        self.name = name
        self._i = 0 if name == "spark" else 1

    def ts(self, x: str) -> str:
        return _MACROS["ts"][self._i].format(x)

    def day(self, x: str) -> str:
        return _MACROS["day"][self._i].format(x)

    def idiv(self, a: str, b: str) -> str:
        return _MACROS["idiv"][self._i].format(a, b)

    @property
    def orders(self) -> str:
        return "{orders}" if self.name == "spark" else "orders"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")

# Fixed value: start of the derived calendar (2024-01-01T00:00:00Z).
EPOCH0 = 1704067200


def ctes(d: Dialect, extended: bool = True, jitter: bool | None = None) -> str:
    """The fixture as a list of CTE definitions (without the leading WITH)."""
    jitter = extended if jitter is None else jitter
    # the largest whole-cent difference that 0.5 % of a whole amount allows
    rel = "CAST(CAST({} AS DECIMAL(12,2)) * 0.01 AS DECIMAL(12,2))".format(d.idiv("CAST(amt AS INT)", "2"))
    plat_amt = (f"CAST(CASE k % 10 WHEN 1 THEN amt + 0.01 WHEN 2 THEN amt + 0.02 WHEN 3 THEN amt + {rel} "
                f"WHEN 4 THEN amt + {rel} + 0.01 WHEN 5 THEN amt - 0.01 WHEN 6 THEN amt - {rel} "
                f"WHEN 7 THEN amt - {rel} - 0.01 ELSE amt END AS DECIMAL(12,2))") if jitter else "amt"
    S = "CAST({} AS STRING)"
    kstr = S.format("k")
    cstr = S.format("c")
    ext = extended
    unk = "(k % 53 = 0)" if ext else "FALSE"
    bad_ts = "(k % 211 = 0)" if ext else "FALSE"
    bad_amt = "(k % 223 = 0 AND k % 211 <> 0)" if ext else "FALSE"
    dup = "(k % 71 = 0)" if ext else "FALSE"
    sub_status = ("CASE WHEN k % 101 = 0 THEN 'failed' WHEN k % 7 = 0 THEN 'pending' ELSE 'active' END"
                  if ext else "'active'")
    plat_delay = "CASE WHEN k % 13 = 0 THEN 7200 ELSE 0 END" if ext else "0"
    # first delivery of a re-sent row carries a wrong amount the re-send fixes
    first_amt = "CASE WHEN s >= 990 THEN amt + 1 ELSE amt END" if ext else "amt"
    pe_id = ("CASE ty WHEN 'subscription_success' THEN concat('sub-', {k}) ELSE concat('rc-', {k}) END"
             if ext else "concat('pe-', {k})").format(k=kstr)
    sub_id = ("CASE ty WHEN 'subscription_success' THEN concat('sub-', {k}) "
              "ELSE concat('sub-', {c}, '-', op) END" if ext else "concat('sub-', {k})").format(k=kstr, c=cstr)
    fail_rows = f"""
  UNION ALL
  SELECT op AS operator_code, concat(op, '-', {kstr}, '-f') AS partner_txn_id,
   concat('acct-', {cstr}) AS msisdn_or_account, 'recursion_failure' AS txn_type, plan AS plan_code,
   CAST(0 AS DECIMAL(12,2)) AS amount, loc - off_h * 3600 + 3600 AS utc_s, loc + 3600 AS local_s,
   0 AS lag_d, 0 AS resend, k, c, op, off_h, FALSE AS unk, {bad_ts} AS bad_ts, {bad_amt} AS bad_amt,
   FALSE AS dup
  FROM fx_base WHERE k % 89 = 0""" if ext else ""
    plat_fail_rows = f"""
  UNION ALL
  SELECT concat('rf-', {kstr}) AS platform_event_id, op AS operator_code, 'recursion_failure' AS event_type,
   concat('sub-', {cstr}, '-', op) AS sub_id, concat('u-', {cstr}) AS user_id,
   CAST(NULL AS STRING) AS partner_txn_id, CAST(NULL AS STRING) AS plan_id,
   CAST(0 AS DECIMAL(12,2)) AS amount, loc - off_h * 3600 + 3600 AS utc_s, k, 'active' AS status
  FROM fx_base WHERE k % 89 = 0""" if ext else ""
    if ext:
        churn = f"""fx_churn_raw AS (
  SELECT concat('u-', {cstr}) AS user_id, op AS operator_code,
   {EPOCH0} + ((k * 13) % 28) * 86400 + ((k * 7919) % 86400) AS churn_s,
   CASE WHEN k % 2 = 0 THEN 'voluntary' ELSE 'involuntary' END AS churn_reason,
   concat('sub-', {kstr}) AS last_known_sub_id
  FROM fx_base WHERE s BETWEEN 850 AND 899 AND c % 3 = 0)"""
    else:
        churn = f"""fx_churn_raw AS (
  SELECT DISTINCT concat('u-', {cstr}) AS user_id, op AS operator_code, {EPOCH0 - 86400} AS churn_s,
   'voluntary' AS churn_reason, CAST(NULL AS STRING) AS last_known_sub_id
  FROM fx_base WHERE s BETWEEN 850 AND 899 AND c % 3 = 0)"""

    return f"""fx_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, (o_orderkey * 7919) % 1000 AS s,
   CASE o_custkey % 6 WHEN 0 THEN 'telco_a' WHEN 1 THEN 'telco_b' WHEN 2 THEN 'telco_c'
    WHEN 3 THEN 'telco_d' WHEN 4 THEN 'wallet_x' ELSE 'wallet_y' END AS op,
   CASE o_custkey % 6 WHEN 2 THEN 4 WHEN 4 THEN 0 ELSE 5 END AS off_h,
   CASE WHEN o_orderkey % 97 = 0 THEN 'refund' WHEN o_orderstatus = 'O' THEN 'subscription_success'
    ELSE 'recursion_success' END AS ty,
   CAST(CASE o_orderkey % 4 WHEN 0 THEN 99 WHEN 1 THEN 149 WHEN 2 THEN 299 ELSE 499 END AS DECIMAL(12,2)) AS amt,
   {EPOCH0} + (o_orderkey % 28) * 86400 + ((o_orderkey * 37) % 1440) * 60 AS loc,
   CASE o_orderkey % 3 WHEN 0 THEN 'P_BASIC' WHEN 1 THEN 'P_STD' ELSE 'P_PREMIUM' END AS plan
  FROM {d.orders}),
fx_partner_all AS (
  SELECT op AS operator_code, concat(op, '-', {kstr}) AS partner_txn_id,
   concat('acct-', {cstr}) AS msisdn_or_account, ty AS txn_type, plan AS plan_code,
   CAST(CASE WHEN s BETWEEN 620 AND 699 THEN amt + 50 WHEN s >= 980 THEN {first_amt} ELSE amt END
        AS DECIMAL(12,2)) AS amount,
   loc - off_h * 3600 AS utc_s, loc AS local_s,
   CASE WHEN s BETWEEN 900 AND 939 THEN 3 ELSE 0 END AS lag_d, 0 AS resend,
   k, c, op, off_h, {unk} AS unk, {bad_ts} AS bad_ts, {bad_amt} AS bad_amt, {dup} AS dup
  FROM fx_base WHERE NOT (s BETWEEN 780 AND 849)
  UNION ALL
  SELECT op, concat(op, '-', {kstr}), concat('acct-', {cstr}), ty, plan, amt,
   loc - off_h * 3600, loc, 1, 1, k, c, op, off_h, {unk}, {bad_ts}, {bad_amt}, FALSE
  FROM fx_base WHERE s >= 980{fail_rows}),
fx_partner_bronze AS (
  SELECT operator_code, partner_txn_id, msisdn_or_account,
   CASE WHEN unk THEN 'unknown' ELSE txn_type END AS txn_type, plan_code, amount,
   CASE operator_code WHEN 'telco_c' THEN 'AED' WHEN 'wallet_x' THEN 'USD' ELSE 'PKR' END AS currency,
   {d.ts('utc_s')} AS txn_ts_utc, {d.ts('local_s')} AS txn_ts_local,
   {d.day(d.idiv('utc_s', '86400'))} AS business_date,
   {d.day(d.idiv('local_s', '86400') + ' + lag_d')} AS file_arrival_date,
   lag_d, resend, k, c, off_h, unk, bad_ts, bad_amt, dup, utc_s, local_s
  FROM fx_partner_all),
fx_partner AS (
  SELECT operator_code, partner_txn_id, msisdn_or_account, txn_type, plan_code, amount, currency,
   txn_ts_utc, txn_ts_local, business_date, file_arrival_date
  FROM (SELECT *, row_number() OVER (PARTITION BY operator_code, partner_txn_id
                                     ORDER BY file_arrival_date DESC) AS rn_
        FROM fx_partner_bronze WHERE NOT bad_ts AND NOT bad_amt) q
  WHERE rn_ = 1),
fx_platform_all AS (
  SELECT {pe_id} AS platform_event_id, op AS operator_code, ty AS event_type, {sub_id} AS sub_id,
   concat('u-', {cstr}) AS user_id,
   CASE WHEN s BETWEEN 940 AND 979 THEN CAST(NULL AS STRING) ELSE concat(op, '-', {kstr}) END AS partner_txn_id,
   CASE WHEN ty = 'subscription_success' THEN plan ELSE CAST(NULL AS STRING) END AS plan_id,
   {plat_amt} AS amount, loc - off_h * 3600 + {plat_delay} AS utc_s, k,
   CASE WHEN ty = 'subscription_success' THEN {sub_status} ELSE 'active' END AS status
  FROM fx_base WHERE NOT (s BETWEEN 700 AND 779) AND ty <> 'refund'{plat_fail_rows}),
fx_platform AS (
  SELECT operator_code, platform_event_id, event_type, sub_id, user_id, partner_txn_id, plan_id,
   CAST(amount AS DECIMAL(12,2)) AS amount, {d.ts('utc_s')} AS event_ts_utc,
   {d.day(d.idiv('utc_s', '86400'))} AS business_date
  FROM fx_platform_all WHERE status IN ('active', 'pending')),
{churn},
fx_churn AS (
  SELECT user_id, operator_code, {d.ts('churn_s')} AS churn_ts, churn_reason, last_known_sub_id
  FROM fx_churn_raw)"""


def with_fixture(sql_body: str, d: Dialect = DUCKDB, extended: bool = True, jitter: bool | None = None) -> str:
    """Prefix a query over the ``fx_*`` tables with the fixture CTEs."""
    return f"WITH {ctes(d, extended, jitter)}\n{sql_body}"


@dataclass
class Fixture:
    """The derived tables as Spark DataFrames over one ``orders`` scan each."""

    spark: SparkSession
    sf_dir: str
    extended: bool = True
    jitter: bool | None = None

    def orders(self) -> DataFrame:
        return (self.spark.read.parquet(f"{self.sf_dir}/orders.parquet")
                .select("o_orderkey", "o_custkey", "o_orderstatus"))

    def table(self, name: str) -> DataFrame:
        sql = with_fixture(f"SELECT * FROM {name}", SPARK, self.extended, self.jitter)
        return self.spark.sql(sql, orders=self.orders())

    # canonical partner rows before latest-arrival ranking, with scenario flags
    def partner_bronze(self) -> DataFrame:
        return self.table("fx_partner_bronze")

    # silver.partner_events contract (11 columns), one row per latest arrival
    def partner_events(self) -> DataFrame:
        return self.table("fx_partner")

    # platform rows with raw status and seconds (input of the CDC renderer)
    def platform_all(self) -> DataFrame:
        return self.table("fx_platform_all")

    # silver.platform_events contract (10 columns)
    def platform_events(self) -> DataFrame:
        return self.table("fx_platform")

    # bronze.user_churn_events
    def churn(self) -> DataFrame:
        return self.table("fx_churn")


def load(spark: SparkSession, sf_dir: str, extended: bool = True, jitter: bool | None = None) -> Fixture:
    from ..session import configure
    configure(spark)
    return Fixture(spark, sf_dir, extended, jitter)
