"""Cross-cutting overlays on the classified rows, and the fact contract.

ORPHAN_CHURN: a successful charge for a user who churned on or before the
business date overrides any status. Churn history is reduced to the first
churn date per ``(user_id, operator_code)`` by partial aggregation before the
join, so the lookup side is bounded by the number of churned users, never by
the number of churn events, and one left join serves every business date.

LATE_ARRIVAL: a MATCHED row whose partner file arrived more than the
threshold after its business date (applied after the churn overlay).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHURN_SENSITIVE_TYPES, DEFAULT_RECON, ReconConfig
from ..functions.money import AMOUNT_TYPE, amount_variance, late_flag
from .matching import PAIR_COLUMNS

# The gold fact contract, in order.
FACT_COLUMNS = (
    "business_date",
    "operator_code",
    "recon_status",
    "match_confidence",
    "match_key",
    "partner_txn_id",
    "platform_event_id",
    "user_id",
    "msisdn_or_account",
    "txn_type",
    "partner_amount",
    "internal_amount",
    "amount_variance",
    "currency",
    "partner_txn_ts_utc",
    "platform_event_ts_utc",
    "file_arrival_date",
    "is_late_arrival",
    "recon_run_ts",
)


def churned_users(churn: DataFrame) -> DataFrame:
    """First churn date per (user_id, operator_code). Churn is permanent: a
    later re-subscription does not clear it."""
    return (churn.where(F.col("user_id").isNotNull() & F.col("churn_ts").isNotNull())
            .groupBy("user_id", "operator_code")
            .agg(F.min(F.to_date("churn_ts")).alias("churn_date")))


def overlay_orphan_churn(rows: DataFrame, churn: DataFrame | None) -> DataFrame:
    """Re-tag rows of churned users that still carry a successful charge.

    Only rows with a user, a positive partner amount and a churn-sensitive
    type can become orphans. Every other row (e.g. all MISSING_ON_PLATFORM
    rows, whose user is NULL) gets a join key that cannot match and is spread
    by a hash of the row, so no NULL or constant key piles into one reducer
    when the churn side is too big to broadcast.
    """
    if churn is None:
        return rows
    candidate = (F.col("user_id").isNotNull() & (F.col("partner_amount") > 0)
                 & F.col("txn_type").isin(*CHURN_SENSITIVE_TYPES))
    key = F.when(candidate, F.concat(F.lit("u"), F.col("user_id"))).otherwise(
        F.concat(F.lit("n"), F.xxhash64(*[F.col(c) for c in rows.columns]).cast("string")))
    r = rows.withColumn("_ck", key).alias("r")
    ch = churned_users(churn).select(F.concat(F.lit("u"), F.col("user_id")).alias("_ck"), "operator_code",
                                     "churn_date").alias("ch")
    joined = r.join(
        ch,
        (F.col("r._ck") == F.col("ch._ck"))
        & (F.col("r.operator_code") == F.col("ch.operator_code"))
        & (F.col("ch.churn_date") <= F.col("r.business_date")),
        "left",
    )
    orphan = F.col("ch.churn_date").isNotNull()
    out = [F.when(orphan, F.lit("ORPHAN_CHURN")).otherwise(F.col("r.recon_status")).alias("recon_status")
           if c == "recon_status" else F.col(f"r.{c}").alias(c) for c in rows.columns]
    return joined.select(*out)


def overlay_late_arrival(rows: DataFrame, cfg: ReconConfig = DEFAULT_RECON) -> DataFrame:
    """Add ``is_late_arrival``; a late MATCHED row becomes LATE_ARRIVAL."""
    late = late_flag(F.col("file_arrival_date"), F.col("business_date"), cfg)
    return (rows.withColumn("is_late_arrival", late)
            .withColumn("recon_status",
                        F.when(F.col("is_late_arrival") & (F.col("recon_status") == "MATCHED"),
                               F.lit("LATE_ARRIVAL")).otherwise(F.col("recon_status"))))


def run_ts_column(run_ts=None) -> Column:
    """Run timestamp: injected for reproducible output, else the query time."""
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, str):
        run_ts = _dt.datetime.fromisoformat(run_ts)
    return F.lit(run_ts).cast("timestamp")


def finish_fact(rows: DataFrame, churn: DataFrame | None, cfg: ReconConfig = DEFAULT_RECON,
                run_ts=None) -> DataFrame:
    """Classified rows -> the 19-column fact."""
    r = overlay_orphan_churn(rows.select(*PAIR_COLUMNS), churn)
    r = r.withColumn("amount_variance", amount_variance(F.col("partner_amount"), F.col("internal_amount")))
    r = overlay_late_arrival(r, cfg)
    r = r.withColumn("recon_run_ts", run_ts_column(run_ts))
    return r.select(*FACT_COLUMNS)


def cast_fact_contract(df: DataFrame) -> DataFrame:
    """Typed contract view over the fact: the three amounts as DECIMAL(12,2)."""
    return df.select(*[F.col(c).cast(AMOUNT_TYPE).alias(c)
                       if c in ("partner_amount", "internal_amount", "amount_variance") else F.col(c)
                       for c in FACT_COLUMNS])
