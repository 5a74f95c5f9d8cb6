"""Data-quality checks. Each returns the offending rows (empty = pass), or a
report table, computed as one aggregate pass where several checks share a
table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RECON, ReconConfig
from ..functions.money import amounts_match

# Columns the marts promise never to leave NULL.
DAILY_NOT_NULL = ("business_date", "operator_code", "partner_txn_count", "internal_txn_count",
                  "matched_count", "break_count")
MONTHLY_NOT_NULL = ("close_month", "operator_code", "recognized_revenue")


def null_counts(df: DataFrame, model: str, columns) -> DataFrame:
    """One row per column: (model, column_name, null_count), from one pass."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"'{model}' AS model", f"stack({len(columns)}, {stack}) AS (column_name, null_count)")


def dq_not_null(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    return (null_counts(daily, "reconciliation_daily", DAILY_NOT_NULL)
            .unionByName(null_counts(monthly, "revenue_monthly_close", MONTHLY_NOT_NULL)))


def dq_unique_combination(df: DataFrame, columns=("business_date", "operator_code")) -> DataFrame:
    """Key combinations that occur more than once."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def dq_matched_balanced(stg_fact: DataFrame, cfg: ReconConfig = DEFAULT_RECON,
                        tolerance_aware: bool = False) -> DataFrame:
    """MATCHED rows whose amounts disagree.

    The default states the absolute-tolerance test; ``tolerance_aware=True``
    uses the matcher's own predicate (absolute OR relative), which has no
    false alarms on rows matched by the relative rule.
    """
    m = stg_fact.where(F.col("recon_status") == "MATCHED")
    if tolerance_aware:
        bad = ~F.coalesce(amounts_match(F.col("partner_amount"), F.col("internal_amount"), cfg), F.lit(False))
    else:
        bad = F.abs(F.col("amount_variance")) > F.lit(Decimal(cfg.amount_abs_tolerance))
    return m.where(bad).select("business_date", "operator_code", "partner_txn_id", "partner_amount",
                               "internal_amount", "amount_variance")


def dq_no_double_counting(stg_fact: DataFrame) -> DataFrame:
    """Partner transactions carried with an amount by more than one fact row."""
    return (stg_fact.where(F.col("partner_txn_id").isNotNull() & (F.col("partner_amount") > 0))
            .groupBy("operator_code", "partner_txn_id").agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def dq_unknown_txn_type(partner: DataFrame) -> DataFrame:
    """Unmapped partner types per day and operator (reported, never dropped)."""
    return (partner.groupBy("business_date", "operator_code")
            .agg(F.count_if(F.col("txn_type") == "unknown").alias("unknown_count"))
            .where(F.col("unknown_count") > 0))


def dq_platform_reused(fact: DataFrame) -> DataFrame:
    """Platform rows that serve more than one fallback pair (fan-out)."""
    return (fact.where(F.col("match_confidence") == "fallback")
            .groupBy("operator_code", "platform_event_id")
            .agg(F.count(F.lit(1)).alias("partner_rows"),
                 F.sum("internal_amount").cast("decimal(18,2)").alias("internal_amount_counted"))
            .where(F.col("partner_rows") > 1))
