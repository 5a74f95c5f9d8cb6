"""Marts: typed staging views, populations, the daily summary, the monthly close.

The daily mart needs three groupings over the same ``(business_date,
operator_code)`` key (partner population, platform population, fact
categories) and a full-outer + left join between them. Here all three inputs
are projected to one tagged shape and aggregated by a single groupBy: one
shuffle of partially aggregated rows instead of three aggregations and two
joins. A key exists in the population iff it has a partner or platform row,
which is exactly the row set the left join from the population keeps.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MONEY_TYPES, PLATFORM_MONEY_TYPES, RECOGNISED_STATUSES
from ..functions.money import AMOUNT_TYPE, signed_amount
from ..functions.timestamps import month_bucket
from .overlays import cast_fact_contract

KEY = ("business_date", "operator_code")
# Sums in marts are reported as DECIMAL(18,2).
TOTAL_TYPE = "decimal(18,2)"


def _built_at(built_at=None) -> Column:
    if built_at is None:
        return F.current_timestamp()
    if isinstance(built_at, str):
        built_at = _dt.datetime.fromisoformat(built_at)
    return F.lit(built_at).cast("timestamp")


def stg_partner_events(partner: DataFrame) -> DataFrame:
    """Money-moving partner rows under the staging contract."""
    return partner.where(F.col("txn_type").isin(*MONEY_TYPES)).select(
        "business_date", "operator_code", "partner_txn_id", "msisdn_or_account", "txn_type",
        F.col("amount").cast(AMOUNT_TYPE).alias("amount"), "currency", "txn_ts_utc", "file_arrival_date")


def stg_platform_events(platform: DataFrame) -> DataFrame:
    """Money-moving platform rows (declines excluded) under the staging contract."""
    return platform.where(F.col("event_type").isin(*PLATFORM_MONEY_TYPES)).select(
        "business_date", "operator_code", "platform_event_id", "event_type", "sub_id", "user_id",
        "partner_txn_id", F.col("amount").cast(AMOUNT_TYPE).alias("amount"), "event_ts_utc")


def stg_reconciliation_break(fact: DataFrame) -> DataFrame:
    return cast_fact_contract(fact)


def _pop(df: DataFrame, count_name: str, sum_name: str) -> DataFrame:
    return df.groupBy(*KEY).agg(F.count(F.lit(1)).alias(count_name),
                                F.sum("amount").cast(TOTAL_TYPE).alias(sum_name))


def partner_population(stg_partner: DataFrame) -> DataFrame:
    return _pop(stg_partner, "partner_txn_count", "partner_amount_raw")


def platform_population(stg_platform: DataFrame) -> DataFrame:
    return _pop(stg_platform, "internal_txn_count", "internal_amount_raw")


def _tagged_population(stg_partner: DataFrame, stg_platform: DataFrame) -> DataFrame:
    z = F.lit(None).cast(AMOUNT_TYPE)
    p = stg_partner.select(*KEY, F.lit(1).alias("_pc"), F.lit(0).alias("_ic"),
                           F.col("amount").alias("_pa"), z.alias("_ia"))
    i = stg_platform.select(*KEY, F.lit(0).alias("_pc"), F.lit(1).alias("_ic"),
                            z.alias("_pa"), F.col("amount").alias("_ia"))
    return p.unionByName(i)


def source_population(stg_partner: DataFrame, stg_platform: DataFrame) -> DataFrame:
    """Both populations per key, missing sides as zero (one shuffle)."""
    zero = F.lit(0).cast(TOTAL_TYPE)
    return (_tagged_population(stg_partner, stg_platform).groupBy(*KEY).agg(
        F.sum("_pc").cast("bigint").alias("partner_txn_count"),
        F.sum("_ic").cast("bigint").alias("internal_txn_count"),
        F.coalesce(F.sum("_pa").cast(TOTAL_TYPE), zero).alias("partner_amount_raw"),
        F.coalesce(F.sum("_ia").cast(TOTAL_TYPE), zero).alias("internal_amount_raw")))


def _status_count(status: str) -> Column:
    return F.count_if(F.col("recon_status") == status)


def break_counts_by_category(stg_fact: DataFrame) -> DataFrame:
    """Per key: counts by status, break count, and the three money sums."""
    return stg_fact.groupBy(*KEY).agg(
        _status_count("MATCHED").alias("matched_count"),
        _status_count("LATE_ARRIVAL").alias("late_arrival_count"),
        _status_count("AMOUNT_MISMATCH").alias("amount_mismatch_count"),
        _status_count("MISSING_ON_PLATFORM").alias("missing_on_platform_count"),
        _status_count("MISSING_AT_PARTNER").alias("missing_at_partner_count"),
        _status_count("ORPHAN_CHURN").alias("orphan_churn_count"),
        F.count_if(~F.col("recon_status").isin("MATCHED", "LATE_ARRIVAL")).alias("break_count"),
        F.sum("partner_amount").cast(TOTAL_TYPE).alias("partner_amount_total"),
        F.sum("internal_amount").cast(TOTAL_TYPE).alias("internal_amount_total"),
        F.sum("amount_variance").cast(TOTAL_TYPE).alias("variance"),
    )


def match_rate(matched: Column, population: Column, digits: int = 4) -> Column:
    """``round(matched / nullif(population, 0), 4)``, rounded half-up on the
    exact ratio with integer arithmetic, so no double rounding at the half."""
    scale = 10 ** digits
    m = F.coalesce(matched, F.lit(0)).cast("bigint")
    n = population.cast("bigint")
    num = m * F.lit(2 * scale) + n
    den = n * F.lit(2)
    # floor(num / den) for non-negative longs, exact: (num - num mod den) / den
    quotient = ((num - F.pmod(num, den)) / den).cast("bigint")
    return F.when(n != 0, quotient.cast("double") / F.lit(float(scale)))


def mart_daily(stg_partner: DataFrame, stg_platform: DataFrame, stg_fact: DataFrame,
               built_at=None) -> DataFrame:
    """One row per (business_date, operator_code) with a population."""
    z = F.lit(None).cast(AMOUNT_TYPE)
    pop = _tagged_population(stg_partner, stg_platform).select(
        *KEY, "_pc", "_ic", F.lit(None).cast("string").alias("_st"), z.alias("_fp"), z.alias("_fi"),
        z.alias("_fv"))
    fact = stg_fact.select(*KEY, F.lit(0).alias("_pc"), F.lit(0).alias("_ic"),
                           F.col("recon_status").alias("_st"), F.col("partner_amount").alias("_fp"),
                           F.col("internal_amount").alias("_fi"), F.col("amount_variance").alias("_fv"))
    st = F.col("_st")
    zero = F.lit(0).cast(TOTAL_TYPE)
    agg = pop.unionByName(fact).groupBy(*KEY).agg(
        F.sum("_pc").cast("bigint").alias("partner_txn_count"),
        F.sum("_ic").cast("bigint").alias("internal_txn_count"),
        F.count_if(st == "MATCHED").alias("matched_count"),
        F.count_if(~st.isin("MATCHED", "LATE_ARRIVAL")).alias("break_count"),
        F.count_if(st == "LATE_ARRIVAL").alias("late_arrival_count"),
        F.coalesce(F.sum("_fp").cast(TOTAL_TYPE), zero).alias("partner_amount_total"),
        F.coalesce(F.sum("_fi").cast(TOTAL_TYPE), zero).alias("internal_amount_total"),
        F.coalesce(F.sum("_fv").cast(TOTAL_TYPE), zero).alias("variance"),
        F.count_if(st == "AMOUNT_MISMATCH").alias("amount_mismatch_count"),
        F.count_if(st == "MISSING_ON_PLATFORM").alias("missing_on_platform_count"),
        F.count_if(st == "MISSING_AT_PARTNER").alias("missing_at_partner_count"),
        F.count_if(st == "ORPHAN_CHURN").alias("orphan_churn_count"),
    )
    return (agg.where((F.col("partner_txn_count") + F.col("internal_txn_count")) > 0)
            .withColumn("match_rate", match_rate(F.col("matched_count"), F.col("partner_txn_count")))
            .withColumn("_built_at", _built_at(built_at)))


# The sums of the close, each additive over days.
CLOSE_SUMS = ("recognized_revenue", "revenue_from_mismatched", "revenue_from_unentitled", "total_abs_variance")


def _close(stg_fact: DataFrame, *by: Column | str) -> DataFrame:
    """Sums over the four booked statuses by any grouping of dates and operators."""
    st = F.col("recon_status")
    pa = F.col("partner_amount")
    zero = F.lit(0).cast(AMOUNT_TYPE)
    return (stg_fact.where(st.isin(*RECOGNISED_STATUSES)).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("recognized_txn_count"),
                 F.sum(signed_amount(pa, F.col("txn_type"))).cast(TOTAL_TYPE).alias("recognized_revenue"),
                 F.sum(F.when(st == "AMOUNT_MISMATCH", pa).otherwise(zero)).cast(TOTAL_TYPE)
                 .alias("revenue_from_mismatched"),
                 F.sum(F.when(st == "MISSING_ON_PLATFORM", pa).otherwise(zero)).cast(TOTAL_TYPE)
                 .alias("revenue_from_unentitled"),
                 F.sum(F.abs(F.col("amount_variance"))).cast(TOTAL_TYPE).alias("total_abs_variance")))


def mart_monthly_close(stg_fact: DataFrame, built_at=None) -> DataFrame:
    """Recognised revenue per (month, operator) from the four booked statuses."""
    return (_close(stg_fact, month_bucket(F.col("business_date")).alias("close_month"), "operator_code")
            .withColumn("_built_at", _built_at(built_at)))


def close_by_day(stg_fact: DataFrame) -> DataFrame:
    """The close's sums per (business_date, operator): the state from which months are rolled up.

    A restated day replaces its rows; the sums of the other days stay valid, so no other day
    of the fact is read again.
    """
    return _close(stg_fact, *KEY)


def close_from_days(days: DataFrame, built_at=None) -> DataFrame:
    """The monthly close from per-day sums; equal to ``mart_monthly_close`` over the fact of those days."""
    return (days.groupBy(month_bucket(F.col("business_date")).alias("close_month"), "operator_code")
            .agg(F.sum("recognized_txn_count").cast("bigint").alias("recognized_txn_count"),
                 *[F.sum(c).cast(TOTAL_TYPE).alias(c) for c in CLOSE_SUMS])
            .withColumn("_built_at", _built_at(built_at)))


def drilldown_breaks(mart: DataFrame, stg_fact: DataFrame) -> DataFrame:
    """Break rows of the fact next to their day's summary figures."""
    brk = stg_fact.where(~F.col("recon_status").isin("MATCHED", "LATE_ARRIVAL"))
    m = mart.select(*KEY, "break_count", "match_rate")
    return brk.join(m, list(KEY), "inner")
