"""Platform side: internal change tables -> silver ``platform_events``.

Three transaction-bearing tables become one canonical event stream:
``sub_initial`` (charging statuses only) -> subscription_success,
``sub_recursion_success`` -> recursion_success, ``sub_recursion_failure`` ->
recursion_failure (amount 0, no partner key). Internal times are UTC.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

from ..config import CDC_TABLES, CHARGING_SUB_STATUSES, OPERATORS
from ..functions.groups import OWN_GROUP, with_own_group
from ..functions.money import cast_amount, zero_amount
from ..functions.timestamps import business_date
from ..sources.landing import scan_json_cdc
from .matching import filter_dates

PLATFORM_COLUMNS = (
    "operator_code",
    "platform_event_id",
    "event_type",
    "sub_id",
    "user_id",
    "partner_txn_id",
    "plan_id",
    "amount",
    "event_ts_utc",
    "business_date",
)

_TYPES = {"string": StringType(), "double": DoubleType(), "bigint": LongType(), "date": DateType(),
          "timestamp": TimestampType()}


def schema_of(ddl: str) -> StructType:
    """``"a string, b bigint"`` -> StructType (no session needed)."""
    fields = []
    for part in ddl.split(","):
        name, typ = part.split()
        fields.append(StructField(name, _TYPES[typ], True))
    return StructType(fields)


# Change-file contracts (JSON lines).
CDC_SCHEMAS = {
    "sub_initial": schema_of(
        "sub_id string, user_id string, operator_code string, plan_id string, partner_txn_id string, "
        "status string, created_ts string, amount double"),
    "sub_recursion_success": schema_of(
        "recursion_id string, sub_id string, user_id string, operator_code string, partner_txn_id string, "
        "amount double, recurrence_ts string, billing_cycle bigint"),
    "sub_recursion_failure": schema_of(
        "failure_id string, sub_id string, user_id string, operator_code string, failure_reason string, "
        "attempt_ts string, retry_count bigint"),
    "user_churn_events": schema_of(
        "user_id string, operator_code string, churn_ts string, churn_reason string, last_known_sub_id string"),
}


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return F.lit(value).cast("timestamp")


def read_cdc(spark: SparkSession, root: str, table: str, dates=None, ingested_at=None) -> DataFrame:
    """All change files of one logical table (every operator's folder) with
    ``operator_code`` taken from the folder and ingest metadata."""
    spec = CDC_TABLES[table]
    schema = CDC_SCHEMAS[table]
    df = scan_json_cdc(spark, root, table, schema, dates, OPERATORS if spec.per_operator else None)
    if df is None:
        st = StructType(schema.fields + schema_of(
            "file_arrival_date date, _ingested_at timestamp").fields)
        return spark.createDataFrame([], st)
    return df.withColumn("_ingested_at", _ts(ingested_at))


def latest_image(changes: DataFrame, keys, event_ts: str | None = None) -> DataFrame:
    """Latest change per primary key: by arrival date, then event time when
    named, then all columns as a total tie-break. This is what applying the
    change files in order leaves behind. Rows with a NULL key are inserts that
    never match and are all kept."""
    keys = list(keys)
    order = [c for c in ("file_arrival_date", event_ts) if c and c not in keys]
    rest = [c for c in changes.columns if c not in keys and c not in order]
    has_key = None
    for k in keys:
        c = F.col(k).isNotNull()
        has_key = c if has_key is None else has_key & c
    lead = [x for k, c in enumerate(order) for x in (F.col(c).isNotNull().alias(f"_o{k}"), F.col(c))]
    return (with_own_group(changes, has_key).groupBy(*keys, OWN_GROUP)
            .agg(F.max(F.struct(*lead, *rest)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}") for c in [*order, *rest]])).select(*changes.columns)


def quarantined_changes(image: DataFrame, spec) -> DataFrame:
    """Change rows that no event can be made of: their time does not parse, so
    they belong to no date. Raw text is kept next to the reason."""
    key = next(k for k in spec.keys if k != "operator_code")
    return image.where(F.try_to_timestamp(F.col(spec.event_ts)).isNull()).select(
        "operator_code", F.col(key).alias("change_id"), "file_arrival_date", F.col(spec.event_ts).alias("raw_time"),
        F.lit("unparsable_time").alias("reason"), "event_date")


def platform_sub_initial(si: DataFrame) -> DataFrame:
    """Charge attempts only (active / pending) -> subscription_success."""
    return si.where(F.col("status").isin(*CHARGING_SUB_STATUSES)).select(
        "operator_code",
        F.col("sub_id").alias("platform_event_id"),
        F.lit("subscription_success").alias("event_type"),
        "sub_id", "user_id", "partner_txn_id", "plan_id",
        cast_amount("amount").alias("amount"),
        F.try_to_timestamp(F.col("created_ts")).alias("event_ts_utc"))


def platform_recursion_success(rs: DataFrame) -> DataFrame:
    return rs.select(
        "operator_code",
        F.col("recursion_id").alias("platform_event_id"),
        F.lit("recursion_success").alias("event_type"),
        "sub_id", "user_id", "partner_txn_id",
        F.lit(None).cast("string").alias("plan_id"),
        cast_amount("amount").alias("amount"),
        F.try_to_timestamp(F.col("recurrence_ts")).alias("event_ts_utc"))


def platform_recursion_failure(rf: DataFrame) -> DataFrame:
    """Declines move no money: amount 0 and no partner key."""
    return rf.select(
        "operator_code",
        F.col("failure_id").alias("platform_event_id"),
        F.lit("recursion_failure").alias("event_type"),
        "sub_id", "user_id",
        F.lit(None).cast("string").alias("partner_txn_id"),
        F.lit(None).cast("string").alias("plan_id"),
        zero_amount().alias("amount"),
        F.try_to_timestamp(F.col("attempt_ts")).alias("event_ts_utc"))


def silver_platform_events(si: DataFrame, rs: DataFrame, rf: DataFrame, dates=None) -> DataFrame:
    """Union of the three kinds, business date from the UTC event time."""
    ev = (platform_sub_initial(si)
          .unionByName(platform_recursion_success(rs))
          .unionByName(platform_recursion_failure(rf)))
    ev = ev.withColumn("business_date", business_date(F.col("event_ts_utc")))
    return filter_dates(ev, dates).select(*PLATFORM_COLUMNS)


def churn_events(churn_changes: DataFrame) -> DataFrame:
    """Churn contract with a typed timestamp."""
    return churn_changes.select("user_id", "operator_code",
                                F.try_to_timestamp(F.col("churn_ts")).alias("churn_ts"),
                                "churn_reason", "last_known_sub_id")
