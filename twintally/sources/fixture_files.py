"""Render the derived fixture as raw landing files, the way feeds arrive.

Partner rows become one folder per feed and arrival date, in the feed's own
shape: raw column names and type codes, its delimiter, its time encoding
(local text, ISO with offset, ``Z`` text, epoch millis), lower-case or
missing currency codes, in-file duplicates, unmapped type codes and
unparsable time/amount text. Platform rows become the internal change files
(``sub_initial``, ``sub_recursion_success``, ``sub_recursion_failure`` per
operator and one ``user_churn_events``); some subscriptions are first sent as
``pending`` and corrected by a later file, so the bronze merge has updates to
apply. Everything is a Spark job over the derived tables; nothing is
collected to the driver. The derived rows are written once, by feed or change folder; each
folder's files are rendered from its own rows, several folders at a time.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CANONICAL_TXN_TYPES, CDC_TABLES, FEEDS, OPERATORS, FeedSpec
from ..session import scratch_path, together
from .fixture import Fixture
from .tables import delete_path, table_exists

UNMAPPED_CODE = "ZZ_UNMAPPED"


def _ts_text(seconds: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), pattern)


def _time_text(feed: FeedSpec) -> Column:
    f = feed.ts_format
    if f == "epoch_millis":
        txt = (F.col("utc_s") * 1000).cast("string")
    elif f.endswith("XXX"):
        txt = F.concat(_ts_text(F.col("local_s"), "yyyy-MM-dd'T'HH:mm:ss"),
                       F.format_string("+%02d:00", F.col("off_h").cast("int")))
    elif f.endswith("'Z'"):
        txt = F.concat(_ts_text(F.col("utc_s"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    else:
        txt = _ts_text(F.col("local_s"), f)
    return F.when(F.col("bad_ts"), F.lit("not-a-time")).otherwise(txt)


def _type_code(feed: FeedSpec) -> Column:
    rev = {canon: raw for raw, canon in feed.txn_type_map.items()}
    m = F.create_map(*[F.lit(x) for c in CANONICAL_TXN_TYPES[:5] for x in (c, rev[c])])
    return F.when(F.col("unk"), F.lit(UNMAPPED_CODE)).otherwise(m[F.col("txn_type")])


# Columns of the derived partner rows that the files are rendered from.
FEED_INPUT = ("partner_txn_id", "msisdn_or_account", "txn_type", "plan_code", "amount", "currency", "utc_s", "local_s", "off_h", "k",
              "unk", "bad_ts", "bad_amt", "dup", "file_arrival_date", "operator_code")


def feed_rows(bronze: DataFrame, feed: FeedSpec) -> DataFrame:
    """One feed's raw rows (all text) plus the ``batch`` folder name."""
    rows = bronze.where(F.col("operator_code") == feed.operator_code)
    ccy = (F.when(F.col("k") % 5 == 0, F.lit(None).cast("string"))
           .when(F.col("k") % 5 == 1, F.lower(F.col("currency"))).otherwise(F.col("currency")))
    amount = F.when(F.col("bad_amt"), F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    canon = {
        "partner_txn_id": F.col("partner_txn_id"),
        "msisdn_or_account": F.col("msisdn_or_account"),
        "txn_type": _type_code(feed),
        "plan_code": F.col("plan_code"),
        "amount": amount,
        "currency": ccy,
        "txn_ts_local": _time_text(feed),
    }
    cols = [canon[c].alias(raw) for raw, c in feed.column_map.items()]
    batch = F.concat(F.lit(feed.operator_code + "_"), F.date_format("file_arrival_date", "yyyyMMdd"))
    out = rows.select(*cols, batch.alias("batch"), "dup")
    # an in-file duplicate is delivered twice within the same batch
    return out.unionByName(out.where(F.col("dup"))).drop("dup")


@contextmanager
def _split(df: DataFrame, by: list[str]):
    """The rows, written once by the columns ``by``; removed afterwards."""
    path = scratch_path(df.sparkSession, "fixture-rows")
    df.write.partitionBy(*by).parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path) if table_exists(df.sparkSession, path) else df.limit(0)
    finally:
        delete_path(df.sparkSession, path)


def _json_lines(df: DataFrame, numeric: tuple = ()) -> DataFrame:
    """Rows -> JSON text lines; listed columns are written as JSON numbers
    when their text is numeric (as feeds send them)."""
    data = [c for c in df.columns if c != "batch"]
    line = F.to_json(F.struct(*data))
    for c in numeric:
        line = F.regexp_replace(line, f'"{c}":"(-?[0-9]+(\\.[0-9]+)?)"', f'"{c}":$1')
    return df.select(line.alias("value"), "batch")


def write_partner_feeds(fx: Fixture, root: str, feeds=None) -> None:
    """Write every feed under ``root/<operator>/batch=<operator>_<yyyyMMdd>/``."""
    def write(bronze: DataFrame, feed: FeedSpec) -> None:
        rows = feed_rows(bronze, feed).hint("rebalance", "batch")
        w = rows.write.mode("overwrite").partitionBy("batch")
        if feed.file_format == "csv":
            w.options(header="true", sep=feed.csv_options["sep"]).csv(f"{root}/{feed.operator_code}")
        else:
            _json_lines(rows, numeric=(feed.raw_for("amount"),)).write.mode("overwrite") \
                .partitionBy("batch").text(f"{root}/{feed.operator_code}", compression="gzip")

    some = list((feeds or FEEDS).values())
    rows = fx.partner_bronze().where(F.col("operator_code").isin([f.operator_code for f in some])).select(*FEED_INPUT)
    with _split(rows, ["operator_code"]) as bronze:
        together(fx.spark, [partial(write, bronze, feed) for feed in some])


# ---------------------------------------------------------------------------
# Internal change files
# ---------------------------------------------------------------------------

def _iso(seconds: Column) -> Column:
    return _ts_text(seconds, "yyyy-MM-dd'T'HH:mm:ss")


def _day_token(seconds: Column, plus_days: int = 0) -> Column:
    return F.date_format(F.date_add(F.to_date(F.timestamp_seconds(seconds)), plus_days), "yyyyMMdd")


EVENT_TYPE = {"sub_initial": "subscription_success", "sub_recursion_success": "recursion_success",
              "sub_recursion_failure": "recursion_failure"}


def cdc_rows(fx: Fixture, pa: DataFrame | None = None) -> dict[str, DataFrame]:
    """Change rows per physical folder, each with its ``batch`` name; ``pa`` are the platform rows."""
    pa = fx.platform_all() if pa is None else pa
    out: dict[str, DataFrame] = {}
    # sub_initial: k % 5 == 0 is first sent as pending, then corrected a day later
    si = pa.where(F.col("event_type") == "subscription_success").select(
        F.col("platform_event_id").alias("sub_id"), "user_id", "operator_code", "plan_id",
        "partner_txn_id", "status", _iso(F.col("utc_s")).alias("created_ts"),
        F.col("amount").cast("double").alias("amount"), "utc_s", "k")
    first = si.where(F.col("k") % 5 == 0).withColumn("status", F.lit("pending")) \
        .withColumn("_d", _day_token(F.col("utc_s")))
    final = si.withColumn("_d", F.when(F.col("k") % 5 == 0, _day_token(F.col("utc_s"), 1))
                          .otherwise(_day_token(F.col("utc_s"))))
    si_all = first.unionByName(final)
    rs = pa.where(F.col("event_type") == "recursion_success").select(
        F.col("platform_event_id").alias("recursion_id"), "sub_id", "user_id", "operator_code",
        "partner_txn_id", F.col("amount").cast("double").alias("amount"),
        _iso(F.col("utc_s")).alias("recurrence_ts"), ((F.col("k") % 12) + 1).alias("billing_cycle"),
        _day_token(F.col("utc_s")).alias("_d"))
    rf = pa.where(F.col("event_type") == "recursion_failure").select(
        F.col("platform_event_id").alias("failure_id"), "sub_id", "user_id", "operator_code",
        F.when(F.col("k") % 2 == 0, F.lit("insufficient_balance")).otherwise(F.lit("network_error"))
        .alias("failure_reason"), _iso(F.col("utc_s")).alias("attempt_ts"),
        ((F.col("k") % 3) + 1).alias("retry_count"), _day_token(F.col("utc_s")).alias("_d"))
    for name, df in (("sub_initial", si_all.drop("utc_s", "k")), ("sub_recursion_success", rs),
                     ("sub_recursion_failure", rf)):
        for op in OPERATORS:
            folder = f"{name}_{op}"
            out[folder] = (df.where(F.col("operator_code") == op)
                           .withColumn("batch", F.concat(F.lit(folder + "_"), F.col("_d"))).drop("_d"))
    ch = fx.churn().select(
        "user_id", "operator_code", F.date_format("churn_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("churn_ts"),
        "churn_reason",
        "last_known_sub_id",
        F.concat(F.lit("user_churn_events_"), F.date_format("churn_ts", "yyyyMMdd")).alias("batch"))
    out["user_churn_events"] = ch
    return out


NUMERIC_CDC = ("amount", "billing_cycle", "retry_count")


def write_cdc_files(fx: Fixture, root: str, tables=tuple(CDC_TABLES)) -> None:
    """Write ``root/<folder>/batch=<folder>_<yyyyMMdd>/`` JSON lines per table."""
    def write(folder: str, df: DataFrame) -> None:
        nums = tuple(c for c in NUMERIC_CDC if c in df.columns)
        (_json_lines(df, numeric=nums).hint("rebalance", "batch")
         .write.mode("overwrite").partitionBy("batch").text(f"{root}/{folder}", compression="gzip"))

    folders = {f"{t}_{op}" if CDC_TABLES[t].per_operator else t for t in tables for op in OPERATORS}
    kinds = [EVENT_TYPE[t] for t in tables if t in EVENT_TYPE]
    with _split(fx.platform_all().where(F.col("event_type").isin(kinds)), ["event_type", "operator_code"]) as pa:
        together(fx.spark, [partial(write, folder, df) for folder, df in cdc_rows(fx, pa).items() if folder in folders])


def write_landing(fx: Fixture, root: str) -> dict:
    """Both zones; returns their roots."""
    feeds, internal = f"{root}/operator_feeds", f"{root}/internal"
    together(fx.spark, [partial(write_partner_feeds, fx, feeds), partial(write_cdc_files, fx, internal)])
    return {"operator_feeds": feeds, "internal": internal}
