"""Partner feeds: bronze ingest and the silver ``partner_events`` stream.

Bronze keeps each feed's raw text columns (one merged super-schema across
feeds) plus ingest metadata, de-duplicated on the natural key per arrival
date. Silver maps every feed onto the canonical 11-column contract in ONE
pass over bronze: each canonical column is a ``CASE operator_code`` over the
feeds' raw columns, and the per-feed time encodings, zones, type codes and
default currencies are branches of the same expressions. There is no scan per
operator and no union of per-operator frames.

Bad text never fails a job and never disappears: rows whose time or amount
text does not parse are split off into a quarantine output with a reason.

The latest arrival per transaction is chosen with a ``max(struct(...))``
aggregation (partial aggregation, no sort of a hot key in one task) rather
than a ``row_number`` window.
"""

from __future__ import annotations

import datetime as _dt
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEEDS, FeedSpec
from ..functions.groups import OWN_GROUP, with_own_group
from ..functions.money import cast_amount
from ..functions.timestamps import business_date as to_business_date
from ..functions.timestamps import parse_feed_time
from ..session import together
from ..sources.landing import scan_feed
from .matching import filter_dates

SILVER_PARTNER_COLUMNS = (
    "operator_code",
    "partner_txn_id",
    "msisdn_or_account",
    "txn_type",
    "plan_code",
    "amount",
    "currency",
    "txn_ts_utc",
    "txn_ts_local",
    "business_date",
    "file_arrival_date",
)
BRONZE_KEY = ("operator_code", "partner_txn_id", "file_arrival_date")
BRONZE_META = ("operator_code", "partner_txn_id", "file_arrival_date", "_ingested_at", "_source_format")


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return F.lit(value).cast("timestamp")


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------

def bronze_natural_key(raw: DataFrame, feed: FeedSpec) -> DataFrame:
    """Expose the feed's transaction id under the canonical key name."""
    return raw.withColumn("partner_txn_id", F.col(feed.raw_for("partner_txn_id")).cast("string"))


def stamp_ingest_metadata(raw: DataFrame, feed: FeedSpec, ingested_at=None) -> DataFrame:
    """operator_code, natural key, arrival date (from the file name when the
    reader provided it), ingest time and source format."""
    df = bronze_natural_key(raw, feed)
    if "file_arrival_date" not in df.columns:
        df = df.withColumn("file_arrival_date", F.lit(None).cast("date"))
    return (df.withColumn("operator_code", F.lit(feed.operator_code))
            .withColumn("_ingested_at", _ts(ingested_at))
            .withColumn("_source_format", F.lit(feed.file_format)))


def dedupe_batch(df: DataFrame, keys=BRONZE_KEY) -> DataFrame:
    """One row per natural key and arrival date.

    The survivor is the smallest row by all remaining columns, so the choice
    is deterministic. It is a grouped ``min(struct)``: partial aggregation
    collapses duplicates map-side. Rows with a NULL key are not duplicates of
    each other (they have no key) and pass through untouched.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    has_key = F.col("partner_txn_id").isNotNull() if "partner_txn_id" in keys else F.lit(True)
    return (with_own_group(df, has_key).groupBy(*keys, OWN_GROUP).agg(F.min(F.struct(*rest)).alias("_r"))
            .select(*keys, "_r.*")).select(*df.columns)


def bronze_operator_feeds(spark: SparkSession, root: str, feeds: dict = FEEDS, dates=None,
                          ingested_at=None) -> DataFrame:
    """All feeds' landing files for the arrival dates as one bronze frame:
    raw text columns (merged super-schema) + metadata, de-duplicated."""
    frames = []
    scans = together(spark, [partial(scan_feed, spark, root, feed, dates) for feed in feeds.values()])
    for feed, raw in zip(feeds.values(), scans):
        if raw is not None:
            frames.append(dedupe_batch(stamp_ingest_metadata(raw, feed, ingested_at)))
    if not frames:
        raise FileNotFoundError(f"no landing files under {root} for {dates}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------

def _by_operator(per_feed: dict, default: Column | None = None) -> Column:
    """``CASE operator_code WHEN <op> THEN <expr> ... END``."""
    expr = None
    for op, e in per_feed.items():
        cond = F.col("operator_code") == op
        expr = F.when(cond, e) if expr is None else expr.when(cond, e)
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr.otherwise(default) if default is not None else expr


def normalize_columns(bronze: DataFrame, feeds: dict = FEEDS) -> DataFrame:
    """Canonical text columns from each feed's raw columns, in one projection."""
    present = set(bronze.columns)
    out = []
    for canon in ("partner_txn_id", "msisdn_or_account", "txn_type", "plan_code", "amount",
                  "currency", "txn_ts_local"):
        per = {op: F.col(f.raw_for(canon)).cast("string") for op, f in feeds.items()
               if f.raw_for(canon) in present}
        out.append(_by_operator(per, F.lit(None).cast("string")).alias(canon))
    return bronze.select("operator_code", *out, "file_arrival_date")


def map_txn_type(feeds: dict = FEEDS, op: Column | None = None, raw: Column | None = None) -> Column:
    """Raw type code -> canonical type through one literal map keyed by
    (operator, code); anything unmapped becomes ``unknown``."""
    op = F.col("operator_code") if op is None else op
    raw = F.col("txn_type") if raw is None else raw
    pairs = []
    for o, f in feeds.items():
        for code, canon in f.txn_type_map.items():
            pairs += [F.lit(f"{o}\u001f{code}"), F.lit(canon)]
    m = F.create_map(*pairs)
    return F.coalesce(m[F.concat(op, F.lit("\u001f"), raw)], F.lit("unknown"))


def normalize_currency(feeds: dict = FEEDS, ccy: Column | None = None) -> Column:
    """Upper-case code, else the operator's default currency."""
    ccy = F.col("currency") if ccy is None else ccy
    default = _by_operator({op: F.lit(f.default_currency) for op, f in feeds.items()})
    return F.coalesce(F.upper(F.nullif(F.trim(ccy), F.lit(""))), default)


def parse_times(feeds: dict = FEEDS, raw: Column | None = None) -> tuple[Column, Column]:
    """``(txn_ts_utc, txn_ts_local)`` by each feed's encoding and zone."""
    raw = F.col("txn_ts_local") if raw is None else raw
    utc, local = {}, {}
    for op, f in feeds.items():
        u, l_ = parse_feed_time(raw, f)
        utc[op], local[op] = u, l_
    return _by_operator(utc), _by_operator(local)


def business_date_of_raw(bronze_columns, feeds: dict = FEEDS) -> Column:
    """Business date straight from a bronze row's raw time text (NULL when
    unparsable); used to index arrival partitions by the dates they hold."""
    present = set(bronze_columns)
    raw_time = _by_operator({op: F.col(f.raw_for("txn_ts_local")).cast("string") for op, f in feeds.items()
                             if f.raw_for("txn_ts_local") in present}, F.lit(None).cast("string"))
    utc, _ = parse_times(feeds, raw=raw_time)
    return to_business_date(utc)


def parsed_once(df: DataFrame, **parsed: Column) -> DataFrame:
    """``df`` with a struct ``_parsed`` of the columns. The optimizer copies an expression into every
    filter and column that names it; it never copies what a generator makes, so text is parsed once a row."""
    return df.withColumn("_parsed", F.explode(F.array(F.struct(*[c.alias(name) for name, c in parsed.items()]))))


def normalize_partner(bronze: DataFrame, feeds: dict = FEEDS) -> DataFrame:
    """Bronze -> canonical rows with quarantine reasons (not yet filtered)."""
    utc, local = parse_times(feeds)
    t = parsed_once(normalize_columns(bronze, feeds), utc=utc, local=local, amount=cast_amount("amount"))
    t = t.select(
        "operator_code", "partner_txn_id", "msisdn_or_account",
        map_txn_type(feeds).alias("txn_type"),
        "plan_code",
        F.col("_parsed.amount").alias("amount"),
        normalize_currency(feeds).alias("currency"),
        F.col("_parsed.utc").alias("txn_ts_utc"),
        F.col("_parsed.local").alias("txn_ts_local"),
        "file_arrival_date",
        F.col("amount").alias("_amount_text"),
        F.col("txn_ts_local").alias("_time_text"),
    ).withColumn("business_date", to_business_date(F.col("txn_ts_utc")))
    reason = (F.when(F.col("txn_ts_utc").isNull(), F.lit("unparsable_time"))
              .when(F.col("_amount_text").isNotNull() & F.col("amount").isNull(), F.lit("unparsable_amount")))
    return t.withColumn("_quarantine_reason", reason)


def quarantined(normalized: DataFrame) -> DataFrame:
    """Rows set aside: raw text kept next to the reason."""
    return normalized.where(F.col("_quarantine_reason").isNotNull()).select(
        "operator_code", "partner_txn_id", "file_arrival_date",
        F.col("_time_text").alias("raw_time"), F.col("_amount_text").alias("raw_amount"),
        F.col("_quarantine_reason").alias("reason"))


def latest_arrival(df: DataFrame, per_business_date: bool = True) -> DataFrame:
    """Keep the latest arrival per (operator_code, partner_txn_id[, business_date]).

    ``max(struct(file_arrival_date, ...))`` picks the latest arrival (NULL
    arrival dates rank last) with a total tie-break on the other columns.
    NULL ids are not one transaction and pass through.
    """
    keys = ["operator_code", "partner_txn_id"] + (["business_date"] if per_business_date else [])
    rest = [c for c in df.columns if c not in keys and c != "file_arrival_date"]
    arrival_rank = F.col("file_arrival_date").isNotNull()
    return (with_own_group(df, F.col("partner_txn_id").isNotNull())
            .groupBy(*keys, OWN_GROUP)
            .agg(F.max(F.struct(arrival_rank.alias("_a"), F.col("file_arrival_date"), *rest)).alias("_r"))
            .select(*keys, "_r.file_arrival_date", *[F.col(f"_r.{c}") for c in rest])).select(*df.columns)


def silver_partner_events(bronze: DataFrame, feeds: dict = FEEDS, dates=None,
                          rank_before_date_filter: bool = False) -> DataFrame:
    """Bronze -> ``silver.partner_events`` for a set of business dates.

    Default order is the one-day-at-a-time order (restrict to the dates, then
    keep the latest arrival within each date). ``rank_before_date_filter``
    ranks across dates first, so a correction that moves a transaction to
    another date supersedes the stale copy.
    """
    good = normalize_partner(bronze, feeds).where(F.col("_quarantine_reason").isNull())
    good = good.select(*SILVER_PARTNER_COLUMNS)
    if rank_before_date_filter:
        return filter_dates(latest_arrival(good, per_business_date=False), dates)
    return latest_arrival(filter_dates(good, dates), per_business_date=True)
