"""Feed rules as data: layouts, type codes and time encodings that change over time.

``normalize`` describes a feed by one ``FeedSpec``, valid for all time, as
branches of its expressions. Here the same facts are rows of a rules table with
a validity interval, so a code that a feed re-maps, a renamed column or a new
time format is one more row, and an arrival is read by the rules of its own
date: a restated old day keeps its old meaning.

A rule is ``(operator_code, kind, name, value, valid_from, valid_to)``:

====================  ==========================================================
kind                  meaning
====================  ==========================================================
``column``            canonical column ``name`` is the raw column ``value``
``type``              raw type code ``name`` means the canonical type ``value``
``time``              time text has the pattern ``value`` (or ``epoch_millis``)
``zone``              time text without an offset is in the zone ``value``
``currency``          rows without a currency are in ``value``
====================  ==========================================================

A rule holds from ``valid_from`` (included; NULL: since ever) to ``valid_to``
(excluded; NULL: until revoked). Where several hold, the one that started last
counts; of equal starts, the one that ends last (NULL is no end), then the
greatest value. A row without an arrival date sees only rules open at both
ends. Without a rule a type is ``unknown``, and any other value NULL (a row
without a time rule goes to quarantine). Repeated rules change nothing; rules
with a NULL operator, kind or value are never found.

Rules of an operator are collected into one map, so the as-of join is one equi
join with one row an operator whatever the number of feeds, and the plan has as
many expressions for six feeds as for six thousand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CANONICAL_FEED_COLUMNS, FEEDS
from ..functions.money import cast_amount
from ..functions.timestamps import business_date as to_business_date
from ..functions.timestamps import from_utc, parse_epoch_millis, to_utc
from .normalize import BRONZE_META, SILVER_PARTNER_COLUMNS, latest_arrival

RULE_SCHEMA = "operator_code string, kind string, name string, value string, valid_from date, valid_to date"
KINDS = ("column", "type", "time", "zone", "currency")
BETWEEN = "\u001f"
FOREVER = "9999-12-31"
#: up to this many rules the book is broadcast; counted before each use
BROADCAST_RULES = 100_000


def rules_of_feeds(spark: SparkSession, feeds: dict = FEEDS) -> DataFrame:
    """The feed specifications as rules without bounds."""
    rows = []
    for op, f in feeds.items():
        rows += [(op, "column", canon, raw, None, None) for raw, canon in f.column_map.items()]
        rows += [(op, "type", code, canon, None, None) for code, canon in f.txn_type_map.items()]
        rows += [(op, "time", "", f.parse_pattern or f.ts_format, None, None), (op, "zone", "", f.timezone, None, None),
                 (op, "currency", "", f.default_currency, None, None)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def rule_problems(rules: DataFrame) -> DataFrame:
    """Rules that cannot mean what was intended, with a reason: unknown kinds,
    empty intervals, missing parts, and two values that start on one day."""
    same = ["operator_code", "kind", "name", "valid_from"]
    reason = (F.when(F.col("operator_code").isNull() | F.col("kind").isNull() | F.col("value").isNull(), "missing_part")
              .when(~F.col("kind").isin(*KINDS), "unknown_kind")
              .when(F.col("valid_to") <= F.col("valid_from"), "empty_interval"))
    single = rules.select("*", reason.alias("reason")).where(F.col("reason").isNotNull())
    twice = (rules.groupBy(*same).agg(F.count_distinct("value").alias("n"), F.max("value").alias("value"),
                                      F.max("valid_to").alias("valid_to"))
             .where(F.col("n") > 1).select(*rules.columns, F.lit("two_values").alias("reason")))
    return single.unionByName(twice)


def rule_book(rules: DataFrame) -> DataFrame:
    """One row an operator: ``(operator_code, rules)``, a map from kind and name
    to the history of values, oldest first. Its size is that of the rules."""
    step = F.struct("valid_from", F.coalesce("valid_to", F.lit(FOREVER).cast("date")).alias("valid_to"), "value")
    known = rules.where(F.col("operator_code").isNotNull() & F.col("kind").isNotNull() & F.col("value").isNotNull())
    entries = (known.groupBy("operator_code", F.concat_ws(BETWEEN, "kind", F.coalesce("name", F.lit(""))).alias("_rule"))
               .agg(F.sort_array(F.collect_set(step)).alias("_history")))
    return entries.groupBy("operator_code").agg(
        F.map_from_entries(F.collect_list(F.struct("_rule", "_history"))).alias("rules"))


def rule_value(kind: str, name, on, rules="rules") -> Column:
    """The value of a rule on a date; NULL when none holds."""
    name = F.lit(name) if isinstance(name, str) else name
    on = F.col(on) if isinstance(on, str) else on
    key = F.concat(F.lit(kind + BETWEEN), name)

    def holds(step: Column) -> Column:
        open_end = step["valid_to"] == F.lit(FOREVER).cast("date")
        started = step["valid_from"].isNull() | F.coalesce(step["valid_from"] <= on, F.lit(False))
        return started & (open_end | F.coalesce(on < step["valid_to"], F.lit(False)))

    history = F.filter(F.try_element_at(F.col(rules), key), holds)
    return F.try_element_at(history, F.lit(-1))["value"]


def _time(raw: Column, pattern: Column, zone: Column) -> tuple[Column, Column]:
    """``(UTC instant, local wall clock)`` of raw time text by its rules."""
    epoch = pattern == "epoch_millis"
    parsed = F.when(epoch, parse_epoch_millis(raw)).otherwise(
        F.try_to_timestamp(raw, F.when(~epoch, pattern)))
    instant = epoch | pattern.endswith("XXX")
    return (F.when(instant, parsed).otherwise(to_utc(parsed, zone)),
            F.when(instant, from_utc(parsed, zone)).otherwise(parsed))


def normalize_by_rules(bronze: DataFrame, rules: DataFrame) -> DataFrame:
    """Bronze -> canonical rows with quarantine reasons, each read by the rules
    of its arrival date (the counterpart of ``normalize.normalize_partner``).

    The join is a left join on the operator. The rules are counted first: up to
    ``BROADCAST_RULES`` the book is broadcast and bronze is not shuffled; beyond,
    it is a shuffled join in which adaptive execution splits a hot operator's
    rows (they are on the preserved side). Operators without rules keep their
    rows, as quarantined. Bronze columns that no rule names are not read.
    """
    raw = [c for c in bronze.columns if c not in BRONZE_META]
    book = rule_book(rules).withColumnRenamed("operator_code", "_op")
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        book = F.broadcast(book)
    quoted = [f"`{c.replace('`', '``')}`" for c in raw]
    cells = F.map_from_arrays(F.array(*[F.lit(c) for c in raw]), F.array(*[F.col(q).cast("string") for q in quoted]))
    d = (bronze.select("operator_code", "file_arrival_date", cells.alias("_cells"))
         .join(book, F.col("operator_code") == F.col("_op"), "left"))
    on = "file_arrival_date"
    d = d.select("operator_code", on, "rules", *[
        F.try_element_at("_cells", rule_value("column", c, on)).alias(c) for c in CANONICAL_FEED_COLUMNS])
    utc, local = _time(F.col("txn_ts_local"), rule_value("time", "", on), rule_value("zone", "", on))
    d = d.select(
        "operator_code", "partner_txn_id", "msisdn_or_account",
        F.coalesce(rule_value("type", F.col("txn_type"), on), F.lit("unknown")).alias("txn_type"),
        "plan_code",
        cast_amount("amount").alias("amount"),
        F.coalesce(F.upper(F.nullif(F.trim("currency"), F.lit(""))), rule_value("currency", "", on)).alias("currency"),
        utc.alias("txn_ts_utc"),
        local.alias("txn_ts_local"),
        on,
        F.col("amount").alias("_amount_text"),
        F.col("txn_ts_local").alias("_time_text"),
    ).withColumn("business_date", to_business_date(F.col("txn_ts_utc")))
    reason = (F.when(F.col("txn_ts_utc").isNull(), F.lit("unparsable_time"))
              .when(F.col("_amount_text").isNotNull() & F.col("amount").isNull(), F.lit("unparsable_amount")))
    return d.withColumn("_quarantine_reason", reason)


def silver_by_rules(bronze: DataFrame, rules: DataFrame) -> DataFrame:
    """Bronze -> ``silver.partner_events`` by dated rules, latest arrival per business date."""
    good = normalize_by_rules(bronze, rules).where(F.col("_quarantine_reason").isNull())
    return latest_arrival(good.select(*SILVER_PARTNER_COLUMNS))
