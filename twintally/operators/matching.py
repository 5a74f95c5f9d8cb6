"""The tiered matcher: strong key, guarded fallback, classified survivors.

Inputs are the silver contracts (``partner_events``, ``platform_events``) for
any set of business dates at once; ``business_date`` is part of every join
key, so a many-day run gives the same rows as one run per day.

Plan shape (see ``match`` for the pieces):

* Tier 1 has the rows of a full outer join of keyed partner rows and keyed
  platform rows on ``(business_date, operator_code, partner_txn_id)``,
  planned as a left outer join (platform rows left, so a hot id is
  skew-split) plus an anti join of partner rows against the distinct
  platform keys. Pairs, partner remainder and platform remainder are three
  filters of that one table.
* Tier 2 never joins partner rows against platform rows directly. The best
  candidate of a partner row depends only on its ``(operator, type, date,
  amount)``, so both sides are first reduced by partial aggregation to
  distinct amounts (the platform side keeps the smallest event id per
  amount). The winner of a partner amount is the nearer of the nearest
  platform amounts below and above it (within tolerance), found by one
  ordered pass over the union of distinct amounts per logarithmic amount
  bucket (platform amounts also placed in the neighbouring buckets).
  Partner rows then pick up their winner with an equi-join whose right side
  has one row per key, which adaptive execution turns into a broadcast or a
  skew-split join. A hot amount or operator never lands in one task.
* Tier 3 survivors are anti joins against the winners.
"""

from __future__ import annotations

import math
import weakref
from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import (
    DEFAULT_RECON,
    MATCH_KEY_FALLBACK,
    MATCH_KEY_STRONG,
    MATCH_KEY_UNMATCHED_PARTNER,
    MATCH_KEY_UNMATCHED_PLATFORM,
    MONEY_TYPES,
    ReconConfig,
)
from ..functions.money import amounts_match, zero_amount

# Columns every classified row carries before the overlays.
PAIR_COLUMNS = (
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
    "currency",
    "partner_txn_ts_utc",
    "platform_event_ts_utc",
    "file_arrival_date",
)

STRONG_KEY = ("business_date", "operator_code", "partner_txn_id")
# Input columns the fact carries; with ``slim=True`` nothing else is read,
# shuffled or cached.
PARTNER_FACT_INPUT = ("operator_code", "partner_txn_id", "msisdn_or_account", "txn_type", "amount", "currency",
                      "txn_ts_utc", "business_date", "file_arrival_date")
PLATFORM_FACT_INPUT = ("operator_code", "platform_event_id", "event_type", "user_id", "partner_txn_id", "amount",
                       "event_ts_utc", "business_date")
AMOUNT_KEY = ("operator_code", "txn_type", "business_date")


@dataclass(frozen=True)
class DateRange:
    """Business dates from ``lo`` to ``hi``, both included."""

    lo: object
    hi: object


def filter_dates(df: DataFrame, dates=None, column: str = "business_date") -> DataFrame:
    """Restrict to business dates: None = all, a ``DateRange``, or any
    iterable as a set of dates. On a table partitioned by the date this is a
    partition filter."""
    if dates is None:
        return df
    if isinstance(dates, DateRange):
        return df.where(F.col(column).between(F.lit(dates.lo).cast("date"), F.lit(dates.hi).cast("date")))
    return df.where(F.col(column).isin([F.lit(d).cast("date") for d in dates]))


def partner_money(partner: DataFrame, dates=None) -> DataFrame:
    """Partner rows that must reconcile (money-moving types) for the dates."""
    return filter_dates(partner, dates).where(F.col("txn_type").isin(*MONEY_TYPES))


# ---------------------------------------------------------------------------
# Amount buckets for the tolerance join
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class AmountBuckets:
    """Logarithmic buckets such that any two amounts within tolerance are at
    most one bucket apart.

    With ``x = ln(max(|a|, floor))`` and width ``w``: the relative test bounds
    ``|x_p - x_i|`` by ``ln(1/(1-rel))``; the absolute test by
    ``ln(1 + abs/floor)``; amounts below ``0.01*(1+rel)`` share the floor.
    The width takes the larger of the relative bound and the chosen minimum,
    and the floor is raised until the absolute bound fits in the width.
    """

    width: float
    floor: float

    @classmethod
    def for_config(cls, cfg: ReconConfig, min_width: float = math.log(1.005)) -> "AmountBuckets":
        rel = float(cfg.amount_rel_tolerance)
        abs_tol = float(cfg.amount_abs_tolerance)
        w = max(math.log(1.0 / (1.0 - rel)) if rel > 0 else 0.0, min_width)
        floor = max(0.01 * (1.0 + rel), abs_tol / math.expm1(w) if abs_tol > 0 else 0.0, 0.01)
        # slack against rounding in ln(): bounds hold with a strict margin
        return cls(width=w * (1.0 + 1e-6), floor=floor * (1.0 + 1e-6))

    def bucket(self, amount: Column) -> Column:
        x = F.log(F.greatest(F.abs(amount.cast("double")), F.lit(self.floor)))
        return F.floor(x / F.lit(self.width)).cast("long")


# ---------------------------------------------------------------------------
# Row builders
# ---------------------------------------------------------------------------

# Where each fact column comes from on either side; a column that neither side
# of a row gives is empty (amounts zero, the rest a typed NULL).
FROM_PARTNER = {"business_date": "business_date", "operator_code": "operator_code", "partner_txn_id": "partner_txn_id",
                "msisdn_or_account": "msisdn_or_account", "txn_type": "txn_type", "partner_amount": "amount",
                "currency": "currency", "partner_txn_ts_utc": "txn_ts_utc", "file_arrival_date": "file_arrival_date"}
FROM_PLATFORM = {"business_date": "business_date", "operator_code": "operator_code", "partner_txn_id": "partner_txn_id",
                 "platform_event_id": "platform_event_id", "user_id": "user_id", "txn_type": "event_type",
                 "internal_amount": "amount", "platform_event_ts_utc": "event_ts_utc"}
EMPTY_TYPES = {"partner_txn_ts_utc": "timestamp", "platform_event_ts_utc": "timestamp", "file_arrival_date": "date"}


def fact_rows(df: DataFrame, labels: dict[str, Column], partner: str | None = None,
              platform: str | None = None) -> DataFrame:
    """Rows of the fact contract from one or two sides.

    ``partner`` and ``platform`` name where a side's fields are (a struct
    column or an alias; "" for the frame's own columns; None when the row has
    no such side). The partner side wins a column that both give; a platform
    struct may be NULL on some rows.
    """
    def side(at: str, name: str) -> Column:
        return F.col(f"{at}.{name}" if at else name)

    def column(c: str) -> Column:
        empty = zero_amount() if c.endswith("_amount") else F.lit(None).cast(EMPTY_TYPES.get(c, "string"))
        if c in labels:
            return labels[c]
        if partner is not None and c in FROM_PARTNER:
            return side(partner, FROM_PARTNER[c])
        if platform is not None and c in FROM_PLATFORM:
            return F.coalesce(side(platform, FROM_PLATFORM[c]), empty) if platform == "w" else side(platform, FROM_PLATFORM[c])
        return empty

    return df.select(*[column(c).alias(c) for c in PAIR_COLUMNS])


def _labels(status, confidence, key) -> dict[str, Column]:
    named = {"recon_status": status, "match_confidence": confidence, "match_key": key}
    return {k: F.lit(v) if isinstance(v, str) else v for k, v in named.items()}


def partner_only_rows(df: DataFrame) -> DataFrame:
    """Unmatched partner rows -> MISSING_ON_PLATFORM."""
    return fact_rows(df, _labels("MISSING_ON_PLATFORM", "none", MATCH_KEY_UNMATCHED_PARTNER), partner="")


def platform_only_rows(df: DataFrame) -> DataFrame:
    """Unmatched platform rows -> MISSING_AT_PARTNER; expected declines
    (``recursion_failure``) are not breaks and are dropped (as is a NULL type)."""
    return fact_rows(df.where(F.col("event_type") != "recursion_failure"),
                     _labels("MISSING_AT_PARTNER", "none", MATCH_KEY_UNMATCHED_PLATFORM), platform="")


# ---------------------------------------------------------------------------
# The matcher
# ---------------------------------------------------------------------------

class Match:
    """Lazily built pieces of one reconciliation run.

    Tier 1 is computed once as one table ``T`` with a nullable struct per
    side: pairs have both, remainders have one. Every later piece (the
    remainders, the fallback amounts, the survivors) reads ``T``; with
    ``persist=True`` it is cached (memory, spilling to disk; recomputed from
    lineage if an executor is lost), so both inputs are scanned and shuffled
    once. Without it, every branch would re-read and re-shuffle both inputs,
    each with differently pruned columns, so no exchange could be reused.
    """

    def __init__(self, partner: DataFrame, platform: DataFrame,
                 cfg: ReconConfig = DEFAULT_RECON, dates=None, persist: bool | None = None,
                 slim: bool = False):
        self.cfg = cfg
        self.partner = partner_money(partner, dates)
        self.platform = filter_dates(platform, dates)
        if slim:
            self.partner = self.partner.select(*PARTNER_FACT_INPUT)
            self.platform = self.platform.select(*PLATFORM_FACT_INPUT)
        self.persist = cfg.cache_tier1 if persist is None else persist
        self._cached: list[DataFrame] = []

    def release_with(self, df: DataFrame) -> DataFrame:
        """``df`` as a frame of its own; the cached intermediates are dropped
        once nobody holds it (this object's own pieces do not count)."""
        df = df.select("*")
        weakref.finalize(df, self.release)
        return df

    def release(self) -> None:
        """Drop cached intermediates (call after the result is written)."""
        for df in self._cached:
            df.unpersist()
        self._cached.clear()

    def _kept(self, df: DataFrame) -> DataFrame:
        """``df``, cached when the run persists. A cached union keeps some hundred partitions, and each
        task that reads one for a shuffle writes a file per reducer, so readers take several at a time."""
        if not self.persist:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._cached.append(df)
        return df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, 32))

    # ---- tier 1 ---------------------------------------------------------
    @cached_property
    def tier1(self) -> DataFrame:
        """``(p, i)`` rows: strong pairs, partner-only and platform-only rows."""
        pc, ic = self.partner.columns, self.platform.columns
        p = self.partner.select(*[F.col(k) for k in STRONG_KEY], F.struct(*pc).alias("p"))
        i = self.platform.select(*[F.col(k) for k in STRONG_KEY], F.struct(*ic).alias("i"))
        return self._tier1_of(p, i, p, i)

    def _tier1_of(self, p: DataFrame, i: DataFrame, p_unkeyed: DataFrame, i_unkeyed: DataFrame) -> DataFrame:
        """Tier 1 of rows with a complete key in ``p`` and ``i`` and of rows without one in the
        other two; each frame may hold further rows, which count for nothing."""
        # a row with any NULL key part can never match; stating the not-null
        # filter in full keeps the partner input of both joins below one plan
        # (no inferred filters on one side only), so its exchange is reused
        keyed = F.col(STRONG_KEY[0]).isNotNull()
        for k in STRONG_KEY[1:]:
            keyed = keyed & F.col(k).isNotNull()
        pk, ik = p.where(keyed), i.where(keyed)
        no_i = F.lit(None).cast(i.schema["i"].dataType).alias("i")
        no_p = F.lit(None).cast(p.schema["p"].dataType).alias("p")
        # The rows of a full outer join, in a form adaptive execution can
        # split: a full outer join is never skew-split, so one platform id
        # holding a large share of rows (a sentinel id, a replayed id) would
        # sit in one task. Platform rows are the left side of a left outer
        # join (a skewed left partition is split); partner-only rows come
        # from an anti join against the distinct platform keys (partial
        # aggregation collapses a hot key to one row before the shuffle).
        keys = list(STRONG_KEY)
        i_side = ik.alias("b").join(pk.alias("a"), keys, "left").select("p", "i")
        p_only = pk.join(ik.select(*keys).distinct(), keys, "left_anti").select("p", no_i)
        joined = i_side.unionByName(p_only)
        # a NULL key part never matches: those rows are remainders by construction
        p_null = p_unkeyed.where(~keyed).select("p", no_i)
        i_null = i_unkeyed.where(~keyed).select(no_p, "i")
        t = joined.unionByName(p_null).unionByName(i_null)
        return self._kept(t)

    @cached_property
    def strong(self) -> DataFrame:
        """Tier 1 pairs: tolerance true -> MATCHED, else (incl. NULL) AMOUNT_MISMATCH."""
        both = self.tier1.where(F.col("p").isNotNull() & F.col("i").isNotNull())
        ok = amounts_match(F.col("p.amount"), F.col("i.amount"), self.cfg)
        status = F.when(ok, F.lit("MATCHED")).otherwise(F.lit("AMOUNT_MISMATCH"))
        return fact_rows(both, _labels(status, "strong", MATCH_KEY_STRONG), partner="p", platform="i")

    @cached_property
    def partner_left(self) -> DataFrame:
        """Partner rows without a strong partner (a NULL id never matches)."""
        return self.tier1.where(F.col("i").isNull()).select("p.*")

    @cached_property
    def platform_left(self) -> DataFrame:
        """Platform rows without a strong partner, NULL-key rows included."""
        return self.tier1.where(F.col("p").isNull()).select("i.*")

    # ---- tier 2 ---------------------------------------------------------
    @cached_property
    def _platform_amounts(self) -> DataFrame:
        """NULL-key platform candidates reduced to one row per
        (operator, type, date, amount): the smallest event id wins ties."""
        w = self.cfg.fallback_window_days
        i = (self.platform_left
             .where(F.col("partner_txn_id").isNull() & F.col("amount").isNotNull()
                    & F.col("event_type").isin(*MONEY_TYPES))
             .select(
                 "operator_code",
                 F.col("event_type").alias("txn_type"),
                 "business_date",
                 "amount",
                 F.struct(
                     F.col("platform_event_id"),
                     F.col("user_id"),
                     F.col("event_ts_utc"),
                     F.col("business_date").alias("i_business_date"),
                 ).alias("ev"),
             ))
        if w > 0:
            # a platform row is a candidate for partner dates within +-w days
            i = i.withColumn("business_date", F.explode(F.sequence(
                F.date_sub("business_date", w), F.date_add("business_date", w))))
        return i.groupBy(*AMOUNT_KEY, "amount").agg(F.min("ev").alias("ev"))

    @cached_property
    def winners(self) -> DataFrame:
        """Best platform row per distinct partner (operator, type, date, amount):
        smallest amount distance, then smallest platform_event_id.

        The best candidate is the nearest platform amount at or below the
        partner amount or the nearest at or above it (a farther amount is
        never closer, and the tolerance only shrinks with distance). Distinct
        amounts of both sides are unioned per (operator, type, date, bucket)
        (platform amounts also placed in the neighbouring buckets, so every
        amount within tolerance is present) and one ordered pass finds the
        predecessor and successor of each partner amount: no pairs are formed.
        """
        bk = AmountBuckets.for_config(self.cfg)
        pk = (self.partner_left.where(F.col("amount").isNotNull())
              .select(*AMOUNT_KEY, F.col("amount").alias("amt")).distinct()
              .withColumn("bucket", bk.bucket(F.col("amt"))))
        ia = self._platform_amounts
        ev_type = ia.schema["ev"].dataType
        ik = (ia.withColumn("b0", bk.bucket(F.col("amount")))
              .select(*AMOUNT_KEY, F.col("amount").alias("amt"), "ev",
                      F.explode(F.array(F.col("b0") - 1, F.col("b0"), F.col("b0") + 1)).alias("bucket")))
        u = (pk.select(*AMOUNT_KEY, "bucket", "amt", F.lit(1).alias("side"), F.lit(None).cast(ev_type).alias("ev"))
             .unionByName(ik.select(*AMOUNT_KEY, "bucket", "amt", F.lit(0).alias("side"), "ev")))
        cand = F.when(F.col("side") == 0, F.struct(F.col("amt").alias("amount"), F.col("ev").alias("ev")))
        part = Window.partitionBy(*AMOUNT_KEY, "bucket")
        # both directions look backwards in their own order: a frame that starts
        # at the partition's head runs on, one that ends at its tail is evaluated
        # anew for every row. At equal amounts the platform row comes first in
        # either order, so an equal amount is both predecessor and successor
        head = (Window.unboundedPreceding, Window.currentRow)
        below = part.orderBy("amt", "side").rowsBetween(*head)
        above = part.orderBy(F.col("amt").desc(), "side").rowsBetween(*head)
        u = (u.withColumn("_lo", F.last(cand, ignorenulls=True).over(below))
              .withColumn("_hi", F.last(cand, ignorenulls=True).over(above))
              .where(F.col("side") == 1))

        def option(c: Column) -> Column:
            ok = c.isNotNull() & F.coalesce(amounts_match(F.col("amt"), c["amount"], self.cfg), F.lit(False))
            return F.when(ok, F.struct(
                F.abs(F.col("amt") - c["amount"]).alias("dist"),
                c["ev"]["platform_event_id"].alias("platform_event_id"),
                c["amount"].alias("amount"),
                c["ev"]["user_id"].alias("user_id"),
                c["ev"]["event_ts_utc"].alias("event_ts_utc"),
                c["ev"]["i_business_date"].alias("i_business_date"),
            ))

        best = F.least(option(F.col("_lo")), option(F.col("_hi")))
        return (u.select(*AMOUNT_KEY, F.col("amt").alias("p_amount"), best.alias("w"))
                .where(F.col("w").isNotNull()))

    @cached_property
    def _partner_side(self) -> DataFrame:
        """Every partner remainder row with its winner (NULL when none), from
        one left join: the right side has one row per key."""
        p = self.partner_left.alias("p")
        w = self.winners.alias("x")
        cond = [F.col(f"p.{k}") == F.col(f"x.{k}") for k in AMOUNT_KEY]
        cond.append(F.col("p.amount") == F.col("x.p_amount"))
        return p.join(w, cond, "left").select("p.*", F.col("x.w").alias("w"))

    @cached_property
    def fallback(self) -> DataFrame:
        """Tier 2 pairs (always MATCHED: the tolerance is part of the join)."""
        return _partner_side_rows(self._partner_side.where(F.col("w").isNotNull()))

    @cached_property
    def used_platform(self) -> DataFrame:
        """Platform rows consumed by a fallback pair."""
        return self.winners.select(
            "operator_code",
            F.col("w.i_business_date").alias("business_date"),
            F.col("w.platform_event_id").alias("platform_event_id"),
        )

    # ---- tier 3 ---------------------------------------------------------
    @cached_property
    def missing_on_platform(self) -> DataFrame:
        return partner_only_rows(self._partner_side.where(F.col("w").isNull()).drop("w"))

    @cached_property
    def missing_at_partner(self) -> DataFrame:
        left = self.platform_left.join(
            self.used_platform, ["operator_code", "business_date", "platform_event_id"], "left_anti")
        return platform_only_rows(left)

    @cached_property
    def partner_classified(self) -> DataFrame:
        """Fallback pairs and MISSING_ON_PLATFORM rows in one projection."""
        return _partner_side_rows(self._partner_side)

    @cached_property
    def classified(self) -> DataFrame:
        """All four row sets, before the churn and late overlays."""
        return (self.strong.select(*PAIR_COLUMNS)
                .unionByName(self.partner_classified.select(*PAIR_COLUMNS))
                .unionByName(self.missing_at_partner.select(*PAIR_COLUMNS)))


def _partner_side_rows(df: DataFrame) -> DataFrame:
    """A winner makes a fallback pair (always MATCHED: the tolerance is part
    of the choice); no winner makes MISSING_ON_PLATFORM."""
    hit = F.col("w").isNotNull()

    def pick(a: str, b: str) -> Column:
        return F.when(hit, F.lit(a)).otherwise(F.lit(b))

    return fact_rows(df, _labels(pick("MATCHED", "MISSING_ON_PLATFORM"), pick("fallback", "none"),
                                 pick(MATCH_KEY_FALLBACK, MATCH_KEY_UNMATCHED_PARTNER)), partner="", platform="w")


class ColocatedMatch(Match):
    """A ``Match`` over streams kept by ``sinks.colocated``: each side is given as
    ``(keyed, unkeyed)`` frames, and the keyed ones, bucketed alike, join
    without an exchange."""

    def __init__(self, partner: tuple[DataFrame, DataFrame], platform: tuple[DataFrame, DataFrame],
                 cfg: ReconConfig = DEFAULT_RECON, dates=None, persist: bool | None = None, slim: bool = False):
        super().__init__(partner[0], platform[0], cfg, dates, persist, slim)
        self._unkeyed = Match(partner[1], platform[1], cfg, dates, False, slim)

    @cached_property
    def tier1(self) -> DataFrame:
        def side(df: DataFrame, name: str) -> DataFrame:
            return df.select(*[F.col(k) for k in STRONG_KEY], F.struct(*df.columns).alias(name))
        rest = self._unkeyed
        return self._tier1_of(side(self.partner, "p"), side(self.platform, "i"),
                              side(rest.partner, "p"), side(rest.platform, "i"))
