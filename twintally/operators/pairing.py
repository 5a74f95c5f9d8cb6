"""``pairing="one_to_one"``: each fallback platform row is used at most once.

The default best-per-partner rule lets one platform row serve many partner
rows. One-to-one pairing is built in two phases, both without comparing
partner rows against platform rows one by one:

1. Exact amounts. Within an ``(operator, type, date, amount)`` group the
   candidates are interchangeable, so the k-th partner row (by id) pairs with
   the k-th platform row (by id): an equi-join on ``(group, rank)``.
   Ranks come from ``rank_within``: a group larger than ``chunk_rows`` is
   split by a hash of its order key into chunks, each chunk is ranked on its
   own, and chunk offsets (from a per-group count table) make the ranks
   global. No group, however hot, is sorted in one task.
2. Tolerance remainder. After phase 1 an amount has leftovers on one side
   only. Per ``(operator, type, date)`` the distinct amounts with leftover
   counts are allocated greedily by smallest amount distance (ties: smaller
   partner amount, then smaller platform amount) with a small pandas helper
   over distinct amounts, never rows. Allocations are rank ranges, which are
   joined back to the rows.

The fallback window must be 0 in this mode.
"""

from __future__ import annotations

import heapq
import sys
from decimal import Decimal
from functools import cached_property
from itertools import groupby

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DEFAULT_RECON, MONEY_TYPES, ReconConfig
from ..functions.money import dec_lit
from .matching import AMOUNT_KEY, AmountBuckets, Match

CHUNK_ROWS = 1_000_000


def rank_within(df: DataFrame, group_cols, order_cols, chunk_rows: int = CHUNK_ROWS,
                name: str = "_rank") -> DataFrame:
    """1-based rank of each row within its group by ``order_cols``.

    Groups up to ``chunk_rows`` rows are ranked in plain ``order_cols`` order;
    bigger groups in (hash chunk, ``order_cols``) order, which is still a
    deterministic total order, computed chunk by chunk.
    """
    g = list(group_cols)
    names = list(order_cols)
    sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n")).select(
        *g, F.ceil(F.col("_n") / F.lit(chunk_rows)).cast("int").alias("_chunks"))
    d = df.join(sizes, g, "inner")
    d = d.withColumn("_chunk", F.when(F.col("_chunks") > 1,
                                      F.pmod(F.xxhash64(*names), F.col("_chunks"))).otherwise(F.lit(0)))
    counts = d.groupBy(*g, "_chunk").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*g).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*g, "_chunk", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    local = Window.partitionBy(*g, "_chunk").orderBy(*[F.col(c).asc_nulls_first() for c in names])
    d = d.withColumn("_rn", F.row_number().over(local))
    return (d.join(offsets, [*g, "_chunk"], "inner")
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_chunks", "_chunk", "_rn", "_off"))


def _within_tolerance(p: Decimal, i: Decimal, abs_tol: Decimal, rel_tol: Decimal) -> bool:
    d = abs(p - i)
    return d <= abs_tol or d <= rel_tol * max(abs(p), Decimal("0.01"))


def greedy_allocate(amounts: list[tuple[Decimal, int, int]], cfg: ReconConfig | None = None,
                    abs_tol: Decimal | None = None, rel_tol: Decimal | None = None) -> list[tuple]:
    """Greedy pairing of leftover counts on a line of distinct amounts.

    ``amounts``: (amount, partner_left, platform_left), one side zero.
    Returns (partner_amount, platform_amount, n, partner_skip, platform_skip):
    n pairs, taking leftover ranks after the first ``*_skip`` of that amount.
    The closest valid opposite pair is always adjacent among remaining
    amounts, so a heap of adjacent pairs gives the smallest-distance-first
    order in O(k log k).
    """
    if cfg is not None:
        abs_tol, rel_tol = cfg.amount_abs_tolerance, cfg.amount_rel_tolerance
    items = sorted((a, lp, li) for a, lp, li in amounts if lp > 0 or li > 0)
    k = len(items)
    side = [0 if lp > 0 else 1 for _, lp, _ in items]
    left = [lp if s == 0 else li for (_, lp, li), s in zip(items, side)]
    used = [0] * k
    prev = list(range(-1, k - 1))
    nxt = list(range(1, k + 1))
    alive = [True] * k
    heap = []

    def push(a, b):
        if 0 <= a < k and 0 <= b < k and side[a] != side[b]:
            p, i = (a, b) if side[a] == 0 else (b, a)
            pa, ia = items[p][0], items[i][0]
            if _within_tolerance(pa, ia, abs_tol, rel_tol):
                heapq.heappush(heap, (abs(pa - ia), pa, ia, a, b))

    for j in range(k - 1):
        push(j, j + 1)
    out = []
    while heap:
        _, pa, ia, a, b = heapq.heappop(heap)
        if not (alive[a] and alive[b]) or nxt[a] != b:
            continue
        n = min(left[a], left[b])
        p, i = (a, b) if side[a] == 0 else (b, a)
        out.append((pa, ia, n, used[p], used[i]))
        for x in (a, b):
            left[x] -= n
            used[x] += n
        for x in (a, b):
            if left[x] == 0 and alive[x]:
                alive[x] = False
                lo, hi = prev[x], nxt[x]
                if lo >= 0:
                    nxt[lo] = hi
                if hi < k:
                    prev[hi] = lo
        lo = prev[a] if not alive[a] else a
        hi = nxt[b] if not alive[b] else b
        if not alive[a] and not alive[b]:
            lo, hi = prev[a], nxt[b]
            while lo >= 0 and not alive[lo]:
                lo = prev[lo]
            while hi < k and not alive[hi]:
                hi = nxt[hi]
        push(lo, hi)
    return out


def tolerance_chains(amounts: DataFrame, keys, cfg: ReconConfig = DEFAULT_RECON, name: str = "chain") -> DataFrame:
    """Number each distinct ``amount`` of a key with the first amount of its chain.

    Adjacent amounts ``a < b`` are in one chain unless ``b - a`` exceeds both the
    absolute tolerance and the relative one of the larger magnitude. For any
    ``x <= a`` and ``y >= b`` within tolerance of each other, ``b - a`` is within
    it too (the relative rate is below 1), so no valid pair leaves its chain.

    A key's amounts are never sorted in one task: they are cut into consecutive
    segments as wide as one amount bucket, linked inside each segment, and the
    segments (a few thousand a key at most, by the range of the amount type) are
    stitched through their first and last amounts. Rows with a NULL key or amount
    have no chain and are left out; ``amount`` must be unique within a key.
    """
    keys = list(keys)
    bk = AmountBuckets.for_config(cfg)
    step = bk.bucket(F.col("amount")) - bk.bucket(F.lit(0))
    d = amounts.where(F.col("amount").isNotNull()).withColumn(
        "_seg", F.when(F.col("amount") < 0, -1 - step).otherwise(step))
    within = Window.partitionBy(*keys, "_seg").orderBy("amount")
    across = Window.partitionBy(*keys).orderBy("_seg")
    ends = (d.groupBy(*keys, "_seg").agg(F.max("amount").alias("_hi"))
            .select(*keys, "_seg", F.lag("_hi").over(across).alias("_below")))
    d = (d.withColumn("_prev", F.lag("amount").over(within)).join(ends, [*keys, "_seg"], "inner")
         .withColumn("_prev", F.coalesce("_prev", "_below")))
    larger = F.greatest(F.abs("_prev"), F.abs("amount"), F.lit(Decimal("0.01")))
    gap = F.col("amount") - F.col("_prev")
    linked = (gap <= dec_lit(cfg.amount_abs_tolerance)) | (gap <= dec_lit(cfg.amount_rel_tolerance) * larger)
    d = d.withColumn("_start", F.when(~F.coalesce(linked, F.lit(False)), F.col("amount")))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = (d.groupBy(*keys, "_seg").agg(F.max("_start").alias("_s"))
               .select(*keys, "_seg", F.last("_s", ignorenulls=True).over(before).alias("_carried")))
    so_far = F.last("_start", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (d.withColumn("_start", so_far).join(carried, [*keys, "_seg"], "inner")
            .withColumn(name, F.coalesce("_start", "_carried"))
            .drop("_seg", "_prev", "_below", "_start", "_carried"))


ALLOC_SCHEMA = ("operator_code string, txn_type string, business_date date, p_amount decimal(12,2), "
                "i_amount decimal(12,2), n long, p_skip long, i_skip long")


class OneToOneMatch(Match):
    """A ``Match`` whose fallback tier pairs each platform row at most once."""

    chunk_rows = CHUNK_ROWS

    def __init__(self, partner: DataFrame, platform: DataFrame,
                 cfg: ReconConfig = DEFAULT_RECON, dates=None, persist: bool | None = None,
                 slim: bool = False):
        if cfg.fallback_window_days != 0:
            raise ValueError("one_to_one pairing needs fallback_window_days=0")
        super().__init__(partner, platform, cfg, dates, persist, slim)

    P_ORDER = ("partner_txn_id", "msisdn_or_account", "txn_ts_utc", "file_arrival_date", "plan_code", "currency")
    I_ORDER = ("platform_event_id", "user_id", "event_ts_utc", "sub_id")

    @cached_property
    def _p_in(self) -> DataFrame:
        return self.partner_left.where(F.col("amount").isNotNull())

    @cached_property
    def _i_in(self) -> DataFrame:
        return (self.platform_left
                .where(F.col("partner_txn_id").isNull() & F.col("amount").isNotNull()
                       & F.col("event_type").isin(*MONEY_TYPES))
                .withColumn("txn_type", F.col("event_type")))

    @cached_property
    def _p_ranked(self) -> DataFrame:
        order = [c for c in self.P_ORDER if c in self._p_in.columns]
        return self._kept(rank_within(self._p_in, [*AMOUNT_KEY, "amount"], order, self.chunk_rows, "_rank"))     # read three times

    @cached_property
    def _i_ranked(self) -> DataFrame:
        order = [c for c in self.I_ORDER if c in self._i_in.columns]
        return self._kept(rank_within(self._i_in, [*AMOUNT_KEY, "amount"], order, self.chunk_rows, "_rank"))     # read twice

    @cached_property
    def _counts(self) -> DataFrame:
        pc = self._p_in.groupBy(*AMOUNT_KEY, "amount").agg(F.count(F.lit(1)).alias("np"))
        ic = self._i_in.groupBy(*AMOUNT_KEY, "amount").agg(F.count(F.lit(1)).alias("ni"))
        return (pc.join(ic, [*AMOUNT_KEY, "amount"], "full_outer")
                .select(*AMOUNT_KEY, "amount", F.coalesce("np", F.lit(0)).alias("np"),
                        F.coalesce("ni", F.lit(0)).alias("ni")))

    @cached_property
    def allocations(self) -> DataFrame:
        """Phase-2 rank ranges per (operator, type, date), chain by chain, from distinct amounts."""
        # Only plain values reach the executors: the helper and this module are
        # pickled by value, so workers need no copy of the package.
        abs_tol, rel_tol = Decimal(self.cfg.amount_abs_tolerance), Decimal(self.cfg.amount_rel_tolerance)
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
        left = self._counts.select(
            *AMOUNT_KEY, "amount",
            F.greatest(F.col("np") - F.col("ni"), F.lit(0)).alias("lp"),
            F.greatest(F.col("ni") - F.col("np"), F.lit(0)).alias("li"),
            F.least(F.col("np"), F.col("ni")).alias("zipped"),
        ).where((F.col("lp") > 0) | (F.col("li") > 0))

        def of_chain(key, amounts) -> list[tuple]:
            if not (any(lp for _, lp, _, _ in amounts) and any(li for _, _, li, _ in amounts)):
                return []
            zipped = {a: int(z) for a, _, _, z in amounts}
            found = greedy_allocate([(a, int(lp), int(li)) for a, lp, li, _ in amounts], None, abs_tol, rel_tol)
            return [(*key[:3], pa, ia, n, zipped[pa] + ps, zipped[ia] + is_) for pa, ia, n, ps, is_ in found]

        def alloc(batches):
            names = [c.split()[0] for c in ALLOC_SCHEMA.split(", ")]
            now, amounts = None, []
            for pdf in batches:
                out = []
                for key, rows in groupby(pdf.itertuples(index=False, name=None), key=lambda r: r[:4]):
                    if key != now:
                        out += of_chain(now, amounts)
                        now, amounts = key, []
                    amounts += [r[4:] for r in rows]
                yield pd.DataFrame(out, columns=names)
            yield pd.DataFrame(of_chain(now, amounts), columns=names)

        chains = tolerance_chains(left, AMOUNT_KEY, self.cfg).select(*AMOUNT_KEY, "chain", "amount", "lp", "li", "zipped")
        return (chains.repartition(*AMOUNT_KEY, "chain").sortWithinPartitions(*AMOUNT_KEY, "chain", "amount")
                .mapInPandas(alloc, ALLOC_SCHEMA))

    @cached_property
    def _paired_ranks(self) -> DataFrame:
        """(group, partner rank, platform struct) for both phases."""
        ev = F.struct("platform_event_id", "user_id", "amount", "event_ts_utc",
                      F.col("business_date").alias("i_business_date")).alias("w")
        ir = self._i_ranked.select(*AMOUNT_KEY, F.col("amount").alias("i_amount"), "_rank", ev)
        pk = self._p_ranked.select(*AMOUNT_KEY, "amount", "_rank")
        # phase 1: same amount, same rank
        zipped = pk.join(ir.withColumnRenamed("i_amount", "amount"), [*AMOUNT_KEY, "amount", "_rank"], "inner")
        # phase 2: a partner rank inside an allocated range takes the platform
        # rank at the same offset in the allocated platform amount
        a = self.allocations.alias("a")
        pr = pk.alias("p").join(
            a, [F.col(f"p.{k}") == F.col(f"a.{k}") for k in AMOUNT_KEY]
            + [F.col("p.amount") == F.col("a.p_amount"),
               F.col("p._rank") > F.col("a.p_skip"), F.col("p._rank") <= F.col("a.p_skip") + F.col("a.n")],
            "inner").select(*[F.col(f"p.{k}").alias(k) for k in AMOUNT_KEY], F.col("p.amount").alias("amount"),
                            F.col("p._rank").alias("_rank"), F.col("a.i_amount").alias("_ia"),
                            (F.col("a.i_skip") + F.col("p._rank") - F.col("a.p_skip")).alias("_irank"))
        tol = pr.join(ir.withColumnRenamed("_rank", "_irank").withColumnRenamed("i_amount", "_ia"),
                      [*AMOUNT_KEY, "_ia", "_irank"], "inner").drop("_ia", "_irank")
        return zipped.unionByName(tol)

    @cached_property
    def _partner_side(self) -> DataFrame:
        """Every partner remainder row with its platform struct or NULL; rows
        are identified by (group, rank), so identical rows stay distinct."""
        paired = self._paired_ranks
        ranked = self._p_ranked.join(paired, [*AMOUNT_KEY, "amount", "_rank"], "left").drop("_rank")
        no_amount = (self.partner_left.where(F.col("amount").isNull())
                     .withColumn("w", F.lit(None).cast(paired.schema["w"].dataType)))
        return ranked.unionByName(no_amount)

    @cached_property
    def used_platform(self) -> DataFrame:
        return self._paired_ranks.select("operator_code", F.col("w.i_business_date").alias("business_date"),
                                         F.col("w.platform_event_id").alias("platform_event_id"))
