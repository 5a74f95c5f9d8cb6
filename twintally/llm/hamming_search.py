"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of ``bits`` bits is cut into m segments, and every segment has a table
from its value to the codes that hold it. Two codes at distance below m * (r + 1)
agree up to r bits in some segment. A query therefore probes all segment
values at radius 0, 1, 2, ..., verifies the full distance of what it finds, and
stops once its k-th best distance is below m * (r + 1): nothing nearer can
be missing.

Equal codes are one entry with their smallest ids. Entries lie in blocks, each
with segment tables of its own; query blocks meet index blocks, and a query
keeps its k best of each block, so pairs are never rows.

Defined cases: NULL embeddings, NULL ids and embeddings of another length than
``bits`` have no code, are not found and find nothing; a NULL or NaN component counts as 0
(bit off); ties go to the smaller id; a row is not its own neighbour, but
another row with the same id's code is; repeated ids are found once; fewer
than k others give fewer rows; an empty table gives no rows; only the id and
embedding columns are read.
"""

from __future__ import annotations

from itertools import combinations
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twintally.llm.common import even_partitions, staged

BITS = 64
K = 10
#: distinct codes of an index block, and queries of a query block, at most
INDEX_BLOCK = 1 << 17
QUERY_BLOCK = 1 << 15
#: queries that are worth a block of their own while tasks are idle
LEAST_QUERIES = 128


def sign_code(embedding: Column, bits: int = BITS) -> Column:
    """The signs of an embedding as one long: bit i is on when component i is above 0 (``bits`` up to 64)."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    on = F.transform(embedding, lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", one, i)).otherwise(none))
    return F.when(F.size(embedding) == bits, F.aggregate(on, none, lambda a, x: a.bitwiseOR(x)))


class SegmentTables:
    """Segment tables of one block of codes."""

    def __init__(self, codes: np.ndarray, bits: int = BITS):
        self.codes, self.bits = codes, bits
        self.m = max(1, min(bits, round(bits / max(log2(max(len(codes), 2)), 4))))
        edges = [round(i * bits / self.m) for i in range(self.m + 1)]
        self.parts = [(edges[i], edges[i + 1] - edges[i]) for i in range(self.m)]
        self.tables = []
        for i in range(self.m):
            value = self.segment(codes, i)
            order = np.argsort(value, kind="stable")
            at = np.searchsorted(value[order], np.arange((1 << self.parts[i][1]) + 1))
            self.tables.append((order, at))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def segment(self, codes: np.ndarray, i: int) -> np.ndarray:
        low, width = self.parts[i]
        return ((codes >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def flips(self, width: int, r: int) -> np.ndarray:
        """All masks of ``width`` bits with r bits on."""
        if (width, r) not in self.masks:
            self.masks[width, r] = np.array([sum(1 << b for b in c) for c in combinations(range(width), r)], np.int64)
        return self.masks[width, r]

    def search(self, query: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(entries, distances): every entry as near as the k-th nearest one, or all when there are fewer."""
        seen = np.zeros(len(self.codes), bool)
        at_distance = np.zeros(self.bits + 1, np.int64)
        found, far = [], []
        for r in range(max(w for _, w in self.parts) + 1):
            for i, (order, at) in enumerate(self.tables):
                if r > self.parts[i][1]:
                    continue
                probe = int(self.segment(np.array([query]), i)[0]) ^ self.flips(self.parts[i][1], r)
                begin, size = at[probe], at[probe + 1] - at[probe]
                some = size > 0
                begin, size = begin[some], size[some]
                run = np.cumsum(size)
                if not len(run):
                    continue
                new = order[np.repeat(begin - run + size, size) + np.arange(run[-1])]
                new = new[~seen[new]]
                seen[new] = True
                d = np.bitwise_count(self.codes[new] ^ query).astype(np.int64)
                found.append(new)
                far.append(d)
                at_distance += np.bincount(d, minlength=self.bits + 1)
            kth = int(np.searchsorted(np.cumsum(at_distance), k))      # distance of the k-th best so far
            if kth < self.m * (r + 1):
                break
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        entry, d = np.concatenate(found), np.concatenate(far)
        near = d <= kth
        return entry[near], d[near]


def _block_search(k: int, bits: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"qcode": [], "distance": [], "id": []}
        if len(index) and len(queries):
            tables = SegmentTables(index["code"].to_numpy(np.int64).view(np.uint64), bits)
            ids = index["ids"].tolist()
            for q in queries["qcode"].tolist():
                entry, d = tables.search(np.uint64(q % (1 << 64)), k)
                best = sorted((int(x), int(i)) for e, x in zip(entry.tolist(), d.tolist()) for i in ids[e])[:k]
                out["qcode"].append(q)
                out["distance"].append([x for x, _ in best])
                out["id"].append([i for _, i in best])
        return pd.DataFrame(out)
    return run


def hamming_topk(codes: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """(query_id, rank, neighbour_id, distance) of the k nearest other ids, exact.

    ``codes`` and ``queries`` have (id long, code long).
    """
    keep = k + 1            # the query itself may be among them
    entries = staged(_entries(codes, keep), "mih-entries")
    asked = staged(queries.where("code is not null and id is not null").select("id", F.col("code").alias("qcode")).distinct(),
                   "mih-queries")
    wanted = asked.select("qcode").distinct()
    n_entries, n_wanted = entries.count(), wanted.count()
    spark = codes.sparkSession
    index_blocks = max(1, -(-n_entries // INDEX_BLOCK))
    query_blocks = max(1, -(-n_wanted // QUERY_BLOCK), min(even_partitions(spark), n_wanted // LEAST_QUERIES))
    left = (entries.withColumn("ib", F.pmod(F.xxhash64("code"), F.lit(index_blocks)))
            .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))))
    right = (wanted.withColumn("qb", F.pmod(F.xxhash64("qcode"), F.lit(query_blocks)))
             .withColumn("ib", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(index_blocks - 1).cast("long")))))
    per_block = left.groupBy("qb", "ib").cogroup(right.groupBy("qb", "ib")).applyInPandas(
        _block_search(keep, bits), "qcode long, distance array<int>, id array<long>")
    best = (per_block.select("qcode", F.arrays_zip("distance", "id").alias("n"))
            .groupBy("qcode").agg(F.slice(F.array_sort(F.flatten(F.collect_list("n"))), 1, keep).alias("n")))
    return (asked.join(best, "qcode")
            .select("id", F.posexplode(F.slice(F.filter("n", lambda x: x["id"] != F.col("id")), 1, k)).alias("r", "x"))
            .select(F.col("id").alias("query_id"), (F.col("r") + 1).alias("rank"), F.col("x.id").alias("neighbour_id"),
                    F.col("x.distance").alias("distance")))


def _entries(codes: DataFrame, keep: int) -> DataFrame:
    """Distinct codes with their ``keep`` smallest ids; a code of very many ids is cut down in two steps."""
    ids = codes.where("code is not null and id is not null").select("code", "id").distinct()
    salted = ids.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = salted.withColumn("r", F.row_number().over(W.partitionBy("code", "salt").orderBy("id"))).where(F.col("r") <= keep)
    return first.groupBy("code").agg(F.slice(F.array_sort(F.collect_list("id")), 1, keep).alias("ids"))
