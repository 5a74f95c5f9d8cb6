"""Token-id shards under a Re-Pair grammar, with random access to any document.

Documents are dealt by range of doc_id into shards in ascending order. Within a
shard the most frequent neighbouring id pairs are replaced by nonterminals,
round after round, until no pair is frequent enough or the symbols run out. A
pair never spans two documents, so each document is a run of symbols of its own
and can be expanded alone.

A shard is one row of a Parquet table (the file format):

    part, seq     place of the shard in the whole order
    end_id        id that ends each document
    doc_ids       documents of the shard, ascending (NULL first)
    n_tokens      expanded length of each document, with its end id
    symbol_at     where each document's symbols begin (one more than documents)
    rules         uint32 pairs: left and right symbol of nonterminal FIRST_RULE + i
    rule_length   uint32 expansion length of each nonterminal
    symbols       uint32 symbols, zstd-compressed by Parquet

Defined cases: NULL and empty texts hold just the end id; NULL ids sort first;
repeated ids stay separate documents, side by side; an empty table gives no
shards; only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twintally.llm.common import even_partitions, staged, text_chunks
from twintally.llm.unit_tokens import ranges, tokenizer_for, with_end

#: ids that a shard holds at least before it is closed (the bound of a task's memory)
SHARD_IDS = 3_000_000
#: text bytes that are encoded at a time
ENCODE_BYTES = 2 << 20
#: units and pieces whose ids a worker remembers (a new one costs far more than a known one)
TABLE_UNITS = 800_000
TABLE_PIECES = 500_000
#: nonterminals are numbered from here; ids of the vocabulary lie below
FIRST_RULE = 1 << 16
MAX_RULES = 1 << 15
#: a pair is replaced when it occurs this often in the shard
MIN_COUNT = 64
ROUNDS = 6
RULES_A_ROUND = 1 << 13
_HASH_BITS = 20

SCHEMA = ("part int, seq int, end_id int, doc_ids array<{kind}>, n_tokens array<long>, symbol_at array<long>, "
          "rules binary, rule_length binary, symbols binary")


def _pair_slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - _HASH_BITS)


def _kinds(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending distinct pairs, the place of each pair among them, counts): only distinct pairs are sorted."""
    which, kinds = pd.factorize(pair)
    order = np.argsort(kinds)
    place = np.empty(len(kinds), np.int64)
    place[order] = np.arange(len(kinds))
    which = place[which]
    return kinds[order], which, np.bincount(which, minlength=len(kinds))


def compress(ids: np.ndarray, doc_at: np.ndarray, rounds: int = ROUNDS, min_count: int = MIN_COUNT,
             max_rules: int = MAX_RULES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, symbol_at, rules, rule_length) of ids whose documents begin at ``doc_at``.

    Each round counts all neighbouring pairs, takes the most frequent ones and
    replaces their occurrences from left to right. Overlaps within a round go to
    the more frequent pair, so a pair's own count may fall short of its promise
    but a replacement never costs symbols.
    """
    sym, at = ids.astype(np.uint32), np.asarray(doc_at, np.int64)
    rules, length = np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    for _ in range(rounds):
        room = min(RULES_A_ROUND, max_rules - len(rules))
        if len(sym) < 2 or room <= 0:
            break
        slots = _pair_slots(sym[:-1], sym[1:])
        edge = at[1:-1] - 1                      # pairs over a document's end
        edge = edge[(edge >= 0) & (edge < len(slots))]
        count = np.bincount(slots, minlength=1 << _HASH_BITS)
        count -= np.bincount(slots[edge], minlength=1 << _HASH_BITS)
        floor = max(min_count, int(np.partition(count, -room)[-room]))
        hot = (count >= floor)[slots]
        hot[edge] = False
        pos = np.flatnonzero(hot)
        pair = sym[pos].astype(np.uint64) << np.uint64(32) | sym[pos + 1]
        kinds, which, n = _kinds(pair)
        best = np.argsort(-n, kind="stable")[:room]      # a slot may hold several pairs: count each exactly
        best = best[n[best] >= min_count]
        if not len(best):
            break
        rank = np.full(len(kinds), len(kinds), np.int64)
        rank[best] = np.arange(len(best))
        r = rank[which]
        pos, r = pos[r < len(kinds)], r[r < len(kinds)]
        keep = _apart(pos, r)
        pos, r = pos[keep], r[keep]
        made = kinds[best]
        left, right = (made >> np.uint64(32)).astype(np.uint32), (made & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        size = lambda s: np.where(s >= FIRST_RULE, np.append(length, 1)[np.minimum(
            np.maximum(s.astype(np.int64) - FIRST_RULE, 0), len(length))], 1).astype(np.uint32)
        first = FIRST_RULE + len(rules)
        rules, length = np.concatenate([rules, np.stack([left, right], 1)]), np.concatenate([length, size(left) + size(right)])
        sym = sym.copy()
        sym[pos] = (first + r).astype(np.uint32)
        stay = np.ones(len(sym), bool)
        stay[pos + 1] = False
        at = at - np.searchsorted(pos + 1, at)
        sym = sym[stay]
        if len(pos) * 100 < len(sym):
            break
    return sym, at, rules, length


def _apart(pos: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Marks occurrences to replace: of two overlapping ones the better rank stays, then the left one.

    An occurrence that is better than both neighbours is taken and drops them;
    repeated until nothing is open. Long runs of one rank (aaaa) are settled by
    parity within the run.
    """
    keep = np.ones(len(pos), bool)                       # those that touch no other stay at once
    near = np.flatnonzero(pos[1:] == pos[:-1] + 1)
    keep[near] = keep[near + 1] = False
    open_ = np.flatnonzero(~keep)
    while len(open_):
        p, r = pos[open_], rank[open_]
        touch = np.zeros(len(p) + 1, bool)               # touches the one before
        touch[1:-1] = p[1:] == p[:-1] + 1
        left = np.append(-1, r[:-1])
        worse_left = touch[:-1] & (left <= r)            # the left one is at least as good
        worse_right = touch[1:] & (np.append(r[1:], -1) < r)
        win = ~worse_left & ~worse_right
        # runs of equal rank: every second one after a winner or the run's start
        equal = touch[:-1] & (left == r)
        if equal.any():
            start = np.flatnonzero(~equal)
            place = np.arange(len(p)) - np.repeat(start, np.diff(np.append(start, len(p))))
            lead = np.repeat(win[start], np.diff(np.append(start, len(p))))
            win |= equal & lead & (place % 2 == 0) & ~worse_right
        keep[open_[win]] = True
        gone = win.copy()
        gone[1:] |= win[:-1] & touch[1:-1]
        gone[:-1] |= win[1:] & touch[1:-1]
        open_ = open_[~gone]
    return keep


def expansions(rules: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat, at): the ids of every nonterminal end to end, and where each begins."""
    at = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=at[1:])
    flat = np.zeros(int(at[-1]), np.uint32)
    left, right = rules[:, 0].astype(np.int64), rules[:, 1].astype(np.int64)
    depth = np.zeros(len(rules), np.int64)       # rules only refer to earlier rounds
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        depth[i] = 1 + max(depth[a - FIRST_RULE] if a >= FIRST_RULE else 0, depth[b - FIRST_RULE] if b >= FIRST_RULE else 0)
    for d in range(1, int(depth.max(initial=0)) + 1):
        now = np.flatnonzero(depth == d)
        place = at[now]
        for side in (left, right):
            s = side[now]
            plain = s < FIRST_RULE
            flat[place[plain]] = s[plain]
            rule = s[~plain] - FIRST_RULE
            n = (at[1:] - at[:-1])[rule]
            flat[ranges(place[~plain], n)] = flat[ranges(at[rule], n)]
            step = np.ones(len(now), np.int64)
            step[~plain] = n
            place = place + step
    return flat, at


def expand(symbols: np.ndarray, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ids of a run of symbols."""
    s = symbols.astype(np.int64)
    rule = s >= FIRST_RULE
    size = np.ones(len(s), np.int64)
    index = s[rule] - FIRST_RULE
    size[rule] = (at[1:] - at[:-1])[index]
    run = np.zeros(len(s) + 1, np.int64)
    np.cumsum(size, out=run[1:])
    out = np.empty(int(run[-1]), np.uint32)
    out[run[:-1][~rule]] = s[~rule]
    out[ranges(run[:-1][rule], size[rule])] = flat[ranges(at[index], size[rule])]
    return out


def read_document(shard: dict, i: int) -> np.ndarray:
    """The ids of document ``i`` of a shard row, without expanding the others."""
    rules = np.frombuffer(shard["rules"], np.uint32).reshape(-1, 2)
    flat, at = expansions(rules, np.frombuffer(shard["rule_length"], np.uint32))
    lo, hi = shard["symbol_at"][i], shard["symbol_at"][i + 1]
    return expand(np.frombuffer(shard["symbols"], np.uint32)[lo:hi], flat, at)


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int = 1, mode: str = "word",
                 shard_ids: int = SHARD_IDS, **grammar) -> DataFrame:
    """Encode, order by doc_id, compress and write the shard table; returns it as read back."""
    kind = docs.schema["doc_id"].dataType
    parts = 2 * even_partitions(docs.sparkSession)
    dealt = (docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
             .withColumn("part", F.spark_partition_id()))
    arrow_kind = pa.large_string() if kind.simpleString() == "string" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_for(tokenizer_path, mode, table_units=TABLE_UNITS, table_pieces=TABLE_PIECES)
        part, seq = 0, 0
        ids, sizes, names = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal seq
            n = np.concatenate(sizes)
            at = np.zeros(len(n) + 1, np.int64)
            np.cumsum(n, out=at[1:])
            symbols, symbol_at, rules, length = compress(np.concatenate(ids), at, **grammar)
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([end_id], pa.int32()),
                   pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.concat_arrays(names)),
                   pa.array([n.tolist()], pa.list_(pa.int64())), pa.array([symbol_at.tolist()], pa.list_(pa.int64())),
                   pa.array([rules.tobytes()], pa.binary()), pa.array([length.tobytes()], pa.binary()),
                   pa.array([symbols.tobytes()], pa.binary())]
            seq += 1
            ids.clear(), sizes.clear(), names.clear()
            return pa.RecordBatch.from_arrays(row, names=["part", "seq", "end_id", "doc_ids", "n_tokens", "symbol_at",
                                                          "rules", "rule_length", "symbols"])

        for batch in batches:
            for rows, col in text_chunks(batch, "text", ENCODE_BYTES):
                part = rows.column(2)[0].as_py()
                x, n = with_end(*coder.encode(col), end_id)
                ids.append(x.astype(np.uint32)), sizes.append(n)
                names.append(rows.column(0).cast(arrow_kind) if arrow_kind else rows.column(0))
                if sum(map(len, ids)) >= shard_ids:
                    yield close()
        if ids:
            yield close()

    return staged(dealt.mapInArrow(run, SCHEMA.format(kind=kind.simpleString())), "repair-shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document of a shard table: doc_id, start, n_tokens, ids_crc32, and its shard (part, seq)."""
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    # ids before each shard: parts first (as many as partitions), then shards of one part
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = shards.select("part", "seq", total.alias("ids"))
    parts = (sums.groupBy("part").agg(F.sum("ids").alias("ids"))
             .withColumn("part_start", F.sum("ids").over(W.orderBy("part")) - F.col("ids")).drop("ids"))
    starts = (sums.withColumn("in_part", F.sum("ids").over(W.partitionBy("part").orderBy("seq")) - F.col("ids"))
              .join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("in_part")).alias("shard_start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(j)[i] for j, k in enumerate(batch.schema.names)}
                names = row["doc_ids"].values
                n = np.asarray(row["n_tokens"].values)
                flat, at = expansions(np.frombuffer(row["rules"].as_buffer(), np.uint32).reshape(-1, 2),
                                      np.frombuffer(row["rule_length"].as_buffer(), np.uint32))
                symbols, where = np.frombuffer(row["symbols"].as_buffer(), np.uint32), np.asarray(row["symbol_at"].values)
                crc, got = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
                begin = 0
                while begin < len(n):                        # a stretch of documents at a time
                    end = max(begin + 1, int(np.searchsorted(where, where[begin] + 500_000)) - 1)
                    end = min(max(end, begin + 1), len(n))
                    ids = expand(symbols[where[begin]:where[end]], flat, at)
                    size = n[begin:end]
                    stop = np.cumsum(size)
                    raw = memoryview(ids.astype("<u4").tobytes())
                    for k, (b, e) in enumerate(zip((stop - size).tolist(), stop.tolist())):
                        crc[begin + k] = zlib.crc32(raw[4 * b:4 * e])
                        got[begin + k] = min(e, len(ids)) - b
                    begin = end
                start = np.cumsum(n) - n
                m = len(n)
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(start, pa.int64()), pa.array(got), pa.array(crc),
                     pa.array(np.full(m, row["part"].as_py(), np.int32)), pa.array(np.full(m, row["seq"].as_py(), np.int32))],
                    names=["doc_id", "in_shard", "n_tokens", "ids_crc32", "part", "seq"])

    # shards are decoded where they lie; only the short rows of documents meet the starts
    decoded = (shards.select("part", "seq", "doc_ids", "n_tokens", "symbol_at", "rules", "rule_length", "symbols")
               .mapInArrow(run, f"doc_id {kind}, in_shard long, n_tokens long, ids_crc32 long, part int, seq int"))
    return decoded.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32", "part", "seq")
