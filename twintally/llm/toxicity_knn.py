"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are runs of letters (A-Z read as a-z) and their first 4 to 9 bytes,
so that endings do not hide a stem. The terms that tell the labels apart in the
labelled sample make the vocabulary; weights are (1 + ln tf) * ln(1 + N / df)
with df counted over all documents, and vectors have length one.

The examples lie in blocks of ``BLOCK``; for every term the index holds its
largest weight in each block. A query adds up these maxima per block, visits
blocks from the highest bound down, and stops when no bound can beat its k-th
neighbour, so the neighbours are exact. They vote with weight 1 / (distance +
``SOFT``); a monotone calibration, learnt leave-one-out on the examples, turns
votes into probabilities. Texts without any term of the vocabulary get the rate
of such examples.

Defined cases: NULL and empty texts have no terms; repeated rows score alike;
equal similarities go to the smaller example id; without labelled rows (or
with one class) every score is that class's rate, 0 without any; an empty table
gives no rows; an id with differing labels counts as toxic; extra columns
cannot clash, only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.common import id_hash, staged, text_chunks
from twintally.llm.textops import Chunk

#: labelled rows learnt from, at most (those of smallest id hash)
SAMPLE_ROWS = 20_000
#: terms of the vocabulary, at most
VOCABULARY = 4_096
#: a term needs this many labelled documents
LEAST_DOCUMENTS = 3
#: and at least this share of them toxic (with one document of either label added)
LEAST_RATE = 0.75
NEIGHBOURS = 15
BLOCK = 64
SOFT = 0.1
#: weights tried for the term that stands for the rest of a text
REST_WEIGHTS = (0.0, 5.0, 10.0, 20.0, 40.0)
TOXIC_AT = 0.7
PREFIXES = (4, 5, 6, 7, 8, 9)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def held_out(doc_id: Column) -> Column:
    """Rows that nothing may be learnt from: crc32 of the id's text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def term_counts(col: pa.Array, vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term hash or vocabulary index, count) of a chunk, by document."""
    c = Chunk(col)
    starts, ends, doc = c.spans(_LETTER[c.data])
    hashes, docs = [c.span_hash(starts, ends, fold=True)], [doc]
    for n in PREFIXES:
        longer = np.flatnonzero(ends - starts > n)
        hashes.append(c.span_hash(starts[longer], starts[longer] + n, fold=True) ^ np.uint64(n))
        docs.append(doc[longer])
    h, d = np.concatenate(hashes), np.concatenate(docs)
    if vocabulary is not None:
        at = np.searchsorted(vocabulary, h)
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
        d, h = d[known], at[known].astype(np.uint64)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    return d[first], h[first], np.diff(np.append(first, len(h)))


def choose_vocabulary(texts: DataFrame, size: int = VOCABULARY) -> np.ndarray:
    """Sorted term hashes that tell the labels apart; ``texts`` has (text, y).

    A term's G statistic against the labels must exceed what the best of all
    tested terms would reach by chance (2 ln of their number).
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, col in text_chunks(batch, "text"):
                y = np.asarray(rows.column(1)).astype(np.int64)
                d, h, _ = term_counts(col)
                terms, which = np.unique(h, return_inverse=True)
                n = np.bincount(which, minlength=len(terms))
                pos = np.bincount(which, y[d], minlength=len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(pos)],
                                                 names=["term", "n", "pos"])

    totals = texts.agg(F.count("*"), F.sum("y")).first()
    n_all, n_pos = totals[0], totals[1] or 0
    if not n_pos or n_pos == n_all:
        return np.zeros(0, np.uint64)
    counts = staged(texts.select("text", "y").mapInArrow(count, "term long, n long, pos long")
                    .groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
                    .where(F.col("n") >= LEAST_DOCUMENTS), "tox-terms")
    rate = n_pos / n_all
    part = lambda got, want: F.when(got > 0, got * F.log(got / want)).otherwise(0.0)
    neg, expected = F.col("n") - F.col("pos"), F.col("n") * rate
    g = 2 * (part(F.col("pos"), expected) + part(neg, F.col("n") * (1 - rate)))
    tested = counts.count()
    rows = (counts.withColumn("g", g).where(((F.col("pos") + 1) / (F.col("n") + 2) >= LEAST_RATE) & (F.col("pos") > expected)
                                                & (F.col("g") > 2 * math.log(max(tested, 2))))
            .orderBy(F.desc("g"), "term").limit(size).select("term").toPandas())
    return np.sort(rows["term"].to_numpy(np.int64).view(np.uint64))


def sparse_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per document: doc_id, terms (vocabulary indices), counts. One pass over the texts, staged."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, col in text_chunks(batch, "text"):
                d, t, n = term_counts(col, vocabulary)
                at = pa.array(np.searchsorted(d, np.arange(len(col) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(at, pa.array(t.astype(np.int32))),
                     pa.ListArray.from_arrays(at, pa.array(n.astype(np.int32)))], names=["doc_id", "terms", "counts"])

    return staged(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, terms array<int>, counts array<int>"), "tox-counts")


@dataclass
class BlockMaxIndex:
    """Examples in blocks, with postings by (block, term) and the largest weight of each.

    ``rest`` is the weight of one more term that every text holds once. It
    stands for the remainder of the text: without it a single doubtful term
    would point the same way as many.
    """

    ids: list
    labels: np.ndarray
    idf: np.ndarray
    counts: list = field(repr=False)        # (terms, counts) of each example
    rest: float = 0.0
    k: int = NEIGHBOURS

    def __post_init__(self):
        self.rows = [self.vector(t, c) for t, c in self.counts]
        self.top = np.zeros((len(self.idf) + 1, -(-len(self.rows) // BLOCK)))
        self.postings: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        for b in range(self.top.shape[1]):
            lists: dict[int, tuple[list, list]] = {}
            for j, (terms, weights) in enumerate(self.rows[b * BLOCK:(b + 1) * BLOCK]):
                for t, w in zip(terms.tolist(), weights.tolist()):
                    at, ws = lists.setdefault(t, ([], []))
                    at.append(j), ws.append(w)
            self.postings.append({t: (np.array(a), np.array(w)) for t, (a, w) in lists.items()})
            for t, (_, w) in lists.items():
                self.top[t, b] = max(w)

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.append((1 + np.log(counts)) * self.idf[terms], self.rest)
        return np.append(terms, len(self.idf)).astype(np.int64), w / max(np.sqrt((w * w).sum()), 1e-12)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, skip: int = -1) -> list[tuple[float, int]]:
        """The k best (similarity, example) with similarity over 0, exact; ties by example."""
        bound = weights @ self.top[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or (len(best) == self.k and bound[b] < best[-1][0] - 1e-9):
                break
            score = np.zeros(BLOCK)
            lists = self.postings[b]
            for t, w in zip(terms.tolist(), weights.tolist()):
                if t in lists:
                    at, ws = lists[t]
                    score[at] += w * ws
            hit = np.flatnonzero(score > (best[-1][0] - 1e-9 if len(best) == self.k else 0))
            found = [(float(round(score[j], 12)), b * BLOCK + int(j)) for j in hit if b * BLOCK + j != skip]
            best = sorted(best + found, key=lambda x: (-x[0], x[1]))[:self.k]
        return best

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Distance-weighted share of toxic neighbours; missing neighbours count as clean at distance 1."""
        w = [1 / (max(0.0, 1 - s) + SOFT) for s, _ in found]
        blank = (self.k - len(found)) / (1 + SOFT) * 0.2
        return sum(x * self.labels[j] for x, (_, j) in zip(w, found)) / (sum(w) + blank)


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray
    index: BlockMaxIndex | None
    base_rate: float                 # of texts without any term
    steps: np.ndarray                # calibration: votes ...
    rates: np.ndarray                # ... and their probabilities

    def score(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, list]:
        if self.index is None or not len(terms):
            return self.base_rate, []
        found = self.index.nearest(*self.index.vector(terms, counts))
        p = float(np.interp(self.index.vote(found), self.steps, self.rates))
        return p, [(self.index.ids[j], s, int(self.index.labels[j])) for s, j in found]


def monotone(votes: np.ndarray, labels: np.ndarray, bins: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """A rising piecewise-linear map from votes to rates: equal-width bins, pooled until none falls."""
    code = np.minimum((votes * bins).astype(int), bins - 1)
    pools = []
    for b in np.unique(code):
        here = code == b
        pools.append([votes[here].sum(), labels[here].sum() + 0.01, float(here.sum()) + 0.02])
        pools[-1][0] += 0.02 * votes[here].mean()
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] > pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + z for a, z in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, vocabulary_size: int = VOCABULARY,
                 k: int = NEIGHBOURS) -> tuple[ToxicityModel, DataFrame]:
    """The model, and the staged term counts of all documents.

    ``labels`` has (doc_id, toxic) of the rows that may be learnt from. The
    driver sees at most ``vocabulary_size`` term counts and the short vectors
    of at most ``sample_rows`` examples.
    """
    chosen = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("k")).agg(F.max("toxic").cast("int").alias("y"))
              .orderBy(id_hash(F.col("k")), "k").limit(sample_rows))
    chosen = staged(chosen, "tox-sample")       # at most sample_rows rows: small enough to broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("k"))
    texts = staged(texts.select("text", "y"), "tox-texts")
    vocabulary = choose_vocabulary(texts, vocabulary_size)
    counts = sparse_counts(docs, vocabulary)
    n = counts.count()
    df = np.zeros(len(vocabulary))
    for row in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():   # a row a term at most
        df[row["t"]] = row["count"]
    idf = np.log(1 + n / np.maximum(df, 1))
    # copies of an id in documents are one example
    examples = (counts.join(F.broadcast(chosen), F.col("doc_id") == F.col("k"))
                .groupBy("doc_id").agg(F.first("y").alias("y"), F.min(F.struct("terms", "counts")).alias("v"))
                .orderBy(id_hash(F.col("doc_id")), "doc_id").limit(sample_rows)
                .select("doc_id", "y", "v.terms", "v.counts").toPandas())
    has = examples["terms"].map(len).to_numpy() > 0
    without = examples.loc[~has, "y"]
    rate = float(without.mean()) if len(without) else (float(examples["y"].mean()) if len(examples) else 0.0)
    some = examples[has].sort_values("doc_id")
    if not len(some):
        return ToxicityModel(vocabulary, None, rate, np.zeros(1), np.zeros(1)), counts
    # examples without a term are all alike: only the k of smallest id can be among the nearest
    some = pd.concat([some, examples[~has].sort_values("doc_id").head(k)])
    rows = [(np.asarray(t, np.int64), np.asarray(c, np.float64)) for t, c in zip(some["terms"], some["counts"])]
    y, own = some["y"].to_numpy(), int(has.sum())
    best = None
    for rest in REST_WEIGHTS:               # the weight that predicts the examples best, each left out in turn
        index = BlockMaxIndex(some["doc_id"].tolist(), y, idf, rows, rest, k)
        votes = np.array([index.vote(index.nearest(*index.rows[i], skip=i)) for i in range(own)])
        steps, rates = monotone(votes, y[:own])
        p = np.clip(np.interp(votes, steps, rates), 1e-3, 1 - 1e-3)
        loss = -np.mean(np.where(y[:own] == 1, np.log(p), np.log(1 - p)))
        if best is None or loss < best[0]:
            best = (loss, index, steps, rates)
    best[1].rows, best[1].counts = [], []   # the postings hold them
    return ToxicityModel(vocabulary, best[1], rate, best[2], best[3]), counts


def toxicity_scores(counts: DataFrame, model: ToxicityModel, toxic_at: float = TOXIC_AT) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the neighbours as evidence."""
    kind = counts.schema["doc_id"].dataType.simpleString()
    shared = counts.sparkSession.sparkContext.broadcast(model)      # bounded by the sample and the vocabulary
    evidence = pa.list_(pa.struct([("doc_id", pa.string()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, found = [], []
            for t, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, near = m.score(np.array(t, np.int64), np.array(c, np.float64))
                scores.append(p)
                found.append([{"doc_id": str(i), "similarity": s, "toxic": y} for i, s, y in near])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(p >= toxic_at) for p in scores], pa.int32()), pa.array(found, evidence)],
                names=["doc_id", "held_out", "score", "predicted", "evidence"])

    return counts.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "terms", "counts").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int, "
             "evidence array<struct<doc_id: string, similarity: double, toxic: int>>")
