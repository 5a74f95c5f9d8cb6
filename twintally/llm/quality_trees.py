r"""Quality rules: gradient-boosted trees over document statistics.

Each document gives a row of statistics (one vectorised pass over its whole
text). Trees are grown on the statistics of at most ``SAMPLE_ROWS`` labelled
documents, with the sign of some statistics' effect constrained, flattened into
numpy node arrays, and walked for whole batches at once.

A document fails the base rules when it has fewer than 50 words, or more than
half of its words stand in 3-word windows that occur twice or more. It is kept
when it passes them and the trees' probability of quality 1 is at least ``KEEP_AT``.

Defined cases: NULL and empty texts have no words and fail the base rules;
repeated rows are judged each for itself; without labelled rows, or with one
class only, the trees accept every document; an empty table gives no rows;
NULL labels are not learnt from; extra columns pass through ``quality_filter``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintally.llm.common import id_hash, text_chunks
from twintally.llm.textops import Chunk, later_copies, repeated

#: labelled documents that the trees are grown on, at most (those of smallest id hash)
SAMPLE_ROWS = 10_000
MIN_WORDS = 50
KEEP_AT = 0.5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: statistics and the allowed sign of their effect on quality (0: free)
FEATURES = (("log_words", 1), ("word_length", 0), ("symbols_per_word", -1), ("dup_line_share", -1),
            ("repeat_share", -1), ("upper_share", -1), ("digit_share", 0), ("punctuation_share", -1),
            ("distinct_share", 1), ("words_per_line", 0), ("non_ascii_share", 0))


def statistics(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(base counts, features) of the documents of one chunk."""
    c = Chunk(col)
    d = c.data
    n = c.n_words
    word_chars = c.per_doc(c.ink & ((d & 0xC0) != 0x80))
    symbols = c.per_doc(np.isin(d, np.frombuffer(b"#*$%&|<>", np.uint8)))
    upper = c.per_doc((d >= 65) & (d <= 90))
    lower = c.per_doc((d >= 97) & (d <= 122))
    digits = c.per_doc((d >= 48) & (d <= 57))
    wide = c.per_doc(d >= 128)
    marks = c.per_doc(c.ink & (d < 128)) - upper - lower - digits

    # lines: a new one at a document's start and after each \n; only those with a word count
    breaks = c.first[:-1].copy()
    breaks[1:] |= d[:-1] == 10
    line_start = np.flatnonzero(breaks)
    stop = np.append(line_start[1:], len(d))[:len(line_start)]
    line_end = stop - (d[stop - 1] == 10)
    ink = np.zeros(len(d) + 1, np.int64)
    np.cumsum(c.ink, out=ink[1:])
    worded = ink[line_end] > ink[line_start]
    line_start, line_end = line_start[worded], line_end[worded]
    line_doc = np.searchsorted(c.off, line_start, side="right") - 1
    lines = np.bincount(line_doc, minlength=c.n_docs)
    again = later_copies(c.in_doc(c.span_hash(line_start, line_end), line_doc))
    dup_lines = np.bincount(line_doc[again], minlength=c.n_docs)

    words = c.span_hash(c.starts, c.ends)
    three, at = c.windows(words, 3)
    hit = at[repeated(c.in_doc(three, c.word_doc[at]))]
    covered = np.zeros(len(words) + 2, bool)
    for k in range(3):
        covered[hit + k] = True
    repeat_words = np.bincount(c.word_doc[covered[:len(words)]], minlength=c.n_docs)
    distinct = n - np.bincount(c.word_doc[later_copies(c.in_doc(words, c.word_doc))], minlength=c.n_docs)

    base = np.stack([n, word_chars, symbols, dup_lines, repeat_words], 1).astype(np.int64)
    some, chars = np.maximum(n, 1), np.maximum(word_chars, 1)
    x = np.stack([np.log1p(n), word_chars / some, symbols / some, dup_lines / np.maximum(lines, 1),
                  repeat_words / some, upper / np.maximum(upper + lower, 1), digits / chars, marks / chars,
                  distinct / np.sqrt(some), n / np.maximum(lines, 1), wide / chars], 1)
    return base, x


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > 50 * base[:, 0])


@dataclass
class Trees:
    """Flattened trees: node arrays of every tree end to end; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            out += self.value[node]
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def grow(x: np.ndarray, y: np.ndarray, signs: tuple[int, ...], n_trees: int = 60, depth: int = 4,
         rate: float = 0.2, bins: int = 64, least: int = 5, ridge: float = 1.0) -> Trees:
    """Boost regression trees on the logistic loss with histogram splits.

    ``signs`` limits each feature's effect: +1 never decreasing, -1 never
    increasing. A split on such a feature must order its children's values, and
    their midpoint bounds what either side's descendants may take.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], 1)
    p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(p / (1 - p)))
    margin = np.full(n, bias)
    roots, feature, threshold, left, right, value = [], [], [], [], [], []

    def node(v: float) -> int:
        i = len(value)
        feature.append(0), threshold.append(np.inf), left.append(i), right.append(i), value.append(v)
        return i

    for _ in range(n_trees):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = y - prob, np.maximum(prob * (1 - prob), 1e-9)
        root = node(0.0)
        roots.append(root)
        level = [(root, np.arange(n), -np.inf, np.inf)]
        for d in range(depth + 1):
            following = []
            for at, rows, lo, hi in level:
                g, h = grad[rows].sum(), hess[rows].sum()
                value[at] = rate * float(np.clip(g / (h + ridge), lo, hi))
                best = (1e-6, None) if d < depth and len(rows) >= 2 * least else None
                for j in range(m if best else 0):
                    if not len(cuts[j]):
                        continue
                    k = len(cuts[j]) + 1
                    cj = code[rows, j]
                    gl = np.cumsum(np.bincount(cj, grad[rows], k))[:-1]
                    hl = np.cumsum(np.bincount(cj, hess[rows], k))[:-1]
                    cl = np.cumsum(np.bincount(cj, minlength=k))[:-1]
                    vl, vr = np.clip(gl / (hl + ridge), lo, hi), np.clip((g - gl) / (h - hl + ridge), lo, hi)
                    gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
                    fits = (cl >= least) & (len(rows) - cl >= least) & (signs[j] * (vr - vl) >= 0)
                    gain = np.where(fits, gain, -1)
                    s = int(gain.argmax())
                    if gain[s] > best[0]:
                        best = (gain[s], (j, s, vl[s], vr[s]))
                if best and best[1]:
                    j, s, vl, vr = best[1]
                    mid = (vl + vr) / 2
                    a, b = node(0.0), node(0.0)
                    feature[at], threshold[at], left[at], right[at] = j, cuts[j][s], a, b
                    down = code[rows, j] <= s
                    bounds = {0: ((lo, hi), (lo, hi)), 1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}[signs[j]]
                    following += [(a, rows[down], *bounds[0]), (b, rows[~down], *bounds[1])]
                else:
                    margin[rows] += value[at]
            level = following
    return Trees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right),
                 np.array(value), depth, bias)


_STATS = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))])


def _sample_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, col in text_chunks(batch, "text"):
            base, x = statistics(col)
            keep = pa.array(~base_failed(base))
            out = pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("y")).cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))],
                schema=_STATS)
            yield out.filter(keep)


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **shape) -> Trees | None:
    """Grow the trees on labelled documents that pass the base rules.

    The sample is the ``sample_rows`` labels of smallest id hash; its
    statistics (a few numbers each) are the only rows the driver sees. None
    when there is nothing to tell apart.
    """
    chosen = (labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("k"), F.col("quality").alias("y"))
              .orderBy(id_hash(F.col("k")), "k").limit(sample_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("k")).select("y", "text")
    rows = texts.mapInArrow(_sample_stats, "y int, x array<double>").limit(2 * sample_rows).toPandas()
    if rows["y"].nunique() < 2:
        return None
    return grow(np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(float), tuple(s for _, s in FEATURES), **shape)


def _judge(trees: Trees | None, keep_at: float):
    def verdicts(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        base, x = statistics(col)
        failed = base_failed(base)
        p = np.ones(len(x)) if trees is None else trees.probability(x)
        return base, failed, p, ~failed & (p >= keep_at)
    return verdicts


def quality_report(docs: DataFrame, trees: Trees | None, keep_at: float = KEEP_AT) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, the trees' probability, kept."""
    verdicts = _judge(trees, keep_at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, col in text_chunks(batch, "text"):
                base, failed, p, kept = verdicts(col)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *[pa.array(base[:, i]) for i in range(len(BASE))], pa.array(failed), pa.array(p),
                     pa.array(kept)], names=["doc_id", *BASE, "base_failed", "quality", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, quality double, kept boolean")


def quality_filter(docs: DataFrame, trees: Trees | None, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that are kept, with every column."""
    verdicts = _judge(trees, keep_at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, col in text_chunks(batch, "text"):
                yield rows.filter(pa.array(verdicts(col)[3]))

    return docs.mapInArrow(run, docs.schema)
