"""Small frames and plain versions that the corpus tests compare with."""

from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
from pyspark.sql import SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark: SparkSession, rows, more: str = ""):
    """(doc_id, text, source) rows as documents; ``more`` adds columns that operators use names of."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    frame = spark.createDataFrame(full, DOCS)
    for name in more.split():
        from pyspark.sql import functions as F
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


def fold(text: str) -> str:
    return text.translate({k: k + 32 for k in range(65, 91)})


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = WORD.findall(fold(text or ""))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def plain_components(rows: list[tuple[int, str | None]], percent: int = 75) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component) from all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    shared: Counter = Counter()
    for h in holders.values():
        for a in range(len(h)):
            for b in range(a + 1, len(h)):
                shared[h[a], h[b]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def library_ids(name: str, text: str | None, plain: bool = False) -> list[int]:
    from tokenizers import Tokenizer

    if (name, plain) not in _coders:
        _coders[name, plain] = Tokenizer.from_file(vocabulary(name))
        _coders[name, plain].encode_special_tokens = plain
    return _coders[name, plain].encode(text or "", add_special_tokens=False).ids


_coders: dict = {}
