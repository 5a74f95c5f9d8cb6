"""Vectorised text statistics over the bytes of a batch of documents.

A chunk of documents is one byte array with document offsets. Words, lines and
word windows are found for all documents of the chunk at once, and hashed from
one running polynomial sum (modulo 2**64, with an odd base that has an inverse),
so no text is touched byte by byte in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: a 64-bit value for each byte; the second table reads A-Z as a-z
_VALUE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_FOLDED = _VALUE.copy()
_FOLDED[65:91] = _VALUE[97:123]
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        with np.errstate(over="ignore"):
            for i, base in enumerate((_BASE, _BASE_INV)):
                seq = np.full(max(n + 1, 1 << 16), base, _U)
                seq[0] = 1
                _powers[i] = np.cumprod(seq)
    return _powers[0], _powers[1]


class Chunk:
    """Documents of one chunk: bytes, offsets, and the words in them."""

    def __init__(self, col: pa.Array):
        if col.null_count:
            col = pc.fill_null(col, b"")
        off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
        lo, hi = (int(off[0]), int(off[-1])) if len(off) else (0, 0)
        data = col.buffers()[2]
        self.data = np.frombuffer(data, np.uint8, hi - lo, lo) if data is not None and hi > lo else np.zeros(0, np.uint8)
        self.off = off - lo
        self.n_docs = len(col)
        first = np.zeros(len(self.data) + 1, bool)   # a document begins here
        first[self.off[:-1]] = True
        first[-1] = True
        self.first = first
        self.ink = ~_SPACE[self.data]
        self.starts, self.ends, self.word_doc = self.spans(self.ink)
        self.n_words = np.bincount(self.word_doc, minlength=self.n_docs).astype(np.int64)

    def spans(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every run of marked bytes inside one document."""
        before = np.zeros(len(mask), bool)
        before[1:] = mask[:-1]
        before &= ~self.first[:-1]
        starts = np.flatnonzero(mask & ~before)
        after = np.zeros(len(mask), bool)
        after[:-1] = mask[1:]
        after &= ~self.first[1:]
        ends = np.flatnonzero(mask & ~after) + 1
        return starts, ends, np.searchsorted(self.off, starts, side="right") - 1

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each document the mask marks."""
        run = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=run[1:])
        return run[self.off[1:]] - run[self.off[:-1]]

    def span_hash(self, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
        """64-bit hash of each byte span; equal spans hash alike wherever they stand."""
        if not hasattr(self, "_run") or self._run[0] != fold:
            power, _ = _power(len(self.data))
            run = np.zeros(len(self.data) + 1, _U)
            with np.errstate(over="ignore"):
                np.cumsum((_FOLDED if fold else _VALUE)[self.data] * power[:len(self.data)], out=run[1:])
            self._run = (fold, run)
        run, inverse = self._run[1], _power(len(self.data))[1]
        with np.errstate(over="ignore"):
            body = (run[ends] - run[starts]) * inverse[starts]
            return mix64(body + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))

    def windows(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of ``n`` words inside one document, and the index of its first word."""
        m = len(words) - n + 1
        if m <= 0:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        inside = np.flatnonzero(self.word_doc[:m] == self.word_doc[n - 1:])
        total = np.zeros(m, _U)
        with np.errstate(over="ignore"):
            for k in range(n):
                total += mix64(words[k:k + m] + _U(k + 1)) if k else words[:m] * _U(3)
        return mix64(total[inside]), inside

    def in_doc(self, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Hashes that differ between documents too."""
        return hashes ^ mix64(doc.astype(_U) + _U(0x51ED2701))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks keys that occur twice or more."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.zeros(len(k), bool)
    out[order] = same[1:] | same[:-1]
    return out


def later_copies(keys: np.ndarray) -> np.ndarray:
    """Marks keys equal to an earlier one."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    out = np.zeros(len(k), bool)
    out[order[1:]] = k[1:] == k[:-1]
    return out
