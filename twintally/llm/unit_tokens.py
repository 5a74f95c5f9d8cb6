r"""Token ids of whole texts, encoding each distinct unit of a text once per task.

The pre-tokenizers used here never look across the border between a word and
the white space after it, so a text's ids are the ids of its units end to end:

* ``"word"``: a unit is a word (runs of anything but ``\x20 \x09-\x0D``); the
  tokenizer drops white space;
* ``"spaced"``: a unit is the white space before a word with the word itself,
  or the white space that ends a text (byte-level pre-tokenizers join one blank
  to the word after it).

Units are found and hashed for a whole chunk at once, known ones come from a
table of bounded size, and new ones are encoded with the tokenizers library, piece
by piece. A full table forgets the units that it met only once. A
text with white space outside those six characters, which could tie two units
together, is encoded whole. NULL texts are empty.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from twintally.llm.textops import Chunk

#: units that a task's table holds at most before it forgets the rare ones
TABLE_UNITS = 400_000
#: parts of units (letter runs and the like) that it holds at most
TABLE_PIECES = 200_000
#: stands between units that are cut into pieces together; a unit that holds it is encoded on its own
_BETWEEN = "\x00"
#: \s beyond the six characters: control separators, NEL, no-break and wide blanks
ODD_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
#: anything but ASCII and Latin letters with one plain lower-case form
_STRANGE = re.compile("[^\x00-\x7fÀ-įĲ-ž]+")
_WORD_PIECES = re.compile(r"\x00|'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w\x00]|_)+")
_SPACED_PIECES = re.compile(r"\x00|'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w\x00]|_)+|\s+(?![^\s\x00])|\s+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class UnitTokenizer:
    """Encodes chunks of texts; holds the units met so far."""

    def __init__(self, path: str, mode: str, table_units: int = TABLE_UNITS, plain_specials: bool = False,
                 table_pieces: int = TABLE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials    # their strings in a text are then ordinary text
        self.mode, self.table_units, self.table_pieces = mode, table_units, table_pieces
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        self.letters = _byte_letters()
        self._reset()

    def _reset(self) -> None:
        self._reset_pieces()
        self.keys = np.zeros(0, np.uint64)          # sorted
        self.at = np.zeros(0, np.int64)             # where a unit's ids begin in flat
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.met = np.zeros(0, np.int32)            # chunks that a unit was met in

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Add pieces; none is known yet or holds the separator."""
        # spelled all at once: the separator's letter occurs in no other piece
        spelled = _BETWEEN.join(pieces).encode().decode("latin-1").translate(self.letters).split(self.letters[0])
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(s)] for s in spelled]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.pieces.update(zip(pieces, range(len(self.piece_size), len(self.piece_size) + len(pieces))))
        self.piece_at = np.concatenate([self.piece_at, len(self.piece_flat) + np.cumsum(size) - size])
        self.piece_size = np.concatenate([self.piece_size, size])
        self.piece_flat = np.concatenate([self.piece_flat, np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))])

    def _reset_pieces(self) -> None:
        self.pieces: dict[str, int] = {_BETWEEN: 0}
        self.piece_at = np.zeros(1, np.int64)       # where a piece's ids begin in piece_flat
        self.piece_size = np.zeros(1, np.int64)
        self.piece_flat = np.zeros(0, np.int32)

    def _ids_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of units end to end, ids of each); plain units by pieces, cut all at once, anything else by the
        whole tokenizer."""
        joined = _BETWEEN.encode().join(texts).decode("utf-8", "replace")
        units = joined.split(_BETWEEN)
        apart: set[int] = set()
        if len(units) != len(texts):                # some unit holds the separator
            units = [t.decode("utf-8", "replace") for t in texts]
            apart = {i for i, u in enumerate(units) if _BETWEEN in u}
            joined = _BETWEEN.join(["" if i in apart else u for i, u in enumerate(units)])
        length = np.fromiter(map(len, units), np.int64, len(units))
        length[list(apart)] = 0
        stop = np.cumsum(length + 1)
        strange = [m.start() for rx in (_STRANGE, self.special) for m in rx.finditer(joined)]
        apart.update(np.searchsorted(stop, np.array(strange, np.int64), "right").tolist())
        if apart:
            joined = _BETWEEN.join(["" if i in apart else u for i, u in enumerate(units)])
        found = _WORD_PIECES.findall(joined.lower()) if self.mode == "word" else _SPACED_PIECES.findall(joined)
        which = list(map(self.pieces.get, found))
        if None in which:
            new = {p for p, k in zip(found, which) if k is None}
            if len(self.pieces) + len(new) > self.table_pieces:
                self._reset_pieces()
                new = {*found} - {_BETWEEN}
            self._learn_pieces([*new])
            which = list(map(self.pieces.get, found))
        at = np.array(which, np.int64)
        size = self.piece_size[at]
        run = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=run[1:])
        flat = self.piece_flat[ranges(self.piece_at[at], size, run)]
        ends = np.append(run[np.flatnonzero(at == 0)], run[-1])         # of each unit's ids
        sizes = np.diff(ends, prepend=0)
        if apart:
            others = {i: self.tokenizer.encode(units[i], add_special_tokens=False).ids for i in sorted(apart)}
            where = [*others]
            sizes[where] = [len(x) for x in others.values()]
            flat = np.insert(flat, np.repeat(ends[where], sizes[where]), np.fromiter(chain.from_iterable(others.values()), np.int32))
        return flat, sizes

    def _learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        """Add units; ``keys`` are sorted and new."""
        flat, size = self._ids_of(texts)
        at = len(self.flat) + np.cumsum(size) - size
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, at)
        self.size = np.insert(self.size, where, size)
        self.met = np.insert(self.met, where, 0)
        self.flat = np.concatenate([self.flat, flat])

    def _forget(self) -> None:
        """Keep the units met again since they were learnt, the half met most often when these are too many."""
        least = max(2, int(np.partition(self.met, len(self.met) // 2)[len(self.met) // 2]) + 1)
        stay = self.met >= least
        self.keys, at, self.size = self.keys[stay], self.at[stay], self.size[stay]
        self.flat = self.flat[ranges(at, self.size)]
        self.at = np.cumsum(self.size) - self.size
        self.met = np.ones(len(self.keys), np.int32)

    def _units(self, c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and document of the units, in text order."""
        if self.mode == "word":
            return c.starts, c.ends, c.word_doc
        # a unit begins where the previous one of its document ended
        doc_start = c.off[:-1]
        begin = np.empty_like(c.starts)
        if len(begin):
            begin[0] = 0
            begin[1:] = c.ends[:-1]
            np.maximum(begin, doc_start[c.word_doc], out=begin)
        last = np.maximum(doc_start, 0).copy()      # where the last word of each document ends
        last[c.word_doc] = c.ends                   # ascending, so the last one stays
        tail = np.flatnonzero(c.off[1:] > last)
        starts, ends = np.concatenate([begin, last[tail]]), np.concatenate([c.ends, c.off[1:][tail]])
        doc = np.concatenate([c.word_doc, tail])
        order = np.argsort(starts, kind="stable")
        return starts[order], ends[order], doc[order]

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the chunk's texts end to end, number of ids of each text)."""
        odd = np.asarray(pc.fill_null(pc.match_substring_regex(col.cast(pa.large_string()), ODD_SPACE), False))
        if odd.any():
            return self._encode_with_odd(col, odd)
        c = Chunk(col)
        starts, ends, doc = self._units(c)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(c.n_docs, np.int64)
        keys, first, which = distinct(c.span_hash(starts, ends))
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            if len(self.keys) + len(new) > self.table_units and len(self.keys):
                self._forget()
                at = np.searchsorted(self.keys, keys)
                inside = at < len(self.keys)
                known[:] = False
                known[inside] = self.keys[at[inside]] == keys[inside]
                new = np.flatnonzero(~known)
            data = c.data.tobytes()
            f = first[new]
            self._learn(keys[new], [data[a:b] for a, b in zip(starts[f].tolist(), ends[f].tolist())])
            at = np.searchsorted(self.keys, keys)
        self.met[at] += 1
        unit_at, unit_size = self.at[at][which], self.size[at][which]
        total = np.zeros(c.n_docs, np.int64)
        run = np.zeros(len(unit_size) + 1, np.int64)
        np.cumsum(unit_size, out=run[1:])
        edge = np.searchsorted(doc, np.arange(c.n_docs + 1))
        total = run[edge[1:]] - run[edge[:-1]]
        return self.flat[ranges(unit_at, unit_size, run)], total

    def _encode_with_odd(self, col: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [], np.zeros(len(col), np.int64)
        for i in range(len(col)):
            if odd[i]:
                ids = self.tokenizer.encode(col[i].as_py().decode("utf-8", "replace"), add_special_tokens=False).ids
                parts.append(np.array(ids, np.int32))
            else:
                parts.append(self.encode(col.slice(i, 1))[0])
            sizes[i] = len(parts[-1])
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), sizes


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct values, where each occurs first, which one each value is), by Arrow's hash table."""
    coded = pa.array(values).dictionary_encode()
    at, found = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    order = np.argsort(found)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.empty(len(found), np.int64)
    first[at[::-1]] = np.arange(len(at) - 1, -1, -1)        # of repeated places the last one written stays
    return found[order], first[order], place[at]


def ranges(start: np.ndarray, size: np.ndarray, run: np.ndarray | None = None) -> np.ndarray:
    """The indices start[i], start[i]+1, ... (size[i] of them), for all i end to end."""
    if run is None:
        run = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=run[1:])
    return np.repeat(start - run[:-1], size) + np.arange(run[-1])


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every document."""
    run = np.cumsum(sizes)
    return np.insert(ids, run, end_id), sizes + 1


_held: dict[tuple, UnitTokenizer] = {}


def tokenizer_for(path: str, mode: str, plain_specials: bool = False, table_units: int = TABLE_UNITS,
                  table_pieces: int = TABLE_PIECES) -> UnitTokenizer:
    """The worker's tokenizer for a vocabulary file, kept between tasks."""
    key = (path, mode, plain_specials, table_units, table_pieces)
    if key not in _held:
        _held[key] = UnitTokenizer(path, mode, table_units, plain_specials, table_pieces)
    return _held[key]
