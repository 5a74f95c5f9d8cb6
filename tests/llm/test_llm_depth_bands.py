import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm_frames import WORD
from twintally.llm import depth_bands as D

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Rows of the trie from dictionaries of turns."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((t is not None, t or 0, name, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) if children[p] else 1
        words = len(WORD.findall(p[-1][1])) if p else 0
        saved[p] = (len(nodes[p]) - 1) * words + sum(saved[q] for q in children[p])
        ends = ",".join(str(c) for c in sorted(nodes[p]) if len(rebuilt[c]) == len(p))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    return sorted((tuple(r) for r in D.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(3)).collect()), key=str)


def branching(rng, convs, depth, fork, first=0):
    """Conversations that follow one line of turns and leave it at random depths, often onto each other."""
    rows, lines = [], [[("user", f"a {i} b") for i in range(depth)]]
    for c in range(first, first + convs):
        base = rng.choice(lines)
        cut = rng.randrange(len(base) + 1)
        line = base[:cut] + [("assistant", f"w{rng.randrange(2)} " * rng.randrange(4)) for _ in range(rng.randrange(fork))]
        lines.append(line)
        rows += [(c, t, r, x) for t, (r, x) in enumerate(line)]
    return rows


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_equals_a_plain_version(spark, monkeypatch, band):
    monkeypatch.setattr(D, "BAND", band)
    monkeypatch.setattr(D, "PIECE", 3)
    rng = random.Random(band)
    rows = branching(rng, 90, 21, 6) + branching(rng, 30, 5, 3, 200)
    rows += [(300 + c, t, "user", f"a {t} b") for c in range(40) for t in range(6)]        # copies of one conversation
    assert found(spark, rows) == plain(rows)


def test_long_conversations_cross_tasks(spark, monkeypatch):
    monkeypatch.setattr(D, "BAND", 4)
    rows = [(1, t, "user", f"t{t % 7}") for t in range(700)] + [(20, t, "user", f"t{t % 7}") for t in range(500)]
    rows += [(2, t, "user", f"t{t % 7}") for t in range(300)] + [(3, 0, "user", "t0")]
    assert found(spark, rows) == plain(rows)


def test_nulls_ties_repeats_and_missing_bases(spark):
    rows = [(5, None, None, None), (5, 1, "user", None), (5, 1, "user", ""), (5, 1, None, "x y"), (5, 1, None, "x y"), (None, 1, "user", "lost"),
            (0, 3, "user", "one two"), (0, 2, "user", "three"), (7, 0, "u", "only"), (21, 0, "u", "a"), (22, 0, "u", "a"), (23, 1, "u", "a"),
            (-5, 0, "u", "neg ative"), (-5, 1, "u", "ative"), (40, 0, "us", "er"), (41, 0, "u", "ser"), (41, 1, "", "x" * 30000)]
    rows += [(c, 0, "u", "short") for c in range(60, 80)]
    assert found(spark, rows) == plain(rows)


def test_only_turnless_conversations(spark):
    # without a base, a conversation of as many turns as its head has none left
    ids = [c for c in range(1, 60) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:12]
    rows = [(c, 0, "u", "x") for c in ids]
    assert found(spark, rows) == plain(rows) and len(plain(rows)) == 1


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "u", "x")]) == []
    rows = [(1, 0, "u", "x y"), (1, 1, "u", "z"), (2, 0, "u", "x y")]
    frame = spark.createDataFrame(rows, TURNS)
    for name in ("h", "s", "p", "pos", "words", "depth", "m", "level", "owner", "a.b"):
        frame = frame.withColumn(name, F.lit("clash"))
    assert sorted((tuple(r) for r in D.prefix_trie(frame).collect()), key=str) == plain(rows)
