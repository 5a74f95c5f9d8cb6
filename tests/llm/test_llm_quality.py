import re
from collections import Counter

import numpy as np
from llm_frames import WORD, docs_frame
from twintally.llm import quality_trees as Q

TEXTS = [None, "", " \n\t ", "one", "a b c a b c a b c", "l1 x\nl1 x\n\nl1 x \nl1 x", "é#ü $$ <b> & | %*", "\x0b\x0c tab\tsep",
         "word " * 60, " ".join(f"w{i}" for i in range(70)), "A b c\n" * 30, "Ünï " * 3000]
CLEAN = [f"The quick number {i} of a plain text goes on with words like these and others, {' '.join(f'w{i}x{j}' for j in range(60))}."
         for i in range(60)]
JUNK = [" ".join(f"w{i}x{j}###" for j in range(70)) for i in range(60)]


def plain_base(t):
    t = t or ""
    w = WORD.findall(t)
    tri = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    cover, seen, dup = set(), set(), 0
    for k in range(len(w) - 2):
        if tri[tuple(w[k:k + 3])] > 1:
            cover |= {k, k + 1, k + 2}
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def frames(spark):
    rows = [(i, t, "s") for i, t in enumerate(CLEAN + JUNK)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120) if i % 2] + [(500, None), (None, 1)],
                                   "doc_id long, quality int")
    return docs_frame(spark, rows), labels


def test_base_counts(spark):
    docs = docs_frame(spark, [(i, t, "s") for i, t in enumerate(TEXTS)] + [(0, None, "s"), (None, "x", "s")], "kept n_words y x")
    got = Q.quality_report(docs, None).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        t = TEXTS[r.doc_id] if r.doc_id is not None else "x"
        n, chars, symbols, dup, rep = plain_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), t
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n) and r.kept == (not r.base_failed)


def test_trees_learn_and_filter(spark):
    docs, labels = frames(spark)
    trees = Q.fit_quality(docs, labels)
    kept = {r.doc_id for r in Q.quality_report(docs, trees).collect() if r.kept}
    assert kept == set(range(60))
    passed = Q.quality_filter(docs, trees)
    assert passed.columns == docs.columns and {r.doc_id for r in passed.collect()} == kept


def test_nothing_to_learn(spark):
    docs, labels = frames(spark)
    assert Q.fit_quality(docs, labels.limit(0)) is None
    assert Q.fit_quality(docs, labels.where("quality = 1")) is None
    assert Q.fit_quality(docs.limit(0), labels) is None
    assert Q.quality_filter(docs.limit(0), None).count() == 0


def test_monotone_features_never_turn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] + 0.5 * np.sin(3 * x[:, 0]) + rng.normal(size=2000) * 0.7) > 0).astype(float)
    trees = Q.grow(x, y, (1, 0, -1), n_trees=40)
    base = rng.normal(size=(50, 3))
    for j, sign in ((0, 1), (2, -1)):
        for row in base:
            grid = np.repeat(row[None], 60, 0)
            grid[:, j] = np.linspace(-3, 3, 60)
            assert (sign * np.diff(trees.probability(grid)) >= -1e-12).all()
    assert ((trees.probability(x) > 0.5) == (y > 0.5)).mean() > 0.8


def test_flattened_walk_equals_recursion():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    t = Q.grow(x, y, (0, 0, 0, 0), n_trees=10)

    def walk(node, row):
        while t.left[node] != node:
            node = t.left[node] if row[t.feature[node]] <= t.threshold[node] else t.right[node]
        return t.value[node]

    want = [t.bias + sum(walk(r, row) for r in t.roots) for row in x]
    assert np.allclose(t.probability(x), 1 / (1 + np.exp(-np.array(want))))
