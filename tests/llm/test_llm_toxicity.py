import random
import zlib

import numpy as np
from llm_frames import docs_frame
from pyspark.sql import functions as F
from twintally.llm import toxicity_knn as T

BAD = ["idiot", "scumbag", "moronic"]


def corpus(n=400):
    rnd = random.Random(4)
    rows, toxic = [], {}
    for i in range(n):
        words = [f"word{rnd.randint(0, 300)}" for _ in range(40)]
        toxic[i] = int(i % 4 == 0)
        if toxic[i]:
            words[5:5] = [rnd.choice(BAD) + rnd.choice(["", "s", "!"]) for _ in range(3)]
        rows.append((i, " ".join(words), "s"))
    return rows, toxic


def test_held_out_accuracy_and_defined_cases(spark):
    rows, toxic = corpus()
    more = [(9000, None, "s"), (9001, "", "s"), (9002, "IDIOT scumbag moronic " * 4000, "s"), (9003, "plain", "s"), (9003, "plain", "s"),
            (None, "nothing here", "s")]
    docs = docs_frame(spark, rows + more, "terms counts score y")
    labels = spark.createDataFrame(list(toxic.items()) + [(1, None), (None, 1)], "doc_id long, toxic int")
    model, counts = T.fit_toxicity(docs, labels.where(~T.held_out(F.col("doc_id"))))
    got = T.toxicity_scores(counts, model).collect()
    assert len(got) == len(rows) + len(more)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in got}
    assert by[9002].predicted == 1 and by[9000].predicted == by[9001].predicted == by[9003].predicted == 0
    assert by[9002].evidence and not by[9000].evidence
    learnt = {int(e.doc_id) for r in got for e in r.evidence}
    assert not any(zlib.crc32(str(i).encode()) % 3 == 1 for i in learnt)


def test_nearest_is_exact():
    rng = np.random.default_rng(8)
    idf = rng.uniform(1, 6, 40)
    rows = []
    for _ in range(700):
        t = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        rows.append((t, rng.integers(1, 4, len(t)).astype(float)))
    index = T.BlockMaxIndex(list(range(700)), np.zeros(700), idf, rows, rest=3.0, k=9)
    dense = np.zeros((700, 41))
    for i, (t, w) in enumerate(index.rows):
        dense[i, t] = w
    for i in range(0, 700, 35):
        t, w = index.rows[i]
        q = np.zeros(41)
        q[t] = w
        sims = np.round(dense @ q, 12)
        want = sorted(((-s, j) for j, s in enumerate(sims) if j != i))[:9]
        got = index.nearest(t, w, skip=i)
        assert [j for _, j in got] == [j for _, j in want] and np.allclose([s for s, _ in got], [-s for s, _ in want])


def test_nothing_to_learn(spark):
    docs = docs_frame(spark, [(1, "a text", "s"), (2, None, "s")])
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for lab, rate in ((labels, 0.0), (labels.limit(0), 0.0), (labels.withColumn("toxic", F.lit(1)), 1.0)):
        model, counts = T.fit_toxicity(docs, lab)
        assert {r.score for r in T.toxicity_scores(counts, model).collect()} == {rate}
    model, counts = T.fit_toxicity(docs.limit(0), labels)
    assert T.toxicity_scores(counts, model).count() == 0


def test_calibration_rises():
    rng = np.random.default_rng(3)
    votes = rng.random(500)
    steps, rates = T.monotone(votes, (rng.random(500) < votes ** 2).astype(int))
    assert (np.diff(steps) > 0).all() and (np.diff(rates) >= 0).all() and rates.min() >= 0 and rates.max() <= 1
