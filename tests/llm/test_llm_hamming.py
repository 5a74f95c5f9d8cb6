import numpy as np
from pyspark.sql import functions as F

from twintally.llm.hamming_search import SegmentTables, hamming_topk, sign_code


def plain(codes, queries, k):
    codes = sorted({(i, c) for i, c in codes if i is not None and c is not None})
    out = set()
    for q, c in {(i, c) for i, c in queries if i is not None and c is not None}:
        best, seen = [], set()
        for d, i in sorted((bin((c ^ x) & (2**64 - 1)).count("1"), i) for i, x in codes):
            if i != q and i not in seen:
                seen.add(i)
                best.append((d, i))
        out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(best[:k])}
    return out


def rows(frame):
    return {(r.query_id, r.rank, r.neighbour_id, r.distance) for r in frame.collect()}


def test_matches_brute_force_with_ties_and_copies(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-2**63, 2**63 - 1, 40)
    codes = [(i, int(base[rng.integers(40)] ^ (1 << int(rng.integers(0, 62))))) for i in range(600)]
    codes += [(1000 + i, int(base[0])) for i in range(50)] + [(None, 5), (7000, None)]
    frame = spark.createDataFrame(codes, "id long, code long")
    queries = frame.where("id % 20 = 0")
    for k in (1, 7):
        assert rows(hamming_topk(frame, queries, k)) == plain(codes, [c for c in codes if c[0] is not None and c[0] % 20 == 0], k)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    from twintally.llm import hamming_search as H
    rng = np.random.default_rng(6)
    codes = [(i, int(rng.integers(-2**63, 2**63 - 1))) for i in range(300)]
    frame = spark.createDataFrame(codes, "id long, code long")
    monkeypatch.setattr(H, "INDEX_BLOCK", 70)
    monkeypatch.setattr(H, "LEAST_QUERIES", 4)
    assert rows(hamming_topk(frame, frame.where("id % 20 = 0"), 10)) == plain(codes, [c for c in codes if c[0] % 20 == 0], 10)


def test_segment_search_is_exact_for_odd_widths():
    rng = np.random.default_rng(7)
    codes = np.unique(rng.integers(0, 2**37, 500).astype(np.uint64))
    t = SegmentTables(codes, 37)
    for q in codes[:20]:
        entry, d = t.search(q, 5)
        want = np.bitwise_count(codes ^ q).astype(int)
        kth = np.sort(want)[4]
        assert sorted(entry.tolist()) == np.flatnonzero(want <= kth).tolist()
        assert (want[entry] == d).all()


def test_empty_few_and_odd_embeddings(spark):
    empty = spark.createDataFrame([], "id long, code long")
    assert hamming_topk(empty, empty).count() == 0
    few = spark.createDataFrame([(0, 1), (20, 3)], "id long, code long")
    assert rows(hamming_topk(few, few)) == {(0, 1, 20, 1), (20, 1, 0, 1)}
    e = spark.createDataFrame([(1, [0.5, -1.0, float("nan"), None]), (2, [1.0]), (3, None)], "id long, embedding array<double>")
    got = {r.id: r.c for r in e.select("id", sign_code(F.col("embedding"), 4).alias("c")).collect()}
    assert got == {1: 1, 2: None, 3: None}
