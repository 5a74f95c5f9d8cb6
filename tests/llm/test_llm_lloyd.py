import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from twintally.llm import sharded_lloyd as L

VECTORS = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, seed=2, dims=64, scale=256):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) rows in Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    x = [[int(np.floor(scale * np.float64(c))) for c in v] for _, v in kept]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    first = sorted(range(len(x)), key=lambda r: (name(kept[r][0]), kept[r][1]))[:k]
    centroids = [list(x[r]) for r in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds if centroids else 0):
        at = [nearest(v)[1] for v in x]
        for n in range(len(centroids)):
            mine = [v for v, a in zip(x, at) if a == n]
            if mine:
                centroids[n] = [sum(c) // len(mine) for c in zip(*mine)]
    best = [nearest(v) for v in x]
    per = {n: sum(d for d, m in best if m == n) for _, n in best}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, per[n], sum(per.values()), sha[n]) for (i, _), (d, n) in zip(kept, best)), key=str)


def found(spark, rows, **more):
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    return sorted((tuple(r) for r in L.cluster_report(frame, **more).collect()), key=str)


@pytest.mark.parametrize("dims", [5, 16, 37])
def test_rounds_equal_a_plain_version(spark, monkeypatch, dims):
    monkeypatch.setattr(L, "BLOCK_ROWS", 17)
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(150, dims))
    rows = [(i, x[i].tolist()) for i in range(150)] + [(500 + i, x[0].tolist()) for i in range(60)]
    assert found(spark, rows, k=7, rounds=4, dims=dims) == plain(rows, 7, 4, dims=dims)


def test_slices_meet_blocks_without_a_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=20).tolist()) for i in range(80)]
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(L, "BLOCK_ROWS", 9)
    assert found(spark, rows, k=5, rounds=2, dims=20) == plain(rows, 5, 2, dims=20)


def test_ties_empty_clusters_and_odd_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [-1.0, 0.0]), (5, [0.5, None]), (6, None), (7, [1.0]),
            (8, [float("nan"), 0.0]), (9, [float("-inf"), 0.0]), (None, [0.25, -0.25]), (3, [1.0, 0.0]), (3, [-3.0, 2.0]), (10, [])]
    for k in (1, 3, 20):
        got = found(spark, rows, k=k, rounds=3, dims=2)
        assert got == plain(rows, k, 3, dims=2)
    # equal starting centroids: the smaller number takes all, the others stay empty
    same = [(i, [0.5, 0.5]) for i in range(6)]
    assert {r[1] for r in found(spark, same, k=3, rounds=2, dims=2)} == {0}


def test_sums_below_zero_round_down(spark):
    rows = [(i, [-0.01 * i, 0.003 * i]) for i in range(11)]
    assert found(spark, rows, k=2, rounds=5, dims=2) == plain(rows, 2, 5, dims=2)


def test_partial_distances_are_exact_at_both_sizes():
    rng = np.random.default_rng(2)
    for size in (1 << 10, (1 << 27) - 1):
        x, c = rng.integers(-size, size, (9, 16)), rng.integers(-size, size, (4, 16))
        x[0], c[0] = size, -size
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
        assert L.partial_distances(x, c).tolist() == want


def test_empty_tables_clashing_columns_and_refused_sizes(spark):
    assert found(spark, [], dims=2) == []
    assert found(spark, [(1, None)], dims=2) == []
    frame = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.25, 0.0])], VECTORS)
    for name in ("block", "shard", "x", "ids", "cluster", "h", "a.b"):
        frame = frame.withColumn(name, F.lit("clash"))
    got = sorted((tuple(r) for r in L.cluster_report(frame, k=1, rounds=1, dims=2).collect()), key=str)
    assert got == plain([(1, [0.5, 1.0]), (2, [0.25, 0.0])], 1, 1, dims=2)
    with pytest.raises(Exception, match="beyond whole-number distances"):
        found(spark, [(1, [1e9, 0.0])], dims=2)
