import numpy as np

from twintally.llm import grid_join as G

VECTORS = "vec_id long, embedding array<double>, label string"


def plain(rows, threshold=G.THRESHOLD):
    """(vec_id, n_links, component_id, kept) of every row, from all pairs."""
    def good(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    units = [G.unit_vectors(np.array([v]))[0] if good(v, label) else None for _, v, label in rows]
    near = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None
             and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and units[i] @ units[j] >= threshold]
            for i in range(len(rows))]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return sorted(out, key=str)


def found(spark, rows, threshold=G.THRESHOLD):
    frame = spark.createDataFrame(rows, VECTORS)
    return sorted((tuple(r) for r in G.near_duplicates(frame, threshold).collect()), key=str)


def clustered(rng, n, dim, centres, noise, labels=("a", "b")):
    c = rng.normal(size=(centres, dim))
    x = c[rng.integers(centres, size=n)] + noise * rng.normal(size=(n, dim))
    return [(i, x[i].tolist(), labels[i % len(labels)]) for i in range(n)]


def test_clusters_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(G, "UNIT_NUMBERS", 1)
    monkeypatch.setattr(G, "UNIT_ROWS", (20, 20))
    monkeypatch.setattr(G, "FAN_BITS", 1)
    rng = np.random.default_rng(3)
    rows = clustered(rng, 260, 12, 14, 0.25)
    rows += [(1000 + i, rows[0][1], "a") for i in range(60)]                         # copies of one vector
    rows += [(1100 + i, (np.array(rows[1][1]) * (i + 1)).tolist(), "b") for i in range(5)]   # scaled ones
    rows += [(0, rows[0][1], "a"), (None, rows[0][1], "a"), (None, [9.0] * 12, "a"), (2000, None, "a"), (2001, [], "a"),
             (2002, [0.0] * 12, "a"), (2003, [1.0] * 11 + [None], "a"), (2004, [float("nan")] * 12, "a"),
             (2005, [float("inf")] + [1.0] * 11, "a"), (2006, rows[0][1], None), (2007, rows[0][1], None),
             (2008, rows[0][1][:5], "a"), (2009, rows[0][1][:5], "a"), (2010, [1e300] * 12, "a"), (2011, [1e-300] * 12, "a"),
             (2012, [-0.0] * 11 + [1.0], "a"), (2013, [0.0] * 11 + [1.0], "a")]
    assert found(spark, rows) == plain(rows)


def test_a_tight_ball_is_counted_without_opening_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(G, "UNIT_NUMBERS", 1)
    monkeypatch.setattr(G, "UNIT_ROWS", (16, 16))
    monkeypatch.setattr(G, "FAN_BITS", 2)
    rng = np.random.default_rng(4)
    rows = clustered(rng, 200, 8, 1, 0.001, ("x",)) + [(500 + i, v, "x") for i, (_, v, _) in enumerate(clustered(rng, 80, 8, 40, 0.01))]
    handed = []
    near_links = G._near_links
    monkeypatch.setattr(G, "_near_links", lambda units, near: handed.extend(p.count() for p in near) or near_links(units, near))
    assert found(spark, rows) == plain(rows)
    assert sum(handed) > 0 and len(handed) > 1 and sum(handed[1:]) > 0        # also whole intervals, not only units


def test_chains_and_thresholds(spark):
    angles = [(i, [float(np.cos(i * 0.05)), float(np.sin(i * 0.05))], "a") for i in range(60)]
    for threshold in (0.93, 0.999):
        assert found(spark, angles, threshold) == plain(angles, threshold)


def test_recursion_inside_a_unit_pair(monkeypatch):
    monkeypatch.setattr(G, "LEAF", 7)
    rng = np.random.default_rng(5)
    x = np.array([v for _, v, _ in sorted(clustered(rng, 150, 6, 9, 0.3), key=lambda r: r[1])])
    counts = rng.integers(1, 4, 150)
    axes = np.eye(6)[:, :3]
    runs = [G.Run(x[:90], 6, axes, counts[:90], 0), G.Run(x[90:], 6, axes, counts[90:], 90)]
    forest = G.Forest(150)
    for p, q in ((runs[0], runs[0]), (runs[0], runs[1]), (runs[1], runs[1])):
        G.join_runs(p, q, G.THRESHOLD, forest)
    u = G.unit_vectors(x)
    linked = u @ u.T >= G.THRESHOLD
    np.fill_diagonal(linked, True)
    assert (np.concatenate([r.linked for r in runs]) == linked @ counts).all()
    least = np.arange(150)
    while (new := np.where(linked, least[None, :], 999).min(1)).tolist() != least.tolist():
        least = new
    assert forest.find(np.arange(150)).tolist() == least.tolist()


def test_bounds_never_hide_or_invent_a_link():
    rng = np.random.default_rng(6)
    eps = float(np.sqrt(2 - 2 * G.THRESHOLD))
    seen = set()
    for _ in range(300):
        x = rng.normal(size=(12, 5)) * rng.choice([0.02, 0.1, 0.5]) + rng.normal(size=5)
        y = rng.normal(size=(9, 5)) * rng.choice([0.02, 0.1, 0.5]) + (x[0] if rng.random() < 0.5 else rng.normal(size=5))
        u, v = G.unit_vectors(x), G.unit_vectors(y)
        axes = np.linalg.qr(rng.normal(size=(5, 2)))[0]
        state = G.relation(G.Shape.of(u, G.coordinates(u, 5, axes)), G.Shape.of(v, G.coordinates(v, 5, axes)), eps)
        linked = u @ v.T >= G.THRESHOLD
        assert not (state == G.FAR and linked.any()) and not (state == G.NEAR and not linked.all())
        seen.add(state)
    assert seen == {G.FAR, G.OPEN, G.NEAR}


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.1], "a"), (3, [0.0, 1.0], "a")]
    frame = spark.createDataFrame(rows, VECTORS)
    for name in ("rid", "grp", "code", "x", "a.b", "root", "n_links"):
        from pyspark.sql import functions as F
        frame = frame.withColumn(name, F.lit("clash"))
    assert sorted(tuple(r) for r in G.near_duplicates(frame).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    only_bad = spark.createDataFrame([(5, [1.0], None), (None, None, "a")], VECTORS)
    assert sorted((tuple(r) for r in G.near_duplicates(only_bad).collect()), key=str) == [(5, 0, 5, True), (None, 0, None, True)]
