"""Near-duplicate vectors by an epsilon grid order join: exact cosine links without all pairs.

Unit vectors with cosine >= t lie at most eps = sqrt(2 - 2t) apart. Their first ``AXES``
coordinates on principal axes are cut into cells of side eps, and the vectors of a label are
sorted by cell: the epsilon grid order. Runs of the sorted sequence are units; a unit has a
box (over these coordinates and the length of what they leave over) and a ball (over all dimensions).
Units form intervals of ``FAN``, these again, and so on. Pairs of
intervals are joined recursively from the whole sequence down: a pair whose boxes are
further apart than eps is skipped, a pair whose balls lie within eps as a whole is counted
without opening it, every other one opens into pairs of its parts. Unit pairs that stay
open go on in the same way inside a task, down to ``LEAF`` rows, where cosines are taken.

Links are counted, not listed: a task gives a count per vector and one edge per
vector towards the least vector that it reaches there; components come from these edges.
Equal vectors of a label are one entry with a number of copies.

Defined cases: a vector with a NULL label, and one that is NULL, empty, zero or has a NULL or non-finite
component, links with nothing and is its own component; vectors of different lengths never link;
repeated rows (also of one id) are vectors of their own and link with each other; a NULL
vec_id gives way to any id of its component (kept is then false) and names one of NULL ids alone;
an empty table gives no rows; only vec_id, embedding and label are read, other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintally.llm.common import even_partitions, staged
from twintally.llm.components import components

THRESHOLD = 0.93
#: leading principal axes of the grid
AXES = 8
#: numbers of a unit (rows x dimensions); rows of a unit at least and at most; rows of a leaf
UNIT_NUMBERS = 1 << 18
UNIT_ROWS = (128, 8192)
LEAF = 256
#: parts of an interval, as a power of two
FAN_BITS = 5
#: the principal axes are fitted to about so many numbers (vectors chosen by their key hash);
#: any axes give the same result
SAMPLE_NUMBERS = 1 << 18
#: room for rounding: bounds decide only this far from eps, cosines decide between
ROOM = 1e-9

FAR, OPEN, NEAR = 0, 1, 2

_KEYED = "rid long, vec_id long, grp string, dim int, code binary, x binary"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row id, group (label and length), content key and packed doubles; no group for vectors that link with nothing."""
    rid = TaskContext.get().partitionId() << 36
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("rid", "vec_id", "grp", "dim", "code", "x")}
        vectors = batch.column(2)
        flat = vectors.flatten()
        values, here = flat.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0, np.asarray(flat.is_valid())
        size = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        end = np.cumsum(size)
        for i, (vec_id, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            v, there = values[end[i] - size[i]:end[i]], here[end[i] - size[i]:end[i]]
            good = label is not None and len(v) > 0 and there.all() and np.isfinite(v).all() and v.any()
            out["rid"].append(rid)
            rid += 1
            out["vec_id"].append(vec_id)
            out["grp"].append(f"{len(v)}:{label}" if good else None)
            out["dim"].append(len(v) if good else None)
            data = v.tobytes() if good else None
            out["code"].append(blake2b(data, digest_size=16).digest() if good else None)
            out["x"].append(data)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["rid"], pa.int64()), pa.array(out["vec_id"], pa.int64()), pa.array(out["grp"], pa.string()),
             pa.array(out["dim"], pa.int32()), pa.array(out["code"], pa.binary()), pa.array(out["x"], pa.binary())], list(out))


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a power of two first, so that no square leaves the range of doubles."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def principal_axes(entries: DataFrame) -> tuple[int, np.ndarray]:
    """(dimensions, axes): principal axes of the commonest vector length, from a bounded sample."""
    common = entries.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return 0, np.zeros((0, 0))
    dim = common["dim"]
    most = max(2, SAMPLE_NUMBERS // dim)
    share = F.conv(F.hex(F.substring("code", 1, 4)), 16, 10).cast("long") < int(min(1.0, 1.5 * most / common["count"]) * 2 ** 32)
    rows = entries.where((F.col("dim") == dim) & share).select("x").limit(most).collect()
    if not rows:
        return dim, np.eye(dim)[:, :AXES]
    u = unit_vectors(np.frombuffer(b"".join(r["x"] for r in rows)).reshape(-1, dim))
    _, _, axes = np.linalg.svd(u - u.mean(0), full_matrices=False)
    return dim, axes[:AXES].T.copy()


def coordinates(u: np.ndarray, dim: int, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the axes (the first dimensions, for vectors of another length) and the length of the rest."""
    y = u @ axes if u.shape[1] == dim else u[:, :AXES]
    rest = np.sqrt(np.maximum(0.0, (u * u).sum(1) - (y * y).sum(1)))
    return np.concatenate([y, rest[:, None]], 1)


class Shape:
    """Box and ball around some vectors."""

    __slots__ = ("low", "high", "centre", "radius", "rows")

    def __init__(self, low, high, centre, radius, rows):
        self.low, self.high, self.centre, self.radius, self.rows = low, high, centre, radius, rows

    @classmethod
    def of(cls, u: np.ndarray, y: np.ndarray) -> Shape:
        centre = u.mean(0)
        return cls(y.min(0), y.max(0), centre, float(np.sqrt(((u - centre) ** 2).sum(1).max())), len(u))

    @classmethod
    def around(cls, parts: list[Shape]) -> Shape:
        rows = sum(p.rows for p in parts)
        centre = sum(p.centre * (p.rows / rows) for p in parts)
        radius = max(float(np.sqrt(((p.centre - centre) ** 2).sum())) + p.radius for p in parts)
        return cls(np.min([p.low for p in parts], 0), np.max([p.high for p in parts], 0), centre, radius, rows)


def relation(a: Shape, b: Shape, eps: float) -> int:
    """FAR: no pair is linked. NEAR: every pair is. OPEN: unknown."""
    gap = np.maximum(0.0, np.maximum(a.low - b.high, b.low - a.high))
    if (gap * gap).sum() > eps * eps + ROOM:
        return FAR
    return NEAR if np.sqrt(((a.centre - b.centre) ** 2).sum()) + a.radius + b.radius < eps - ROOM else OPEN


def _packed(a) -> bytes:
    return np.ascontiguousarray(a, np.float64).tobytes()


def _shape(low, high, centre, radius, rows) -> Shape:
    return Shape(np.frombuffer(low), np.frombuffer(high), np.frombuffer(centre), radius, rows)


_SHAPE = "low binary, high binary, centre binary, radius double, n long"
_UNIT = f"grp string, part int, unit long, dim int, {_SHAPE}, copies long, hub long, rids binary, counts binary, xs binary"


def _units(dim: int, axes: np.ndarray):
    """Runs of the sorted sequence, cut where the group changes or a unit is full."""
    def pack(part: int, unit: int, grp: str, size: int, rows: list[tuple]) -> tuple:
        rids = np.array([r[0] for r in rows], np.int64)
        counts = np.array([r[1] for r in rows], np.int64)
        xs = b"".join(r[2] for r in rows)
        u = unit_vectors(np.frombuffer(xs).reshape(-1, size))
        s = Shape.of(u, coordinates(u, dim, axes))
        x = np.frombuffer(xs)
        with np.errstate(over="ignore"):
            single = x.astype(np.float32)
        xs = single.tobytes() if (single.astype(np.float64) == x).all() else xs      # floats travel as floats
        return (grp, part, unit, size, _packed(s.low), _packed(s.high), _packed(s.centre), s.radius, len(rows),
                int(counts.sum()), int(rids.min()), rids.tobytes(), counts.tobytes(), xs)

    names = [f.split()[0] for f in _UNIT.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.int64(),
             pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def batch_of(row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, unit, held, grp, size = TaskContext.get().partitionId(), 0, [], None, 0
        for batch in batches:
            for g, d, rid, copies, x in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist()
                                              for n in ("grp", "dim", "rid", "copies", "x")), strict=True):
                if held and (g != grp or len(held) >= min(max(UNIT_NUMBERS // size, UNIT_ROWS[0]), UNIT_ROWS[1])):
                    yield batch_of(pack(part, unit, grp, size, held))
                    unit, held = unit + 1, []
                grp, size = g, d
                held.append((rid, copies, x))
        if held:
            yield batch_of(pack(part, unit, grp, size, held))
    return run


def _cells(dim: int, axes: np.ndarray, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [None] * len(batch)
            sizes, xs = batch.column(batch.schema.get_field_index("dim")).to_pylist(), batch.column(
                batch.schema.get_field_index("x")).to_pylist()
            for d in set(sizes):
                at = [i for i, s in enumerate(sizes) if s == d]
                u = unit_vectors(np.frombuffer(b"".join(xs[i] for i in at)).reshape(-1, d))
                for i, c in zip(at, np.floor(coordinates(u, dim, axes)[:, :-1] / eps).astype(np.int32).tolist(), strict=True):
                    cells[i] = c
            yield batch.append_column("cell", pa.array(cells, pa.list_(pa.int32())))
    return run


def grid_units(entries: DataFrame, dim: int, axes: np.ndarray, eps: float) -> DataFrame:
    """The entries (rid, grp, dim, copies, x) in epsilon grid order, packed into units numbered along the sequence."""
    n = even_partitions(entries.sparkSession)
    celled = entries.mapInArrow(_cells(dim, axes, eps), "rid long, grp string, dim int, copies long, x binary, cell array<int>")
    ordered = celled.repartitionByRange(n, "grp", "cell", "rid").sortWithinPartitions("grp", "cell", "rid")
    units = staged(ordered.mapInArrow(_units(dim, axes), _UNIT), "grid-units")
    bits = int(units.agg(F.max("unit")).first()[0] or 0).bit_length()
    return units.withColumn("node", F.call_function("shiftleft", F.col("part").cast("long"), F.lit(bits)) + F.col("unit"))


def _merged(group: pa.Table) -> pa.Table:
    """One interval from its parts, ``1 << FAN_BITS`` at most."""
    s = Shape.around([_shape(*r) for r in zip(*(group[n].to_pylist() for n in ("low", "high", "centre", "radius", "n")), strict=True)])
    return pa.table({"grp": group["grp"][:1], "node": group["up"][:1], "copies": [sum(group["copies"].to_pylist())],
                     "hub": [min(group["hub"].to_pylist())], "low": [_packed(s.low)], "high": [_packed(s.high)],
                     "centre": [_packed(s.centre)], "radius": [s.radius], "n": [s.rows]})


_NODE = f"grp string, node long, copies long, hub long, {_SHAPE}"


def _up(node, levels: int = 1):
    return F.call_function("shiftright", node, F.lit(FAN_BITS * levels))


def intervals(units: DataFrame) -> list[DataFrame]:
    """Interval tables by level: the units, then parts merged by ``FAN_BITS`` of their number, up to one interval a group."""
    levels = [units.select(*(f.split()[0] for f in _NODE.split(", ")))]
    top = levels[0].agg(F.max("node")).first()[0]
    while top:
        up = levels[-1].withColumn("up", _up(F.col("node"))).groupBy("grp", "up").applyInArrow(_merged, _NODE)
        levels.append(staged(up, "grid-intervals"))
        top >>= FAN_BITS
    return levels


def _related(eps: float):
    names = ("low", "high", "centre", "radius", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            rel = [relation(_shape(*(col[n + "_a"][i] for n in names)), _shape(*(col[n + "_b"][i] for n in names)), eps)
                   for i in range(len(batch))]
            keep = [i for i, r in enumerate(rel) if r != FAR]
            out = batch.select(["grp", "a", "b", "copies_a", "hub_a", "copies_b", "hub_b"]).take(pa.array(keep, pa.int64()))
            yield out.append_column("rel", pa.array([rel[i] for i in keep], pa.int32()))
    return run


def interval_pairs(levels: list[DataFrame], eps: float) -> tuple[DataFrame, list[DataFrame]]:
    """(open unit pairs, near pairs of each level): the sequence joined with itself, from one interval a group down.

    Pairs have grp, a <= b. A pair opens into pairs of its parts, ``4 ** FAN_BITS`` at most.
    """
    def side(level: DataFrame, s: str) -> DataFrame:
        return level.select(F.col("grp").alias("g" + s), _up(F.col("node")).alias("up" + s), F.col("node").alias(s),
                            *(F.col(n).alias(f"{n}_{s}") for n in level.columns if n not in ("grp", "node")))

    schema = "grp string, a long, b long, copies_a long, hub_a long, copies_b long, hub_b long, rel int"
    opened, near = None, []
    for level in reversed(levels):
        a, b = side(level, "a"), side(level, "b")
        if opened is None:                              # the whole sequence of a group: one interval
            both = a.join(b, F.col("ga") == F.col("gb"))
        else:
            both = opened.join(a, (F.col("grp") == F.col("ga")) & (F.col("pa") == F.col("upa")))
            both = both.join(b, (F.col("ga") == F.col("gb")) & (F.col("pb") == F.col("upb")) & (F.col("a") <= F.col("b")))
        both = both.withColumn("grp", F.col("ga")).drop("ga", "gb", "upa", "upb", "pa", "pb")
        found = staged(both.mapInArrow(_related(eps), schema), "grid-pairs")
        near.append(found.where(F.col("rel") == NEAR))
        opened = found.where(F.col("rel") == OPEN).select("grp", F.col("a").alias("pa"), F.col("b").alias("pb"))
    return opened.withColumnsRenamed({"pa": "a", "pb": "b"}), near[::-1]


class Forest:
    """Union-find over rows; joins take whole blocks of links at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, at: np.ndarray) -> np.ndarray:
        root = self.up[at]
        while (self.up[root] != root).any():
            root = self.up[root]
        self.up[at] = root
        return root

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs a[i], b[i]; the smaller root stays."""
        while len(a):
            a, b = self.find(a), self.find(b)
            different = a != b
            low, high = np.minimum(a, b)[different], np.maximum(a, b)[different]
            np.minimum.at(self.up, high, low)      # one parent for each; the rest of its pairs come again
            a, b = low, high

    def links(self, rows: np.ndarray, cols: np.ndarray, linked: np.ndarray) -> None:
        """The components of a block of links, found in the block, then united."""
        a, b = self.find(rows), self.find(cols)
        none = len(self.up)
        while True:
            x = np.minimum(a, np.where(linked, b[None, :], none).min(1))
            y = np.minimum(b, np.where(linked, x[:, None], none).min(0))
            self.unite(np.concatenate([a, b]), np.concatenate([x, y]))
            if (x == a).all() and (y == b).all():
                return
            a, b = x, y


class Run:
    """A unit in memory, with the shapes of its halves, quarters, ... down to leaves."""

    def __init__(self, x: np.ndarray, dim: int, axes: np.ndarray, counts: np.ndarray, offset: int):
        self.u, self.counts, self.at = unit_vectors(x), counts, offset + np.arange(len(x))
        self.y = coordinates(self.u, dim, axes)
        self.linked = np.zeros(len(x), np.int64)         # copies of the vectors linked with each row
        self.shapes: dict[tuple[int, int], Shape] = {}

    def shape(self, lo: int, hi: int) -> Shape:
        if (lo, hi) not in self.shapes:
            mid = self.middle(lo, hi)
            self.shapes[lo, hi] = (Shape.of(self.u[lo:hi], self.y[lo:hi]) if hi - lo <= LEAF
                                   else Shape.around([self.shape(lo, mid), self.shape(mid, hi)]))
        return self.shapes[lo, hi]

    @staticmethod
    def middle(lo: int, hi: int) -> int:
        leaves = -(-(hi - lo) // LEAF)
        return lo + LEAF * (leaves // 2)


def join_runs(p: Run, q: Run, threshold: float, forest: Forest) -> None:
    """Adds the links between two runs (or of a run with itself, p is q) to ``linked`` and ``forest``."""
    eps = float(np.sqrt(2 - 2 * threshold))

    def visit(a0: int, a1: int, b0: int, b1: int) -> None:
        same = p is q and a0 == b0
        state = relation(p.shape(a0, a1), q.shape(b0, b1), eps)
        if state == FAR:
            return
        if state == NEAR:
            p.linked[a0:a1] += q.counts[b0:b1].sum()
            if not same:
                q.linked[b0:b1] += p.counts[a0:a1].sum()
            forest.unite(p.at[a0:a1], np.full(a1 - a0, q.at[b0]))
            forest.unite(q.at[b0:b1], np.full(b1 - b0, p.at[a0]))
        elif a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            linked = p.u[a0:a1] @ q.u[b0:b1].T >= threshold
            if same:
                np.fill_diagonal(linked, True)
            if linked.any():
                p.linked[a0:a1] += linked @ q.counts[b0:b1]
                if not same:
                    q.linked[b0:b1] += p.counts[a0:a1] @ linked
                if not same or linked.sum() > len(linked):
                    forest.links(p.at[a0:a1], q.at[b0:b1], linked)
        elif same:
            mid = Run.middle(a0, a1)
            visit(a0, mid, a0, mid)
            visit(a0, mid, mid, a1)
            visit(mid, a1, mid, a1)
        elif a1 - a0 >= b1 - b0:
            mid = Run.middle(a0, a1)
            visit(a0, mid, b0, b1)
            visit(mid, a1, b0, b1)
        else:
            mid = Run.middle(b0, b1)
            visit(a0, a1, b0, mid)
            visit(a0, a1, mid, b1)

    visit(0, len(p.u), 0, len(q.u))


_FOUND = "rid long, linked long, root long"


def _unit_pair(dim: int, axes: np.ndarray, threshold: float):
    """Links between the units of a pair (one row: a unit with itself)."""
    def run(group: pa.Table) -> pa.Table:
        runs, rids, offset = [], [], 0
        for size, n, r, c, x in zip(*(group[k].to_pylist() for k in ("dim", "n", "rids", "counts", "xs")), strict=True):
            x = np.frombuffer(x, np.float32 if len(x) == 4 * size * n else np.float64).astype(np.float64).reshape(n, size)
            runs.append(Run(x, dim, axes, np.frombuffer(c, np.int64), offset))
            rids.append(np.frombuffer(r, np.int64))
            offset += n
        forest = Forest(offset)
        join_runs(runs[0], runs[-1], threshold, forest)
        rid = np.concatenate(rids)
        linked = np.concatenate([r.linked for r in runs])
        if len(runs) == 1:
            linked = linked - runs[0].counts              # a vector's own copies are added at the end
        some = np.flatnonzero(linked)
        return pa.table({"rid": pa.array(rid[some]), "linked": pa.array(linked[some]),
                         "root": pa.array(rid[forest.find(np.arange(offset))[some]])})
    return run


def _open_links(units: DataFrame, pairs: DataFrame, dim: int, axes: np.ndarray, threshold: float) -> DataFrame:
    sides = pairs.select("grp", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
    data = units.select("grp", "node", "dim", "n", "rids", "counts", "xs")
    return sides.join(data, ["grp", "node"]).groupBy("grp", "a", "b").applyInArrow(_unit_pair(dim, axes, threshold), _FOUND)


def _near_links(units: DataFrame, near: list[DataFrame]) -> DataFrame | None:
    """Counts and edges of pairs that are linked as a whole: sums by interval, handed down to the rows of its units.

    The rows of an interval hang on its least row (they meet in the partner interval), and least rows on each other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rids, counts, plus, with_self, hub in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rid, own = np.frombuffer(rids, np.int64), np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid), pa.array(plus - own * with_self), pa.array(np.full(len(rid), hub))], ["rid", "linked", "root"])

    out = None
    for level, pairs in enumerate(near):
        if pairs.isEmpty():
            continue
        same = (F.col("a") == F.col("b")).cast("long")
        ends = pairs.select("grp", F.col("a").alias("node"), F.col("copies_b").alias("plus"), same.alias("with_self"), F.col("hub_a").alias("hub"))
        ends = ends.union(pairs.where("a <> b").select("grp", "b", "copies_a", F.lit(0).cast("long"), "hub_b"))
        sums = ends.groupBy("grp", "node").agg(F.sum("plus").alias("plus"), F.sum("with_self").alias("with_self"), F.min("hub").alias("hub"))
        down = units.select("grp", _up(F.col("node"), level).alias("node"), "rids", "counts").join(sums, ["grp", "node"])
        down = down.select("rids", "counts", "plus", "with_self", "hub").mapInArrow(run, _FOUND)
        across = pairs.where("a <> b").select(F.col("hub_a").alias("rid"), F.lit(0).cast("long").alias("linked"), F.col("hub_b").alias("root"))
        both = down.union(across)
        out = both if out is None else out.union(both)
    return out


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    eps = float(np.sqrt(2 - 2 * threshold))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    rows = staged(rows.mapInArrow(_keyed, _KEYED), "grid-rows")
    classes = staged(rows.where("code is not null").groupBy("grp", "code").agg(
        F.min("rid").alias("first"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "grid-classes")
    entries = staged(rows.where("code is not null").select("rid", "grp", "dim", "code", "x").join(
        classes.select(F.col("first").alias("rid"), "copies"), "rid"), "grid-entries")
    dim, axes = principal_axes(entries)
    units = grid_units(entries.select("rid", "grp", "dim", "copies", "x"), dim, axes, eps)
    pairs, near = interval_pairs(intervals(units), eps)
    found = _open_links(units, pairs, dim, axes, threshold)
    whole = _near_links(units, near)
    found = staged(found if whole is None else found.union(whole), "grid-links")
    linked = found.groupBy("rid").agg(F.sum("linked").alias("linked"))
    root = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "first")
    known = classes.join(root, "first", "left").join(linked.withColumnRenamed("rid", "first"), "first", "left")
    known = staged(known.select("grp", "code", "least", F.coalesce("root", "first").alias("root"),
                                (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "grid-known")
    component = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(component, "root").select("grp", "code", "n_links", "component_id", F.lit(True).alias("valid"))
    # rows without a key spread over tasks by their row id; they meet no class
    spread = F.coalesce("code", F.col("rid").cast("string").cast("binary"))
    out = rows.select("vec_id", F.coalesce("grp", F.lit("")).alias("grp"), spread.alias("code")).join(named, ["grp", "code"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
