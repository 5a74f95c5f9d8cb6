"""Dimension-sharded Lloyd: k-means in whole numbers, dimensions cut over tasks.

Vectors are cut twice: into blocks of rows and into shards of ``SHARD`` dimensions. A task
that holds one (row block, shard) piece needs only the shard's slice of every
centroid and gives the exact partial squared distances of its rows. The partial
matrices of a row block are added by key, the least sum names the cluster, and
each shard then sums its own columns by cluster and updates its own slice. No
task and no driver holds whole centroids; sums per cluster are partial
aggregates of tasks, so a cluster with most of the rows is no hot key.

Components become integers floor(scale * x), so all sums and distances are
exact and no order of addition matters. Starting centroids are the vectors of
smallest sha256 of "<seed>:<vec_id>".

Defined cases: an embedding that is NULL, of another length than ``dims``, or with a NULL or
non-finite component is not kept and gives no row; a NULL vec_id hashes as the
empty text; equal ids start in the order of their components; equal distances go to
the smaller cluster; a cluster without vectors keeps its centroid and gives no row;
repeated rows each count and each give a row; fewer kept vectors than k give that
many centroids; an empty table gives no rows; an integer component of ``LIMIT``
or more in size raises an error (a distance could leave 64 bits); only vec_id and
embedding are read, other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twintally.llm.common import even_partitions, staged

K = 40
ROUNDS = 5
SEED = 2
DIMS = 64
SCALE = 256
#: dimensions of a shard, and vectors of a row block
SHARD = 16
BLOCK_ROWS = 2048
#: size from which an integer component is refused: dims * (2 * LIMIT) ** 2 must fit in 63 bits
LIMIT = 1 << 27
#: centroid slices above so many bytes (k * dims * 8) meet the blocks through a salted shuffle, not a broadcast
BROADCAST_BYTES = 32 << 20


def whole(embedding, dims: int):
    """Whether an embedding is kept: ``dims`` components, all there and finite (NaN sorts above infinity)."""
    return F.coalesce((F.size(embedding) == dims)
                      & F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def row_blocks(kept: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(block, shard, x, ids): one row per row block and shard; x holds little-endian int32, row after row.

    Only shard 0 carries the ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                vectors = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), dims)
                x = np.floor(scale * vectors)
                if np.abs(x).max(initial=0) >= LIMIT:
                    raise OverflowError(f"a component of {np.abs(x).max():.0f} is beyond whole-number distances of 64 bits")
                shards = range(-(-dims // SHARD))
                data = [np.ascontiguousarray(x[:, s * SHARD:(s + 1) * SHARD], "<i4").tobytes() for s in shards]
                ids = [part.column(0).to_pylist(), *[None] * (len(shards) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(shards), pa.int64()), pa.array(list(shards), pa.int32()),
                     pa.array(data, pa.binary()), pa.array(ids, pa.list_(pa.int64()))], ["block", "shard", "x", "ids"])
                block += 1
    return kept.mapInArrow(run, "block long, shard int, x binary, ids array<long>")


def first_slices(kept: DataFrame, k: int, dims: int, scale: int, seed: int) -> DataFrame:
    """(shard, cluster, c): the starting centroids in slices; cluster numbers follow the hash order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = kept.withColumn("h", order).orderBy("h", "embedding").limit(k)
    numbered = chosen.select((F.row_number().over(W.orderBy("h", "embedding")) - 1).alias("cluster"),
                             F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"))
    shards = F.explode(F.sequence(F.lit(0), F.lit(-(-dims // SHARD) - 1))).alias("shard")
    return numbered.select("cluster", "v", shards).select(
        "shard", "cluster", F.slice("v", F.col("shard") * SHARD + 1, F.lit(SHARD)).alias("c"))


def with_slices(blocks: DataFrame, slices: DataFrame, k: int, dims: int) -> DataFrame:
    """Each block beside its shard's slice ``c``: the clusters' components, one after another."""
    per_shard = slices.groupBy("shard").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("cluster", "c"))), lambda s: s["c"])).alias("c"))      # k entries a shard
    if 8 * k * dims <= BROADCAST_BYTES:
        return blocks.join(F.broadcast(per_shard), "shard")
    salts = even_partitions(blocks.sparkSession)
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    return blocks.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts).cast("long"))).join(
        per_shard.withColumn("salt", salt), ["shard", "salt"])


def partial_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows to whole-number centroids."""
    size = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * size * size < 1 << 53 else np.int64     # doubles are exact below 2 ** 53
    a, b = x.astype(kind), c.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def _partials(k: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, shard, x, c in _pieces(batches, "block", "shard", "x", "c"):
            width = min(SHARD, dims - shard * SHARD)
            d = partial_distances(np.frombuffer(x, "<i4").reshape(-1, width), np.array(c, np.int64).reshape(k, width))
            small = d.max(initial=0) < 1 << 32
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([4 if small else 8], pa.int32()),
                 pa.array([d.astype("<u4" if small else "<i8").tobytes()], pa.binary())], ["block", "bytes", "d"])
    return run


def _nearest(k: int):
    def run(group: pa.Table) -> pa.Table:            # the shards of one row block
        total: np.ndarray | int = 0
        for size, d in zip(group["bytes"].to_pylist(), group["d"].to_pylist(), strict=True):
            total = total + np.frombuffer(d, "<u4" if size == 4 else "<i8").reshape(-1, k).astype(np.int64)
        cluster = total.argmin(1)                    # the first of equal ones: the smaller number
        far = np.take_along_axis(total, cluster[:, None], 1)[:, 0]
        return pa.table({"block": group["block"][:1], "cluster": pa.array([cluster.astype("<i4").tobytes()], pa.binary()),
                         "distance": pa.array([far.astype("<i8").tobytes()], pa.binary())})
    return run


def assign(blocks: DataFrame, slices: DataFrame, k: int, dims: int) -> DataFrame:
    """(block, cluster, distance): the nearest centroid of every row of a block, as packed numbers."""
    partial = with_slices(blocks.select("block", "shard", "x"), slices, k, dims).select("block", "shard", "x", "c").mapInArrow(
        _partials(k, dims), "block long, bytes int, d binary")
    return partial.groupBy("block").applyInArrow(_nearest(k), "block long, cluster binary, distance binary")


def _sums(k: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        count: dict[int, np.ndarray] = {}
        for shard, x, cluster in _pieces(batches, "shard", "x", "cluster"):
            width = min(SHARD, dims - shard * SHARD)
            if shard not in total:
                total[shard], count[shard] = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
            at = np.frombuffer(cluster, "<i4")
            np.add.at(total[shard], at, np.frombuffer(x, "<i4").reshape(-1, width))
            count[shard] += np.bincount(at, minlength=k)
        for shard, s in total.items():
            some = np.flatnonzero(count[shard])
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(some), pa.int32()), pa.array(some, pa.int32()),
                 pa.array(count[shard][some], pa.int64()), pa.array(s[some].tolist(), pa.list_(pa.int64()))],
                ["shard", "cluster", "n", "s"])
    return run


def updated(blocks: DataFrame, assigned: DataFrame, slices: DataFrame, k: int, dims: int) -> DataFrame:
    """New slices: floor(sum / count) of every component; empty clusters keep theirs."""
    parts = blocks.select("block", "shard", "x").join(assigned.select("block", "cluster"), "block").select(
        "shard", "x", "cluster").mapInArrow(_sums(k, dims), "shard int, cluster int, n long, s array<long>")
    total = parts.groupBy("shard", "cluster").agg(
        F.sum("n").alias("n"), *(F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(SHARD)))
    means = F.array(*(F.expr(f"(s{i} - pmod(s{i}, n)) div n") for i in range(SHARD)))     # floor, also below zero
    return slices.join(total, ["shard", "cluster"], "left").select(
        "shard", "cluster", F.when(F.col("n").isNull(), F.col("c")).otherwise(F.slice(means, F.lit(1), F.size("c"))).alias("c"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, cluster, distance in _pieces(batches, "ids", "cluster", "distance"):
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.frombuffer(cluster, "<i4"), pa.int32()),
             pa.array(np.frombuffer(distance, "<i8"), pa.int64())], ["vec_id", "cluster", "distance"])


def lloyd(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS,
          scale: int = SCALE) -> tuple[DataFrame, DataFrame]:
    """(assignments, slices): (vec_id, cluster, distance) of every kept vector, and the final
    centroids as (shard, cluster, c)."""
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    kept = kept.where(whole(F.col("embedding"), dims))
    blocks = staged(row_blocks(kept, dims, scale), "lloyd-blocks")
    slices = staged(first_slices(kept, k, dims, scale, seed), "lloyd-slices")
    k = slices.where("shard = 0").count()
    for _ in range(rounds if k else 0):
        slices = staged(updated(blocks, assign(blocks, slices, k, dims), slices, k, dims), "lloyd-slices")
    ids = blocks.where("shard = 0").select("block", "ids")
    found = assign(blocks, slices, k, dims).join(ids, "block").mapInArrow(_rows, "vec_id long, cluster int, distance long")
    return staged(found, "lloyd-found"), slices


def cluster_report(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS,
                   scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    found, slices = lloyd(vectors, k, rounds, seed, dims, scale)
    whole_centroid = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("shard", "c"))), lambda s: s["c"]))
    digest = slices.groupBy("cluster").agg(whole_centroid.alias("c")).select(
        "cluster", F.sha2(F.concat_ws(",", F.transform("c", lambda x: x.cast("string"))), 256).alias("centroid_sha256"))
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    about = digest.join(inertia, "cluster").withColumn("inertia", F.sum("cluster_inertia").over(W.partitionBy()))
    # one row a cluster, and k bounds it
    return found.join(F.broadcast(about) if k <= 100_000 else about, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
