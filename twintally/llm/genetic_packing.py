"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm on islands.

Documents are encoded, an end id is appended, and only documents longer than a
sequence are cut: into whole-sequence pieces, the first of which may be shorter.
Whole pieces fill a sequence each. The other pieces are dealt into shards of
about ``SHARD_ITEMS`` by a hash of their row, and every shard is packed by
``ISLANDS`` populations that evolve apart. A chromosome is a list of sequences,
not of pieces: crossover injects whole well-filled sequences of one parent,
drops the sequences of the other that hold a duplicate, and best-fits the
displaced pieces. After each epoch the elite of each island migrates to the
next one through a shuffle; the best packing of a shard wins.

Defined cases: NULL and empty texts are one end id; rows that repeat an id are
pieces of their own; NULL ids are kept; ties go to the lower island; an empty
table gives no rows; extra columns cannot clash, only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintally.llm.common import staged, text_chunks
from twintally.llm.unit_tokens import tokenizer_for, with_end

SEQUENCE = 2048
SHARD_ITEMS = 8192
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
CHILDREN = 6
#: share of a sequence from which it counts as well filled
WELL_FILLED = 0.995


class Bins:
    """Open sequences, by room left: best fit finds the fullest one that still takes a size."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0          # bit r: a sequence with room r is open

    def add(self, items: list[int], room: int) -> None:
        self.by_room[room].append(items)
        self.rooms |= 1 << room

    def place(self, item: int, size: int) -> None:
        able = self.rooms >> size
        if able:
            room = size + ((able & -able).bit_length() - 1)
            held = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms &= ~(1 << room)
            held.append(item)
            self.add(held, room - size)
        else:
            self.add([item], self.capacity - size)

    def all(self) -> list[tuple[list[int], int]]:
        """(items, room) of every sequence."""
        return [(b, r) for r, bs in enumerate(self.by_room) for b in bs]


def fitness(bins: list[tuple[list[int], int]], capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then the mean squared fill (higher is better on both)."""
    return -len(bins), sum((1 - r / capacity) ** 2 for _, r in bins) / max(1, len(bins))


def best_fit(order: list[int], sizes: list[int], capacity: int, kept: list[tuple[list[int], int]] = ()) -> list:
    bins = Bins(capacity)
    for items, room in kept:
        bins.add(list(items), room)
    for i in order:
        bins.place(i, sizes[i])
    return bins.all()


def crossover(a: list, b: list, sizes: list[int], capacity: int, rng: np.random.Generator) -> list:
    """Inject a random share of b's well-filled sequences into a."""
    limit = int(capacity * (1 - WELL_FILLED))
    good = [x for x in b if x[1] <= limit] or [min(b, key=lambda x: x[1])]
    take = [good[i] for i in np.flatnonzero(rng.random(len(good)) < rng.uniform(0.2, 0.8))]
    inside = {i for items, _ in take for i in items}
    kept, displaced = list(take), []
    for items, room in a:
        if inside.isdisjoint(items):
            kept.append((items, room))
        else:
            displaced += [i for i in items if i not in inside]
    return refill(kept, displaced, sizes, capacity)


def mutate(a: list, sizes: list[int], capacity: int, rng: np.random.Generator) -> list:
    """Empty the least filled sequences and a few random ones, and best-fit their pieces again."""
    order = sorted(range(len(a)), key=lambda i: -a[i][1])
    gone = set(order[:max(2, len(a) // 50)]) | set(rng.integers(0, len(a), max(2, len(a) // 20)).tolist())
    return refill([x for i, x in enumerate(a) if i not in gone], [i for g in gone for i in a[g][0]], sizes, capacity)


def refill(kept: list, displaced: list[int], sizes: list[int], capacity: int) -> list:
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, capacity, kept)


def evolve(sizes: list[int], capacity: int, rng: np.random.Generator, elites: list[list],
           population: int = POPULATION, children: int = CHILDREN) -> list:
    """One epoch of one island; the best packing met."""
    if not sizes:
        return []
    down = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    people = list(elites) or [best_fit(down, sizes, capacity)]
    floor = -(-sum(sizes) // capacity)
    while len(people) < population:
        # nearly descending: sizes blurred by chance
        blur = np.array(sizes) * rng.uniform(0.8, 1.2, len(sizes))
        people.append(best_fit(np.argsort(-blur, kind="stable").tolist(), sizes, capacity))
    score = [fitness(p, capacity) for p in people]
    for _ in range(children):
        if -max(score)[0] <= floor:
            break
        i, j = rng.permutation(len(people))[:2]
        a, b = (i, j) if score[i] <= score[j] else (j, i)
        child = crossover(people[a], people[b], sizes, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, sizes, capacity, rng)
        s, worst = fitness(child, capacity), min(range(len(people)), key=score.__getitem__)
        if s > score[worst]:
            people[worst], score[worst] = child, s
    return people[max(range(len(people)), key=score.__getitem__)]


_PLACED = "shard long, island int, uid long, size int, bin int, place int, n_bins long, fill double"


def _island(capacity: int, epoch: int, seed: int, **knobs):
    def run(key, frame):
        shard, island = int(key[0]), int(key[1])
        first = frame["elite"].min()
        own = frame[frame["elite"] == first].sort_values("uid", kind="stable")
        uids, sizes = own["uid"].to_numpy(), own["size"].to_numpy().astype(int).tolist()
        elites = []
        if epoch:
            for _, e in frame.groupby("elite", sort=True):
                e = e.sort_values("uid", kind="stable")
                groups: dict[int, list[int]] = {}
                for i, b in enumerate(e["bin"].tolist()):
                    groups.setdefault(b, []).append(i)
                elites.append([(g, capacity - sum(sizes[i] for i in g)) for g in groups.values()])
        best = evolve(sizes, capacity, np.random.default_rng([seed, epoch, shard, island]), elites, **knobs)
        where, place = np.zeros(len(uids), np.int32), np.zeros(len(uids), np.int32)
        for b, (items, _) in enumerate(best):
            run_ = 0
            for i in sorted(items, key=lambda i: (-sizes[i], uids[i])):
                where[i], place[i] = b, run_
                run_ += sizes[i]
        n, fill = fitness(best, capacity)
        return pd.DataFrame({"shard": shard, "island": island, "uid": uids, "size": np.array(sizes, np.int32),
                             "bin": where, "place": place, "n_bins": -n, "fill": fill})
    return run


def pack(items: DataFrame, capacity: int = SEQUENCE, shard_items: int = SHARD_ITEMS, islands: int = ISLANDS,
         epochs: int = EPOCHS, seed: int = 7, **knobs) -> DataFrame:
    """(uid, sequence_id, offset) of items (uid long, unique; size int, 1..capacity).

    Items of the full size never enter a shard; the others are spread evenly, so
    no group grows with the input: their number does.
    """
    open_ = items.where(F.col("size") < capacity)
    shards = max(1, -(-open_.count() // shard_items))
    rows = (open_.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))
            .withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
            .select("shard", "island", "uid", F.col("size").cast("int").alias("size"), F.lit(0).alias("bin"),
                    F.lit(0).alias("elite")))
    for epoch in range(epochs):
        placed = staged(rows.groupBy("shard", "island").applyInPandas(_island(capacity, epoch, seed, **knobs), _PLACED),
                        "pack-epoch")
        # an island's elite stays and also migrates to the next island
        rows = placed.select("shard", F.explode(F.array(F.col("island"), (F.col("island") + 1) % islands)).alias("to"),
                             "uid", "size", "bin", F.col("island").alias("elite")).withColumnRenamed("to", "island")
    best = (placed.groupBy("shard").agg(F.min_by("island", F.struct("n_bins", -F.col("fill"), "island")).alias("won")))
    won = placed.join(best, "shard").where(F.col("island") == F.col("won"))
    packed = won.select("uid", (F.col("shard") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"),
                        F.col("place").cast("long").alias("offset"))
    whole = items.where(F.col("size") >= capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"),
                                                          F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, mode: str = "spaced",
                 capacity: int = SEQUENCE) -> DataFrame:
    """Per piece: uid, doc_id, piece, start, length, ids_crc32 (staged; the only pass over the texts)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_for(tokenizer_path, mode)
        for batch in batches:
            for rows, col in text_chunks(batch, "text"):
                ids, n = with_end(*coder.encode(col), end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                short = (n - (pieces - 1) * capacity)[doc]        # the first piece takes what is over
                start = np.where(piece == 0, 0, short + (piece - 1) * capacity)
                length = np.where(piece == 0, short, capacity)
                base = (np.cumsum(n) - n)[doc] + start
                crc = [zlib.crc32(raw[4 * b:4 * e]) for b, e in zip(base.tolist(), (base + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    pieces = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    return staged(pieces.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, mode: str = "spaced",
                   capacity: int = SEQUENCE, **knobs) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer_path, end_id, mode, capacity)
    places = pack(pieces.select("uid", F.col("length").cast("int").alias("size")), capacity, **knobs)
    return pieces.join(places, "uid").drop("uid")
