"""Conversation prefix trie with subtree totals by a depth-band rollup.

Every conversation is rebuilt from the head of its base conversation and its own tail. A node
of the trie is a distinct sequence of turns from the start. Sequences are named by a
prefix sum over turn hashes (a polynomial modulo the prime 2 ** 127 - 1 over 127 bits of sha256), so turns are
sorted once by range and a conversation may lie over many tasks: each task sums its own
run, and one row a task carries the sums over the cuts.

A node belongs to its smallest member. A conversation then owns one stretch of its path,
from some depth to its end, and hangs on the node above. Totals rise in bands of ``BAND`` depths:

1. nodes explode to their ancestors inside their band only: the nodes of one stretch are
   summed from below first, and the sum goes to each of the fewer than ``BAND`` band ancestors of other owners;
2. band roots, with what their band holds, form a trie of one ``BAND``-th of the depth, which is
   rolled up in the same way, until one band is left: the totals of its nodes are complete;
3. going back, completed band-root totals are added to the nodes of the band above them.

So there are 2 * log_BAND(depth) rounds, and a row explodes to fewer than ``BAND`` rows in each.

Defined cases: rows of NULL conv_id belong to no conversation; a NULL turn comes first; equal turns
of a conversation are ordered by a hash of role and text, and repeated rows are turns of
their own; a NULL role or text is empty; conversations without rebuilt turns are
members of the root alone; ``c - c % base`` of a negative id rounds towards zero; an empty table (or one of
NULL ids) gives no rows, not even a root; only conv_id, turn, role and text are read, other columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twintally.llm.common import even_partitions, staged, word_count

#: depths of a band
BAND = 16
#: conversations that share a base, and the most turns taken from it
BASE = 20
HEAD = 3
#: ids of a node's end list that are joined into one piece of text
PIECE = 1 << 14
PRIME = (1 << 127) - 1
#: a fixed multiplier without structure
STEP = int.from_bytes(hashlib.sha256(b"prefix sum").digest()[:15], "big")
BACK = [pow(pow(STEP, -1, PRIME), i, PRIME) for i in range(HEAD + 1)]
NOTHING = bytes(16)


def _number(b: bytes | None) -> int:
    return int.from_bytes(b, "big") if b else 0


def _bytes(n: int) -> bytes:
    return n.to_bytes(16, "big")


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def _prefix_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and prefix sum of each turn within the task's run of its conversation."""
    part, conv, pos, total, power = TaskContext.get().partitionId(), None, 0, 0, 1
    for batch in batches:
        positions, sums = [], []
        for c, h in zip(*_columns(batch, "conv_id", "h"), strict=True):
            if c != conv:
                conv, pos, total, power = c, 0, 0, 1
            pos, power = pos + 1, power * STEP % PRIME
            total = (total + _number(h) * power) % PRIME
            positions.append(pos)
            sums.append(_bytes(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(batch), pa.int32()), batch.column(batch.schema.get_field_index("conv_id")),
             pa.array(positions, pa.int64()), pa.array(sums, pa.binary()), batch.column(batch.schema.get_field_index("words"))],
            ["part", "conv_id", "pos", "s", "words"])


def _carried(before: dict[int, tuple[int, int, int]]):
    """Adds what earlier tasks hold of a conversation; ``before`` has one entry a task at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, convs, positions, sums = _columns(batch, "part", "conv_id", "pos", "s")
            for i, (part, conv) in enumerate(zip(parts, convs, strict=True)):
                cut = before.get(part)
                if cut is not None and cut[0] == conv:
                    sums[i] = _bytes((cut[2] + pow(STEP, cut[1], PRIME) * _number(sums[i])) % PRIME)
                    positions[i] += cut[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(convs, pa.int64()), pa.array(positions, pa.int64()), pa.array(sums, pa.binary()),
                 batch.column(batch.schema.get_field_index("words"))], ["conv_id", "pos", "s", "words"])
    return run


def positioned(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, s, words): every turn with its position from 1, prefix sum and number of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("h"),
        word_count(text).alias("words"), F.monotonically_increasing_id().alias("r"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("h"), F.col("r")]
    runs = turns.repartitionByRange(even_partitions(conversations.sparkSession), *order).sortWithinPartitions(*order).mapInArrow(
        _prefix_sums, "part int, conv_id long, pos long, s binary, words long")
    runs = staged(runs, "trie-runs")
    # the last row of each task: one row a task, whatever the number of turns
    ends = runs.groupBy("part").agg(F.max(F.struct("conv_id", "pos", "s")).alias("e")).orderBy("part").collect()
    before, held = {}, None
    for r in ends:
        if held is not None:
            before[r["part"]] = held
        conv, pos, s = r["e"]["conv_id"], r["e"]["pos"], _number(r["e"]["s"])
        if held is not None and held[0] == conv:
            pos, s = held[1] + pos, (held[2] + pow(STEP, held[1], PRIME) * s) % PRIME
        held = (conv, pos, s)
    return runs.mapInArrow(_carried(before), "conv_id long, pos long, s binary, words long")


def _plans(turns: DataFrame) -> DataFrame:
    """Per conversation: how many turns come from its base, their sums and words, and its rebuilt length."""
    size = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    at = [F.max(F.when(F.col("pos") == i, F.col("s"))) for i in range(1, HEAD + 1)]
    words = [F.max(F.when(F.col("pos") == i, F.col("words"))) for i in range(1, HEAD + 1)]
    heads = turns.where(F.col("pos") <= HEAD).groupBy("conv_id").agg(
        F.array(*at).alias("hs"), F.array(*words).alias("hw"), F.max("pos").alias("hn"))
    base = heads.select(F.col("conv_id").alias("base"), F.col("hs").alias("bs"), F.col("hw").alias("bw"), F.col("hn").alias("bn"))
    own = size.join(heads, "conv_id").withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("long"))
    taken = F.least(F.col("h"), F.coalesce("bn", F.lit(0)))
    return own.join(base, "base", "left").select(
        "conv_id", "h", taken.alias("taken"), F.get("hs", (F.least("h", "n") - 1).cast("int")).alias("skipped"), "bs", "bw",
        F.get("bs", (taken - 1).cast("int")).alias("head"), (taken + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("len"))


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth and prefix sum of the turns that a conversation keeps of its own."""
    for batch in batches:
        pos, s, h, taken, skipped, head = _columns(batch, "pos", "s", "h", "taken", "skipped", "head")
        depth = [p - a + b for p, a, b in zip(pos, h, taken, strict=True)]
        sums = [_bytes((_number(o) + (_number(x) - _number(k)) * BACK[a - b]) % PRIME)
                for x, k, o, a, b in zip(s, skipped, head, h, taken, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("conv_id")), pa.array(depth, pa.int64()), pa.array(sums, pa.binary()),
             batch.column(batch.schema.get_field_index("words"))], ["conv_id", "depth", "p", "words"])


def rebuilt_paths(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, depth, p, words): every prefix of every rebuilt conversation; the root has depth 0."""
    schema = "conv_id long, depth long, p binary, words long"
    zero = F.lit(0).cast("long")
    root = plans.select("conv_id", zero.alias("depth"), F.lit(NOTHING).alias("p"), zero.alias("words"))
    head = plans.where("taken > 0").select("conv_id", "bs", "bw", F.explode(F.sequence(F.lit(1).cast("long"), "taken")).alias("depth"))
    i = (F.col("depth") - 1).cast("int")
    head = head.select("conv_id", "depth", F.get("bs", i).alias("p"), F.get("bw", i).alias("words"))
    tail = turns.join(plans.select("conv_id", "h", "taken", "skipped", "head"), "conv_id").where("pos > h").mapInArrow(_rebuilt, schema)
    return root.union(head).union(tail)


def _unit(level: int) -> int:
    return BAND ** level


def _first(level: int):
    """The first step, in units of a level, that a conversation owns."""
    return F.ceil(F.col("d0") / _unit(level)).cast("long") if level else F.col("d0")


def _lookups(paths: DataFrame, owners: DataFrame, nodes: DataFrame, root: int, levels: int) -> DataFrame:
    """(conv_id, level, m, owner): who owns the ancestors in the band above a stretch, in units of each level;
    level -1 names the end node of a conversation that owns none."""
    wanted = []
    for level in range(levels):
        j, unit = _first(level), _unit(level)
        m = F.floor(F.col("depth") / unit).cast("long")
        above = (F.col("depth") % unit == 0) & (m < j) & (m >= F.floor((j - 1) / BAND) * BAND) & (j * unit <= F.col("len"))
        wanted.append(F.when(above, F.lit(level)))
    wanted.append(F.when(F.col("d0").isNull() & (F.col("depth") == F.col("len")), F.lit(-1)))
    asked = paths.select("conv_id", "depth", "p").join(owners, "conv_id").select(
        "conv_id", "depth", "p", F.explode(F.filter(F.array(*wanted), lambda x: x.isNotNull())).alias("level"))
    shared = nodes.where("n_convs > 1 and depth > 0").select("depth", "p", F.col("conv_id").alias("owner"))
    m = F.floor(F.col("depth") / F.pow(F.lit(float(BAND)), F.greatest("level", F.lit(0)))).cast("long")
    below = asked.where("depth > 0").join(shared, ["depth", "p"]).select("conv_id", "level", m.alias("m"), "owner", "depth")
    return below.union(asked.where("depth = 0").select("conv_id", "level", F.lit(0).cast("long"), F.lit(root).cast("long"), "depth"))


_VALUES = ("leaves", "saved")


def _summed(rows: DataFrame) -> DataFrame:
    """Values added per node; rows handed over by others know no d0."""
    return rows.groupBy("conv_id", "m").agg(F.max("d0").alias("d0"), *(F.sum(v).alias(v) for v in _VALUES))


def _rise(nodes: DataFrame, above: DataFrame, level: int) -> DataFrame:
    """Totals inside bands: sums from below along a stretch, and the whole of it to the band ancestors of other owners."""
    below = W.partitionBy("conv_id", F.floor(F.col("m") / BAND)).orderBy(F.col("m").desc()).rowsBetween(W.unboundedPreceding, 0)
    sums = nodes.select("conv_id", "m", "d0", *(F.sum(v).over(below).alias(v) for v in _VALUES))
    tops = sums.where((F.col("m") == _first(level)) & (F.col("m") % BAND != 0)).drop("m", "d0")
    over = above.where(F.col("level") == level).join(tops, "conv_id").select(
        F.col("owner").alias("conv_id"), "m", F.lit(None).cast("long").alias("d0"), *_VALUES)
    # without an own first node at m there is nothing to hand over, and slots of an earlier band are not in this one
    return _summed(sums.union(over))


def _return(inner: DataFrame, done: DataFrame, above: DataFrame, level: int) -> DataFrame:
    """Adds completed totals of the band roots one level up to the nodes of the band over them."""
    roots = done.where("m > 0 and d0 is not null").withColumn("first", _first(level)).withColumn("lo", (F.col("m") - 1) * BAND)
    own = roots.withColumn("lo", F.greatest("first", "lo")).where(F.col("lo") < F.col("m") * BAND).select(
        "conv_id", F.explode(F.sequence(F.col("lo"), F.col("m") * BAND - 1)).alias("m"), F.lit(None).cast("long").alias("d0"), *_VALUES)
    tops = roots.where(F.col("m") == _first(level + 1)).select("conv_id", *_VALUES)
    other = above.where(F.col("level") == level).join(tops, "conv_id").select(
        F.col("owner").alias("conv_id"), "m", F.lit(None).cast("long").alias("d0"), *_VALUES)
    return _summed(inner.union(own).union(other))


def rollup(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Subtree totals of every node. ``nodes``: (conv_id, m, d0, leaves, saved) at depth m."""
    inner = []
    for level in range(levels):
        inner.append(staged(_rise(nodes, above, level), "trie-band"))
        nodes = inner[-1].where(F.col("m") % BAND == 0).withColumn("m", F.floor(F.col("m") / BAND).cast("long"))
    done = inner[-1]
    for level in reversed(range(levels - 1)):
        done = staged(_return(inner[level], done, above, level), "trie-total")
    return done


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, depth, member) rows as comma-joined pieces of ``PIECE`` members at most."""
    node, held = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([held[0]], pa.int64()),
             pa.array([",".join(map(str, held))], pa.string())], ["conv_id", "depth", "first", "ids"])

    for batch in batches:
        out = []
        for c, d, member in zip(*_columns(batch, "conv_id", "depth", "member"), strict=True):
            if held and ((c, d) != node or len(held) == PIECE):
                out.append(piece())
                held = []
            node = (c, d)
            held.append(member)
        yield from out and [pa.Table.from_batches(out).combine_chunks().to_batches()[0]]
    if held:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as one digest a node; a node of any size streams through in its order."""
    node, digest = None, None
    for batch in batches:
        out: list[tuple] = []
        for c, d, ids in zip(*_columns(batch, "conv_id", "depth", "ids"), strict=True):
            if (c, d) != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (c, d), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _digests(out)
    if node:
        yield _digests([(*node, digest.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    c, d, x = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(x, pa.string())],
                                      ["conv_id", "depth", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which members end. ``ends``: (conv_id, depth, member).

    Members are joined in sorted ranges first, so a node at which most conversations end is many tasks' work;
    only the hash itself, which no two tasks can share, runs over its joined pieces in one stream.
    """
    n = even_partitions(ends.sparkSession)
    pieces = ends.repartitionByRange(n, "conv_id", "depth", "member").sortWithinPartitions("conv_id", "depth", "member").mapInArrow(
        _joined, "conv_id long, depth long, first long, ids string")
    return pieces.repartition(n, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").mapInArrow(
        _hashed, "conv_id long, depth long, ends_sha256 string")


_RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
           "ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    turns = positioned(conversations)
    plans = staged(_plans(turns), "trie-plans")
    root, longest = plans.agg(F.min("conv_id"), F.max("len")).first()
    if root is None:
        return spark.createDataFrame([], _RESULT)
    levels = 1
    while BAND ** levels <= longest:
        levels += 1
    paths = staged(rebuilt_paths(turns, plans), "trie-paths")
    nodes = staged(paths.groupBy("depth", "p").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words")), "trie-nodes")
    first = nodes.groupBy("conv_id").agg(F.min("depth").alias("d0"))
    owners = staged(plans.select("conv_id", "len").join(first, "conv_id", "left"), "trie-owners")
    above = staged(_lookups(paths, owners, nodes, root, levels), "trie-above")

    # where each stretch hangs, and how many hang on a node
    hangs = above.where("level = 0").join(owners.select("conv_id", "d0"), "conv_id").where("m = d0 - 1").select(
        "conv_id", F.col("owner").alias("hangs_on"), "m")
    hung = hangs.groupBy(F.col("hangs_on").alias("conv_id"), F.col("m").alias("depth")).agg(F.count("*").alias("hung"))
    stretch = owners.where("d0 is not null").join(hangs.drop("m"), "conv_id", "left")
    more = (F.col("depth") < F.col("len")).cast("long")
    known = nodes.drop("p").join(stretch, "conv_id").join(hung, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "d0", "n_convs", (F.coalesce("hung", F.lit(0)) + more).alias("n_children"),
        F.when(F.col("depth") > F.col("d0"), F.col("conv_id")).otherwise(F.col("hangs_on")).alias("parent_conv_id"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    known = staged(known, "trie-known")
    leaf = (F.col("n_children") == 0).cast("long")
    totals = rollup(known.select("conv_id", F.col("depth").alias("m"), "d0", leaf.alias("leaves"), "saved"), above, levels)

    ends = owners.where("d0 is not null").select("conv_id", F.col("len").alias("depth"), F.col("conv_id").alias("member"))
    ends = ends.union(above.where("level = -1").select("owner", "depth", "conv_id"))
    totals = totals.select("conv_id", F.col("m").alias("depth"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return (known.drop("d0", "saved").join(totals, ["conv_id", "depth"]).join(end_digests(ends), ["conv_id", "depth"], "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
            .select(*(c.split()[0] for c in _RESULT.split(", "))))
