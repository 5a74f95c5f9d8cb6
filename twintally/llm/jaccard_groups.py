r"""Exact n-gram Jaccard join by a token-group matrix.

Words are runs of anything but ``\x20 \x09-\x0D`` with A-Z read as a-z; a
document's set holds its distinct runs of ``N`` words, or its whole word
sequence when that is shorter. Two documents link when
``100 * intersection >= PERCENT * union``. The result is the component of every
document under links, without writing out the links of large groups.

1. Documents of equal sets form a class; one member stands for it.
2. Star links: classes whose sketches agree in a band are compared with one
   leader of the band, exactly. This finds most links cheaply and misses some.
3. Sharing filter, exact: in hash order, linked sets share a known number of
   tokens among their first ones. Tokens are matched in packed buckets, and a
   class goes on only if enough of its first tokens occur in other classes.
4. Token-group matrix: what is left is partitioned into groups of similar
   classes, with the union of each group's tokens. A token table with group
   counts gives the pairs of groups that could hold a link beyond the
   components found so far (a class needs ``PERCENT`` of its tokens elsewhere,
   hence one of its rarest ones). For such a pair, a query's overlap with the
   other group's union bounds its overlap with any member; only when the bound
   reaches what a link needs is the group opened and compared member by member.

No pair of documents is ever a row; group pairs are, and groups hold up to
``GROUP_MEMBERS`` classes. Tokens are 64-bit hashes.

Defined cases: NULL, empty and word-free texts have an empty set, link with
nothing and are their own component; repeated rows are members of one class;
a repeated id with different texts counts with each; a row without an id is a
member of the class of its equals but links with nothing else, and alone has a
NULL component; an empty table gives no rows; extra columns pass through
``keep_one`` and cannot clash, only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from twintally.llm.common import give_back, spare_prefix, staged, text_chunks
from twintally.llm.components import components
from twintally.llm.textops import Chunk, mix64
from twintally.llm.unit_tokens import ranges

N = 5
PERCENT = 75
BANDS, BAND_ROWS = 6, 3
GROUP_MEMBERS = 128
#: tokens of one group, unless a single member has more
GROUP_TOKENS = 100_000
#: tokens of one packed bucket, about
BUCKET_TOKENS = 1_000_000
#: packed buckets at least: so many that a set's shared tokens seldom meet in one, at any size of the input
LEAST_BUCKETS = 512
#: classes whose keys are broadcast to pick their texts; beyond it the texts are joined by shuffle
BROADCAST_CLASSES = 200_000
_U = np.uint64


def token_sets(col: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, edges): the sorted distinct tokens of each document of a chunk, end to end."""
    c = Chunk(col)
    words = c.span_hash(c.starts, c.ends, fold=True)
    grams, at = c.windows(words, n)
    doc = c.word_doc[at]
    short = (c.n_words > 0) & (c.n_words < n)
    if short.any():
        inside = short[c.word_doc]
        d = c.word_doc[inside]
        first = np.searchsorted(c.word_doc, np.arange(c.n_docs))
        place = np.flatnonzero(inside) - first[d]
        total = np.zeros(c.n_docs, _U)
        with np.errstate(over="ignore"):
            np.add.at(total, d, mix64(words[inside] + mix64(place.astype(_U) + _U(77))))
            whole = mix64(total + c.n_words.astype(_U))
        grams, doc = np.concatenate([grams, whole[short]]), np.concatenate([doc, np.flatnonzero(short)])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, np.searchsorted(doc, np.arange(c.n_docs + 1))


def set_keys(tokens: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Two 64-bit keys of each set (rows by document); equal sets have equal keys."""
    out = np.zeros((len(edges) - 1, 2), _U)
    some = edges[1:] > edges[:-1]
    if some.any():
        with np.errstate(over="ignore"):
            out[some, 0] = np.add.reduceat(mix64(tokens ^ _U(0xA5A5A5A5)), edges[:-1][some])
            out[some, 1] = np.add.reduceat(mix64(tokens * _U(0xC2B2AE3D27D4EB4F)), edges[:-1][some])
    return out


def band_keys(tokens: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Keys of the bands of a one-permutation sketch (rows by document)."""
    k = BANDS * BAND_ROWS
    n = len(edges) - 1
    doc = np.repeat(np.arange(n), np.diff(edges))
    value = mix64(tokens + _U(12345))
    none = _U(0xFFFFFFFFFFFFFFFF)
    sketch = np.full(n * k, none, _U)
    np.minimum.at(sketch, doc * k + (value % _U(k)).astype(np.int64), value)
    sketch = sketch.reshape(n, k)
    least = sketch.min(1)
    with np.errstate(over="ignore"):
        # an empty bin says nothing: it takes a value of the whole set
        fill = mix64(least[:, None] + np.arange(k, dtype=_U)[None, :])
        sketch = np.where(sketch == none, fill, sketch).reshape(n, BANDS, BAND_ROWS)
        key = np.zeros((n, BANDS), _U)
        for j in range(BAND_ROWS):
            key = mix64(key * _U(31) + sketch[:, :, j])
        return mix64(key + np.arange(BANDS, dtype=_U))


def needed(s: np.ndarray, t: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Tokens that sets of sizes s and t must share to link."""
    return -(-percent * (s + t) // (100 + percent))


def least_shared(s, percent: int = PERCENT):
    """Tokens of a set of size s that any partner must hold (also the least size of a partner)."""
    return -(-percent * s // 100)


def _levels(s):
    return 1 + s // 4


def first_tokens(s, percent: int = PERCENT):
    """How many tokens of a set, in hash order, the sharing filter looks at."""
    return s - least_shared(s, percent) + _levels(s)


def shared_first(s, percent: int = PERCENT):
    """How many of them occur in the first tokens of any one partner."""
    return _levels(least_shared(s, percent))


def describe(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n, the set's keys k1 and k2, its band keys (staged)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, col in text_chunks(batch, "text"):
                tokens, edges = token_sets(col)
                n, keys = np.diff(edges), set_keys(tokens, edges).view(np.int64)
                bands = band_keys(tokens, edges).view(np.int64)
                at = np.arange(len(n) + 1, dtype=np.int32) * BANDS
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(bands.ravel()))], names=["doc_id", "n", "k1", "k2", "bands"])

    return staged(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, k1 long, k2 long, bands array<long>"), "jac-docs")


def set_classes(described: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: cid, doc (smallest id), n, k1, k2, bands (staged)."""
    some = (described.where("n > 0").groupBy("n", "k1", "k2")
            .agg(F.min("doc_id").alias("doc"), F.first("bands").alias("bands")))
    return staged(some.withColumn("cid", F.monotonically_increasing_id()), "jac-classes")


def sets_of(docs: DataFrame, wanted: DataFrame, broadcast_classes: int = BROADCAST_CLASSES) -> DataFrame:
    """(cid, n, tokens binary) of the classes in ``wanted`` (cid, doc, k1, k2), from their texts."""
    wanted = wanted.select("cid", "doc", "k1", "k2")
    if wanted.count() <= broadcast_classes:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("doc")).select("cid", "k1", "k2", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, col in text_chunks(batch, "text"):
                tokens, edges = token_sets(col)
                keys = set_keys(tokens, edges).view(np.int64)
                own = (keys[:, 0] == np.asarray(rows.column(1))) & (keys[:, 1] == np.asarray(rows.column(2)))
                raw = [tokens[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(edges)), pa.array(raw, pa.binary())],
                                                 names=["cid", "n", "tokens"]).filter(pa.array(own))

    return (texts.mapInArrow(run, "cid long, n long, tokens binary")
            .groupBy("cid").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")))


def star_candidates(classes: DataFrame) -> DataFrame:
    """(a, b): each class with the leader of every band bucket it is in (staged).

    The leader of a bucket is the class whose buckets are the largest in all:
    the text that the others were made from, rather than one of them.
    """
    banded = staged(classes.select("cid", F.explode("bands").alias("band")), "jac-bands")
    counts = banded.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    crowded = staged(banded.join(counts, "band"), "jac-crowded")
    score = crowded.groupBy("cid").agg(F.sum("c").alias("score"))
    leaders = (crowded.join(score, "cid").groupBy("band")
               .agg(F.max_by("cid", F.struct("score", -F.col("cid"))).alias("b")))
    return staged(crowded.join(leaders, "band").where("cid <> b").select(F.col("cid").alias("a"), "b").distinct(), "jac-stars")


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that link, compared token by token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), _U)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), _U)
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = both >= needed(len(x), len(y), percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    one = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def sharing_classes(docs: DataFrame, described: DataFrame, percent: int = PERCENT,
                    bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """k1 of the sets that share enough of their first tokens with other sets, any others.

    A bucket is a packed slice of the token space: 40 more bits of each token,
    sorted, next to the 40-bit tag of its set. Equal tokens meet in one bucket,
    where no pair is formed, only counted. Returns (tag, shared).
    """
    total = described.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // (2 * bucket_tokens)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, col in text_chunks(batch, "text"):
                tokens, edges = token_sets(col)
                n = np.diff(edges)
                tags = set_keys(tokens, edges)[:, 0] >> _U(24)
                take = ranges(edges[:-1], np.minimum(first_tokens(n, percent), n) * (n > 0))
                doc = np.repeat(np.arange(len(n)), n)[take]
                with np.errstate(over="ignore"):
                    spread = tokens[take] * _U(0x9E3779B97F4A7C15)
                bucket = ((spread >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
                low = mix64(spread) & _U((1 << 40) - 1)
                order = np.lexsort((low, bucket))
                bucket, low, tag = bucket[order], low[order], tags[doc[order]]
                cut = np.searchsorted(bucket, np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cut))
                rows = [(_planes(low[a:b]), _planes(tag[a:b])) for a, b in zip(cut[full].tolist(), cut[full + 1].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)), pa.array([r[0] for r in rows], pa.binary()),
                     pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "low", "tag"])

    def count(frame):
        low = np.concatenate([_unplanes(x) for x in frame["low"]])
        tag = np.concatenate([_unplanes(x) for x in frame["tag"]])
        order = np.lexsort((tag, low))
        low, tag = low[order], tag[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (tag[1:] != tag[:-1])
        low, tag = low[new], tag[new]
        same = np.zeros(len(low) + 1, bool)
        same[1:-1] = low[1:] == low[:-1]
        tags, shared = np.unique(tag[same[1:] | same[:-1]], return_counts=True)
        give_back()
        return pd.DataFrame({"tag": tags.astype(np.int64), "shared": shared.astype(np.int64)})

    counts = (docs.select("text").mapInArrow(pack, "bucket int, low binary, tag binary")
              .groupBy("bucket").applyInPandas(count, "tag long, shared long")
              .groupBy("tag").agg(F.sum("shared").alias("shared")))
    return counts


def _planes(x: np.ndarray) -> bytes:
    """40-bit numbers as five byte planes (the high ones of sorted numbers compress well)."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    p = np.frombuffer(raw, np.uint8).reshape(5, -1)
    out = np.zeros((p.shape[1], 8), np.uint8)
    out[:, :5] = p.T
    return out.view("<u8").ravel()


def _tag(k1):
    return F.shiftrightunsigned(k1, 24)


def open_groups(left: dict, right: dict, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Merges (component, component) between two groups of sets, found exactly.

    A group has members' comp, n, and their sorted tokens end to end (tokens,
    edges). A member of the left group is compared with the right one's members
    only if its overlap with their union reaches what a link would need.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = np.argsort(right["tokens"], kind="stable")
    sorted_tokens = right["tokens"][order]
    member = np.repeat(np.arange(len(right["n"])), right["n"])[order]
    union, at = np.unique(sorted_tokens, return_index=True)
    size = np.diff(np.append(at, len(sorted_tokens)))
    place = np.searchsorted(union, left["tokens"])
    place[place == len(union)] = 0
    hit = union[place] == left["tokens"] if len(union) else np.zeros(len(place), bool)
    run = np.zeros(len(hit) + 1, np.int64)
    np.cumsum(hit, out=run[1:])
    bound = run[left["edges"][1:]] - run[left["edges"][:-1]]
    smallest = np.maximum(right["n"].min(), least_shared(left["n"], percent))
    out = []
    for i in np.flatnonzero(bound >= needed(left["n"], smallest, percent)).tolist():
        a, b = left["edges"][i], left["edges"][i + 1]
        own = place[a:b][hit[a:b]]
        both = np.bincount(member[ranges(at[own], size[own])], minlength=len(right["n"]))
        for j in np.flatnonzero(both >= needed(left["n"][i], right["n"], percent)).tolist():
            x, y = find(int(left["comp"][i])), find(int(right["comp"][j]))
            if x != y:
                parent[x] = y
                out.append((int(left["comp"][i]), int(right["comp"][j])))
    return out


def matrix_links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) merges of components that links among ``members`` make, beyond the components.

    ``members``: cid, n, comp, family, tokens binary (staged). Groups are the
    classes of a component, or the single classes of a family, in even chunks.
    """
    family = F.when(F.col("comp_size") > 1, F.struct(F.lit(0).alias("k"), F.col("comp").alias("f"))).otherwise(
        F.struct(F.lit(1).alias("k"), F.col("family").alias("f")))
    keyed = members.withColumn("f", family)
    chunks = keyed.groupBy("f").agg(F.greatest(F.ceil(F.count("*") / GROUP_MEMBERS), F.ceil(F.sum("n") / GROUP_TOKENS))
                                    .alias("chunks"))
    grouped = staged(keyed.join(chunks, "f").withColumn(
        "grp", F.xxhash64("f", F.pmod(F.xxhash64("cid"), F.col("chunks")))).select("cid", "n", "comp", "grp", "tokens"),
        "jac-members")

    def explode_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.asarray(batch.column(1))
            begin = 0
            while begin < len(n):       # about a million tokens at a time
                end = max(begin + 1, int(np.searchsorted(np.cumsum(n[begin:]), 1_000_000)) + begin)
                t = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(4)[begin:end]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t), *[pa.array(np.repeat(np.asarray(batch.column(j))[begin:end], n[begin:end])) for j in range(4)]],
                    names=["token", "cid", "n", "comp", "grp"])
                begin = end

    tokens = staged(grouped.mapInArrow(explode_tokens, "token long, cid long, n long, comp long, grp long"), "jac-tokens")
    known = (tokens.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("df"))
             .where("lo <> hi").select("token", "df"))
    # a class whose tokens occur elsewhere too rarely has no link; else one of its rarest shared tokens is in a partner
    shared = tokens.join(known, "token")
    own = W.partitionBy("cid")
    probes = (shared.withColumn("c", F.count("*").over(own)).withColumn("r", F.row_number().over(own.orderBy("df", "token")))
              .where(F.col("r") <= F.col("c") - F.ceil(F.col("n") * percent / 100) + 1))
    probes = staged(probes.groupBy("token", "grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "jac-probes")
    a, b = probes.alias("a"), probes.alias("b")
    apart = ~((F.col("a.lo") == F.col("a.hi")) & (F.col("b.lo") == F.col("b.hi")) & (F.col("a.lo") == F.col("b.lo")))
    pairs = (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.grp") <= F.col("b.grp")) & apart)
             .select(F.col("a.grp").alias("g"), F.col("b.grp").alias("h")).distinct())

    groups = staged(grouped.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("cid", "comp", "n", "tokens"))).alias("m")),
                    "jac-groups")       # a group's size is bounded by its chunk
    one = groups.select(F.col("grp").alias("g"), F.col("m").alias("x"))
    two = groups.select(F.col("grp").alias("h"), F.col("m").alias("y"))

    def unpack(s) -> dict:
        m = s.values
        n = np.asarray(m.field("n"))
        return {"comp": np.asarray(m.field("comp")), "n": n, "edges": np.append(0, np.cumsum(n)),
                "tokens": np.concatenate([np.frombuffer(x.as_buffer(), _U) for x in m.field("tokens")])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                links = open_groups(unpack(batch.column(0)[i]), unpack(batch.column(1)[i]), percent)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()),
                                                      pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return pairs.join(one, "g").join(two, "h").select("x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id that links reach)."""
    return set_components(docs, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def set_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n, k1, k2 (its set) and component_id."""
    described = describe(docs)
    classes = set_classes(described)
    stars = star_candidates(classes)
    ends = stars.select(F.col("a").alias("cid")).union(stars.select("b")).distinct()
    sets = staged(sets_of(docs, classes.join(ends, "cid")), "jac-ends")
    linked = staged(verify(stars, sets, percent), "jac-links")
    first = staged(components(linked), "jac-first")

    sharing = sharing_classes(docs, described, percent)
    enough = F.col("shared") >= 1 + F.floor(F.ceil(F.col("n") * percent / 100) / 4)
    # the tag of a set may belong to several: then all of them go on
    rest = classes.join(sharing, _tag(F.col("k1")) == F.col("tag")).where(enough).select("cid", "doc", "n", "k1", "k2")
    # a family: the component of the leader that a class was compared with
    led = stars.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("lead"))
    comp = first.select(F.col("node").alias("cid"), F.col("root"))
    lead = first.select(F.col("node").alias("lead"), F.col("root").alias("lead_root"))
    sizes = first.groupBy(F.col("root").alias("r")).agg(F.count("*").alias("size"))
    rest = staged(rest.join(comp, "cid", "left").join(led, "cid", "left").join(lead, "lead", "left")
                  .join(sizes, F.col("root") == F.col("r"), "left")
                  .select("cid", "doc", "k1", "k2", F.coalesce("root", "cid").alias("comp"),
                          F.coalesce("size", F.lit(1)).alias("comp_size"),
                          F.coalesce("lead_root", "lead", "cid").alias("family")), "jac-rest")
    members = staged(sets_of(docs, rest).join(rest.select("cid", "comp", "comp_size", "family"), "cid"), "jac-sets")
    merges = staged(matrix_links(members, percent), "jac-merges")

    roots = components(linked.union(merges))
    named = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "n", "k1", "k2", "doc", F.coalesce("root", "cid").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    ids = named.join(smallest, "root").select(F.col("n").alias("cn"), F.col("k1").alias("c1"), F.col("k2").alias("c2"),
                                              "component_id")
    same = (F.col("n") == F.col("cn")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    return described.join(ids, same, "left").select(
        "doc_id", "n", "k1", "k2", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT, broadcast_ids: int = 5 * BROADCAST_CLASSES) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id; texts without words stay.

    Only the ids to drop travel, by broadcast while they are few (counted
    first), else by a join. Rows without an id, or of an id that several rows
    carry, are told apart by their sets: one row of each id and set can stay.
    """
    j = spare_prefix(docs.columns, "__jac_")

    def few(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= broadcast_ids else ids

    found = staged(set_components(docs, percent), "jac-found")
    drop = staged(found.where("doc_id <> component_id").select(F.col("doc_id").alias(j + "id")).distinct(), "jac-drop")
    shared = staged(found.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1 or doc_id is null")
                    .select(F.col("doc_id").alias(j + "id")), "jac-shared")
    same_id = F.col("doc_id").eqNullSafe(F.col(j + "id"))
    if not shared.take(1):
        return docs.join(few(drop), same_id, "left_anti")
    alone = docs.join(few(shared), same_id, "left_anti").join(few(drop), same_id, "left_anti")
    rest = docs.join(few(shared), same_id, "left_semi")
    numbered = [f"{j}{i}" for i in range(len(docs.columns))]      # names with dots do not pass through mapInArrow
    text = numbered[docs.columns.index("text")]

    def add_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, col in text_chunks(batch, text):
                keys = set_keys(*token_sets(col)).view(np.int64)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())],
                                                 names=[*rows.schema.names, j + "k1", j + "k2"])

    kinds = StructType([*(StructField(n, f.dataType) for n, f in zip(numbered, docs.schema.fields)),
                        StructField(j + "k1", LongType()), StructField(j + "k2", LongType())])
    kept = found.where("doc_id <=> component_id").select(F.col("doc_id").alias(j + "id"), F.col("k1").alias(j + "1"),
                                                         F.col("k2").alias(j + "2")).distinct()
    keyed = rest.toDF(*numbered).mapInArrow(add_keys, kinds).toDF(*docs.columns, j + "k1", j + "k2").join(
        kept, same_id & (F.col(j + "k1") == F.col(j + "1")) & (F.col(j + "k2") == F.col(j + "2")), "left_semi")
    # the columns stand in the same order on both sides, whatever their names
    return alone.union(keyed.dropDuplicates(["doc_id", j + "k1", j + "k2"]).drop(j + "k1", j + "k2"))
