"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Every document is taken a whole number of times. A source whose target is ``f``
times its size plus a remainder takes each document ``f`` times, and once more
those whose id hash lies under the source's threshold. The threshold is found
without sorting: sum tokens by (source, hash bucket), find the bucket in which
the running total crosses the remainder, and refine only that bucket by the
next bits of the hash, until it holds one hash value.

Defined cases: NULL text has size 0; a NULL source is a source of its own,
ranked last; NULL ids hash as the empty text; rows that repeat an id share its
hash and are taken together; an empty table gives no rows; extra columns pass
through, whatever their names (working columns carry a reserved prefix).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twintally.llm.common import id_hash, spare_prefix, staged, word_count

#: weights of the sources in rank order, repeating
WEIGHTS = (3, 1, 2)
#: share of all sizes that the mix takes
TOTAL_SHARE = 1.5
#: a target stops at this many times its source's size
MAX_REPEATS = 2
HASH_BITS = 60
BUCKET_BITS = 12
P = "__mix_"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources rank by code point with NULL last. Ranks come from a range
    partitioning plus the counts of the partitions before, so no task sees all
    sources. Targets share the total by weight; each round caps the sources
    above their limit and reshares the rest, one aggregate a round.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    null_last = F.col("source").isNull()
    dealt = staged(per.repartitionByRange(null_last, F.col("source")).withColumn("pid", F.spark_partition_id()),
                   "mix-sources")
    before = (dealt.groupBy("pid").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)))
              .select("pid", F.coalesce("before", F.lit(0)).alias("before")))
    in_part = W.partitionBy("pid").orderBy(null_last, "source")
    rank = F.col("before") + F.row_number().over(in_part) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = staged(dealt.join(before, "pid").select(
        "source", "source_size", weight.cast("long").alias("weight"),
        (F.col("source_size") * max_repeats).alias("cap")), "mix-ranked")

    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped_weight = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        row = ranked.agg(F.sum(F.when(over, F.col("cap")).otherwise(0)).alias("held"),
                         F.sum(F.when(over, F.col("weight")).otherwise(0)).alias("gone"),
                         F.sum("weight").alias("all")).first()
        if not row["all"] or row["gone"] == capped_weight or row["gone"] == row["all"]:
            break
        capped_weight = row["gone"]
        level = (total * total_share - row["held"]) / (row["all"] - row["gone"])
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """(source, source_size, target, full, below): take ``full`` copies, one more if hash < ``below``.

    ``sizes`` has (source, size, hash). Among the nested prefixes of a source
    in hash order, the one whose size is nearest the remainder is chosen.
    """
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    open_ = (targets.withColumn("full", full.cast("int"))
             .withColumn("budget", F.col("target") - F.col("full") * F.col("source_size"))
             .withColumn("lo", F.lit(0).cast("long")).withColumn("done", F.lit(0).cast("long")))
    shift = HASH_BITS
    while shift > 0:
        width = min(bucket_bits, shift)
        shift -= width
        # rows inside the boundary range of their source, by the next bits of the hash
        inside = (sizes.alias("d").join(open_.alias("s"), F.expr("d.source <=> s.source"))
                  .where(F.shiftright("hash", shift + width) == F.shiftright("lo", shift + width))
                  .where("d.size > 0")
                  .groupBy(F.col("s.source").alias("source"), F.shiftright("hash", shift).alias("bucket"))
                  .agg(F.sum("d.size").alias("size")))
        w = W.partitionBy("source").orderBy("bucket")
        run = F.sum("size").over(w)
        joined = (inside.withColumn("upto", run).alias("h")
                  .join(open_.select("source", "budget", "done").alias("s"), F.expr("h.source <=> s.source"))
                  .select("h.source", "h.bucket", (F.col("done") + F.col("upto") - F.col("size")).alias("excl"),
                          (F.col("done") + F.col("upto")).alias("incl"), "budget"))
        if shift:   # the bucket in which the running total crosses the budget
            crossing = (joined.where("incl > budget").groupBy("source")
                        .agg(F.min_by(F.struct("bucket", "excl"), "bucket").alias("x")))
            start, taken = F.shiftleft("x.bucket", shift), F.col("x.excl")
        else:       # one hash value a bucket: the nearer of its two ends
            crossing = (joined.where("incl + excl > 2 * budget").groupBy("source")
                        .agg(F.min_by(F.struct("bucket", "excl"), "bucket").alias("x")))
            start, taken = F.col("x.bucket"), F.col("x.excl")
        past = F.lit(1 << HASH_BITS)    # the budget reaches past every row
        open_ = staged(
            open_.alias("s").join(crossing.alias("c"), F.expr("s.source <=> c.source"), "left")
            .select("s.source", "source_size", "target", "full", "budget",
                    F.when(F.col("x").isNull(), F.when(F.col("lo") >= past, F.col("lo")).otherwise(
                        past if shift + width == HASH_BITS else _next(F.col("lo"), shift + width)))
                    .otherwise(start).alias("lo"),
                    F.coalesce(taken, F.col("done")).alias("done")), "mix-level")
    return open_.select("source", "source_size", "target", "full", F.col("lo").alias("below"))


def _next(lo, shift: int):
    """The first hash after the range of ``lo`` at this level."""
    return F.shiftleft(F.shiftright(lo, shift) + 1, shift)


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash), staged: the only pass over the texts."""
    return staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              id_hash(F.col("doc_id")).alias("hash")), "mix-sizes")


def copies(full, below, hash_):
    return full + F.when(hash_ < below, 1).otherwise(0)


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
             max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """The staged sizes and the per-source thresholds."""
    sizes = document_sizes(docs)
    return sizes, thresholds(sizes, source_targets(sizes, weights, total_share, max_repeats))


def mix_report(docs: DataFrame, **knobs) -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), taken (repeats counted)."""
    sizes, limits = mix_plan(docs, **knobs)
    return (sizes.alias("d").join(limits.alias("s"), F.expr("d.source <=> s.source"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * copies(F.col("full"), F.col("below"), F.col("hash"))).alias("taken")))


def mix(docs: DataFrame, **knobs) -> DataFrame:
    """The mix itself: every input column, each document repeated as often as it is taken."""
    _, limits = mix_plan(docs, **knobs)
    p = spare_prefix(docs.columns, P)
    limits = limits.select(*[F.col(c).alias(p + c) for c in ("source", "full", "below")])
    rows = docs.withColumn(p + "hash", id_hash(F.col("doc_id")))
    taken = rows.join(limits, F.col("source").eqNullSafe(F.col(p + "source")))
    n = copies(F.col(p + "full"), F.col(p + "below"), F.col(p + "hash"))
    return (taken.withColumn(p + "copy", F.explode(F.array_repeat(F.lit(1), n.cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
