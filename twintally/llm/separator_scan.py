"""Token counts of documents in flat token files, found by their end-of-document ids.

A flat file is a stream of little-endian unsigned 16-bit ids in which an end id
follows every document; nothing says where documents begin. It is read in
blocks. Each block is searched for the end id at once, on its own, and gives a
summary: its ids, its ends, and where the last end lies. A prefix scan over the
summaries (segments of blocks first, then blocks of a segment) tells each block
how many documents and ids came before it and where the last document ended, so
a document that runs over any number of blocks is stitched together.

Defined cases: NULL and empty texts are documents of no tokens; ids after the
last end id of a file are a document of their own, marked unended; empty blocks
and files give no documents; repeated rows are documents of their own; an empty
table gives no files; only doc_id and text are read, so extra columns cannot
clash. End-id strings inside a text are encoded as ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twintally.llm.common import staged, text_chunks
from twintally.llm.unit_tokens import tokenizer_for, with_end

#: ids of a block
BLOCK_IDS = 1 << 18
#: blocks of a segment of the prefix scan
SEGMENT_BLOCKS = 1024


def write_flat_files(docs: DataFrame, tokenizer_path: str, end_id: int, mode: str = "spaced",
                     block_ids: int = BLOCK_IDS) -> DataFrame:
    """Token files as a staged table of blocks: file, block, data, names.

    One file a task, in the order in which the task reads. ``names`` lists the
    documents whose first id was written since the block before; the scan
    does not look at it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_for(tokenizer_path, mode, plain_specials=True)
        held, names, file, block = np.zeros(0, np.uint16), [], 0, 0

        def row(data: np.ndarray) -> pa.RecordBatch:
            nonlocal names, block
            whole = pa.concat_arrays(names) if names else pa.array([], kind_)
            out = pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([data.astype("<u2").tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)],
                names=["file", "block", "data", "names"])
            names, block = [], block + 1
            return out

        for batch in batches:
            kind_ = batch.column(0).type
            for rows, col in text_chunks(batch, "text"):
                file = rows.column(2)[0].as_py()
                ids, _ = with_end(*coder.encode(col), end_id)
                held = np.concatenate([held, ids.astype(np.uint16)])
                names.append(rows.column(0))
                while len(held) >= block_ids:
                    yield row(held[:block_ids])
                    held = held[block_ids:]
        if len(held) or names:
            yield row(held)

    return staged(docs.select("doc_id", "text").withColumn("file", F.spark_partition_id())
                  .mapInArrow(run, f"file int, block long, data binary, names array<{kind}>"), "flat-files")


def read_flat_files(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks (file path, block, data) of raw id files in a store that Spark reads (each under 2 GB)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_buffer()
                for b in range(0, max(1, -(-len(data) // (2 * block_ids)))):
                    piece = data[b * 2 * block_ids:(b + 1) * 2 * block_ids].to_pybytes()
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([b], pa.int64()),
                                                      pa.array([piece], pa.binary())], names=["file", "block", "data"])

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    return files.mapInArrow(run, "file string, block long, data binary")


def _running(blocks: DataFrame, counts: dict[str, str]) -> DataFrame:
    """Adds, for each name: column, the column's sum over the blocks before, by two levels of windows."""
    seg = F.floor(F.col("block") / SEGMENT_BLOCKS).alias("seg")
    rows = blocks.select("*", seg)
    inside = W.partitionBy("file", "seg").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy("file").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("file", "seg").agg(*[F.sum(c).alias(f"s_{c}") for c in counts.values()])
    sums = sums.select("file", "seg", *[F.coalesce(F.sum(f"s_{c}").over(across), F.lit(0)).alias(f"b_{c}") for c in counts.values()])
    return rows.join(sums, ["file", "seg"]).select(
        *blocks.columns, *[(F.col(f"b_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in counts.items()])


def scan_documents(blocks: DataFrame, end_id: int) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of the documents in flat files (file, block, data)."""
    kind = blocks.schema["file"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[i].as_buffer(), "<u2")
                ends = np.flatnonzero(ids == end_id).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([len(ids)], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends))],
                    names=["file", "block", "n_ids", "ends"])

    found = staged(blocks.select("file", "block", "data").mapInArrow(
        run, f"file {kind}, block long, n_ids long, ends array<long>"), "separators")
    summary = found.select("file", "block", "n_ids", F.size("ends").cast("long").alias("n_ends"),
                           F.element_at("ends", -1).alias("last"))
    placed = _running(summary.withColumn("last", F.when(F.col("n_ends") > 0, F.col("last"))),
                      {"ids_before": "n_ids", "ends_before": "n_ends"})
    # where the document that is open at a block's start began: after the last end of any block before
    last = F.col("ids_before") + F.col("last") + 1
    seg = F.floor(F.col("block") / SEGMENT_BLOCKS)
    marked = placed.withColumn("after", last).withColumn("seg", seg)
    top = marked.groupBy("file", "seg").agg(F.max("after").alias("m"))
    top = top.select("file", "seg", F.max("m").over(
        W.partitionBy("file").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)).alias("seg_open"))
    open_ = F.greatest("seg_open", F.max("after").over(
        W.partitionBy("file", "seg").orderBy("block").rowsBetween(W.unboundedPreceding, -1)))
    carried = marked.join(top, ["file", "seg"]).select("file", "block", "ids_before", "ends_before", "n_ids", "after",
                                                       F.coalesce(open_, F.lit(0)).alias("open"))
    whole = (found.join(carried.drop("n_ids"), ["file", "block"])
             .select("file", "ids_before", "ends_before", "open", "ends", F.posexplode("ends").alias("k", "end"))
             .select("file", (F.col("ends_before") + F.col("k")).alias("ordinal"),
                     F.when(F.col("k") == 0, F.col("open"))
                     .otherwise(F.col("ids_before") + F.get("ends", F.col("k") - 1) + 1).alias("start"),
                     (F.col("ids_before") + F.col("end")).alias("stop"), F.lit(True).alias("ended")))
    rest = (carried.groupBy("file").agg(F.max(F.col("ids_before") + F.col("n_ids")).alias("stop"),
                                        F.coalesce(F.max("after"), F.lit(0)).alias("start"))
            .where("stop > start")
            .join(found.groupBy("file").agg(F.sum(F.size("ends")).alias("ordinal")), "file")
            .select("file", "ordinal", "start", "stop", F.lit(False).alias("ended")))
    return whole.unionByName(rest).select("file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "ended")


def count_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, mode: str = "spaced", **knobs) -> DataFrame:
    """Per document: doc_id, n_tokens (without its end id), file, ordinal, start."""
    files = write_flat_files(docs, tokenizer_path, end_id, mode, **knobs)
    counted = scan_documents(files, end_id)
    names = files.select("file", "block", "names", F.size("names").cast("long").alias("n"))
    names = (_running(names, {"before": "n"}).select("file", "before", F.posexplode("names").alias("k", "doc_id"))
             .select("file", (F.col("before") + F.col("k")).alias("ordinal"), "doc_id"))
    return names.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
