"""Helpers shared by the corpus operators: table access, staged tables, batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.session import scratch_path

#: ``[^\x20\x09-\x0D]+``: a word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: text bytes that one vectorised step handles at a time (whole documents; a longer one comes alone)
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts lineage with a table every executor can read again after a loss,
    and fixes rows that later steps read more than once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare_prefix(columns: list[str], prefix: str) -> str:
    """``prefix``, lengthened until no column name begins with it (Spark's names ignore case)."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix += "_"
    return prefix


def word_count(text: Column) -> Column:
    """Number of words of a text; NULL counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(key: Column) -> Column:
    """60 uniform bits of an id's text as a non-negative long (NULL hashes as the empty text).

    md5 rather than xxhash64 so that any SQL engine gives the same value.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def text_chunks(batch: pa.RecordBatch, column: str,
                max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch whose ``column`` holds at most ``max_bytes`` (at least one row each)."""
    import numpy as np

    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    if len(col) == 0:
        return
    sizes = np.zeros(len(col), np.int64)
    valid = np.asarray(col.is_valid())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    sizes[:] = np.diff(offsets)
    sizes[~valid] = 0
    begin, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and held + n > max_bytes:
            yield batch.slice(begin, i - begin), col.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    yield batch.slice(begin), col.slice(begin)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task
    would hold it beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
    if trim is not None:
        trim(0)


def even_partitions(spark: SparkSession, least: int = 1) -> int:
    """The session's shuffle partition count, for explicit ``repartition`` calls."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
