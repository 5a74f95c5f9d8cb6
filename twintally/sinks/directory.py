"""Where a key lies: a key directory kept beside a table.

A merge must find the partitions that hold older versions of its keys. Without help
that is a scan of the key columns of the whole table. The directory holds, per key, a 128-bit
hash and the key's current place (a few columns, such as the table's partition
values), bucketed by hash and appended to by each run: a newer entry of a key supersedes older
ones. Looking keys up reads only the buckets they fall in, never the table, so
what a merge reads of the table does not grow with the days it does not touch.

Entries are trusted only while the bookkeeping agrees:

* a run opens a marker before it changes the table and closes it, with the number of entries per
  bucket, after its entries are written; a marker left open means that the table may have moved on;
* a lookup counts what it reads per bucket and compares it with the closed markers, so lost or
  doubled entry files are noticed;
* the caller compares the keys that the directory places with those it really finds there
  (``merge_upsert`` does), so entries made stale by others are noticed.

In each case the directory is rebuilt from the table. After ``COMPACT_AFTER`` runs a new generation
keeps one entry per key.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import delete_path, list_names, read_text, table_exists, write_text

BUCKETS = 16
COMPACT_AFTER = 32


class DirectoryStale(RuntimeError):
    """The directory does not agree with its bookkeeping or with the table."""


def key_hash(keys: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes of the key columns and the bucket they give."""
    k1 = F.xxhash64(*keys)
    return [k1.alias("k1"), F.xxhash64(F.lit("directory"), *keys).alias("k2"),
            F.pmod(k1, F.lit(BUCKETS)).cast("int").alias("bucket")]


class KeyDirectory:
    """The directory at ``path``; ``places`` is the DDL of the place columns."""

    def __init__(self, spark: SparkSession, path: str, places: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.markers_path = f"{self.path}/markers"
        self.place_columns = [f.split()[0] for f in places.split(", ")]
        self.schema = f"k1 bigint, k2 bigint, seq bigint, {places}, bucket int"

    # -- bookkeeping ---------------------------------------------------------
    # A marker is a small file, <generation>-<seq>.open or .closed; the closed one holds the entries per bucket.

    def _markers(self) -> list[tuple[int, int, bool]]:
        """(generation, seq, closed) of every marker; ``COMPACT_AFTER`` runs of a generation at most."""
        names = [n for n in list_names(self.spark, self.markers_path) if n.endswith((".open", ".closed")) and not n.startswith(".")]
        return [(*map(int, n.split(".")[0].split("-")), n.endswith(".closed")) for n in names]

    def _mark(self, run: tuple[int, int], counts: dict[int, int] | None = None) -> None:
        kind = "open" if counts is None else "closed"
        write_text(self.spark, f"{self.markers_path}/{run[0]}-{run[1]}.{kind}", json.dumps(counts or {}))

    def _state(self, run: tuple[int, int] | None = None) -> tuple[int | None, dict[int, int], int]:
        """(generation, entries per bucket, runs in it); generation is None when it must be rebuilt.
        The caller's own open ``run`` is no reason."""
        markers = self._markers()
        if not markers:
            return None, {}, 0
        generation = max(m[0] for m in markers)
        closed = {seq for g, seq, done in markers if g == generation and done}
        opened = {seq for g, seq, done in markers if g == generation and not done}
        if opened - closed - ({run[1]} if run else set()):
            return None, {}, 0
        held = dict.fromkeys(range(BUCKETS), 0)
        for seq in closed:
            for b, n in json.loads(read_text(self.spark, f"{self.markers_path}/{generation}-{seq}.closed")).items():
                held[int(b)] += n
        return generation, held, len(closed)

    def usable(self) -> bool:
        return self._state()[0] is not None

    def _entries(self, generation: int) -> DataFrame:
        path = f"{self.path}/generation-{generation}"
        if not table_exists(self.spark, path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path)

    # -- use -----------------------------------------------------------------

    def lookup(self, keyed: DataFrame, run: tuple[int, int] | None = None) -> DataFrame:
        """(k1, k2, place columns) of the keys that the directory knows. ``keyed`` has k1, k2, bucket.

        Written out before it is returned, so that its counts are known; raises
        ``DirectoryStale`` when entries are missing or doubled.
        """
        from .partitions import observed, scratch_path
        generation, held, _ = self._state(run)
        if generation is None:
            raise DirectoryStale(f"{self.path}: no directory, or a run that did not finish")
        buckets = sorted(r[0] for r in keyed.select("bucket").distinct().collect())
        obs = Observation("directory_lookup")
        entries = self._entries(generation).where(F.col("bucket").isin(buckets)).observe(
            obs, *[F.count_if(F.col("bucket") == b).alias(f"b{b}") for b in buckets or [0]])
        wanted = keyed.select("k1", "k2").distinct()
        hits = entries.join(wanted, ["k1", "k2"], "left_semi")
        latest = hits.groupBy("k1", "k2").agg(F.max(F.struct("seq", *self.place_columns)).alias("e")).select(
            "k1", "k2", *[F.col(f"e.{c}") for c in self.place_columns])
        out = scratch_path(self.spark, "directory-lookup")
        latest.write.parquet(out)
        read = observed(obs)
        wrong = [b for b in buckets if int(read.get(f"b{b}") or 0) != held[b]]
        if wrong:
            raise DirectoryStale(f"{self.path}: buckets {wrong} do not hold the entries that were written")
        return self.spark.read.schema(latest.schema).parquet(out)

    def open(self) -> tuple[int, int]:
        """Mark a run as begun, before the table changes. Returns its (generation, number)."""
        generation, _, _ = self._state()
        if generation is None:
            raise DirectoryStale(f"{self.path}: rebuild before use")
        run = (generation, time.time_ns())
        self._mark(run)
        return run

    def close(self, run: tuple[int, int], entries: DataFrame) -> None:
        """Append the run's entries (k1, k2, bucket, place columns) and close its marker."""
        self._append(run, entries)
        generation, _, runs = self._state()
        if runs >= COMPACT_AFTER:
            latest = self._entries(generation).groupBy("k1", "k2", "bucket").agg(
                F.max(F.struct("seq", *self.place_columns)).alias("e"))
            self._generation(generation + 1, latest.select("k1", "k2", "bucket", *[F.col(f"e.{c}") for c in self.place_columns]))
            delete_path(self.spark, f"{self.path}/generation-{generation}")

    def _append(self, run: tuple[int, int], entries: DataFrame) -> None:
        from .partitions import observed
        obs = Observation("directory_append")
        rows = entries.select("k1", "k2", F.lit(run[1]).cast("bigint").alias("seq"), *self.place_columns, "bucket").observe(
            obs, *[F.count_if(F.col("bucket") == b).alias(f"b{b}") for b in range(BUCKETS)])
        rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/generation-{run[0]}")
        n = observed(obs)
        self._mark(run, {b: int(n.get(f"b{b}") or 0) for b in range(BUCKETS)})

    def _generation(self, generation: int, entries: DataFrame) -> None:
        """Start a generation. It counts only once closed: an unfinished one is abandoned with its files."""
        run = (generation, time.time_ns())
        self._mark(run)
        self._append(run, entries)

    def rebuild(self, entries: DataFrame) -> None:
        """A new generation from (k1, k2, bucket, place columns) of every key in the table."""
        last = max((m[0] for m in self._markers()), default=-1)
        self._generation(last + 1, entries)
        if last >= 0:
            delete_path(self.spark, f"{self.path}/generation-{last}")

    def audit(self, entries: DataFrame) -> DataFrame:
        """Keys whose place in the directory differs from ``entries`` (the table): (k1, k2, what)."""
        generation, _, _ = self._state()
        if generation is None:
            raise DirectoryStale(f"{self.path}: no directory, or a run that did not finish")
        now = self._entries(generation).groupBy("k1", "k2").agg(F.max(F.struct("seq", *self.place_columns)).alias("e"))
        now = now.select("k1", "k2", F.struct(*[F.col(f"e.{c}").alias(c) for c in self.place_columns]).alias("noted"))
        real = entries.select("k1", "k2", F.struct(*self.place_columns).alias("real"))
        what = (F.when(F.col("noted").isNull(), F.lit("lost")).when(F.col("real").isNull(), F.lit("gone"))
                .when(~F.col("noted").eqNullSafe(F.col("real")), F.lit("moved")))
        return now.join(real, ["k1", "k2"], "full_outer").select("k1", "k2", what.alias("what")).where(F.col("what").isNotNull())
