"""Parquet table sinks: partition replacement, full overwrite, upsert, export.

Parquet has no transaction log, so each operation is built from Spark's own
write protocol: ``partitionOverwriteMode=dynamic`` stages the new files and
swaps only the partitions present in the output at job commit. On top of it:

* ``replace_partitions`` also clears declared partitions that receive no rows
  (dynamic mode alone would leave them stale) and fails the job, before commit,
  if any row lies outside the declared partitions;
* ``merge_upsert`` computes the merged image of the touched partitions,
  writes it to the shared checkpoint folder (cutting the lineage back to the
  files it is about to replace), replaces those partitions, and removes the
  staged copy. With a key directory (``directory.py``) it knows the touched
  partitions without scanning the table.

There is no atomicity across partitions; a failed job leaves the previous
files of every partition it did not commit, and re-running it is idempotent.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.groups import OWN_GROUP, with_own_group
from ..session import configure, scratch_path
from ..sources.tables import delete_path, first_data_file, table_exists
from .directory import DirectoryStale, KeyDirectory, key_hash


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Fixed value: the characters that Spark escapes in partition folder names.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def _fmt(v) -> str:
    if v is None:
        return NULL_PARTITION
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


def _folder_text(text: str) -> str:
    """A name or value as Spark writes it in a folder name."""
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text) or NULL_PARTITION


def partition_dir(path: str, partition_by: Sequence[str], values: Sequence) -> str:
    return path.rstrip("/") + "/" + "/".join(f"{_folder_text(c)}={_folder_text(_fmt(v))}" for c, v in zip(partition_by, values))


def _as_tuples(partitions, n: int) -> list[tuple]:
    out = []
    for p in partitions:
        if isinstance(p, dict):
            raise TypeError("pass partition values as tuples in partition_by order")
        out.append(tuple(p) if isinstance(p, (list, tuple)) else (p,))
        if len(out[-1]) != n:
            raise ValueError(f"partition value {p!r} does not match {n} partition columns")
    return out


def _lit(v) -> Column:
    if isinstance(v, _dt.date) and not isinstance(v, _dt.datetime):
        return F.lit(v.isoformat()).cast("date")
    return F.lit(v)


def in_partitions(partition_by: Sequence[str], tuples: list[tuple]) -> Column:
    """Whether a row lies in one of the partitions.

    One ``IN`` list of the last column per combination of the others, combined
    as a balanced tree: thousands of partitions stay a shallow expression that
    still prunes partitions.
    """
    groups: dict[tuple, list] = {}
    for t in tuples:
        groups.setdefault(tuple(t[:-1]), []).append(t[-1])

    def equals(col: str, v) -> Column:
        return F.col(col).isNull() if v is None else F.col(col) == _lit(v)

    conds = []
    for head, values in groups.items():
        given = [v for v in values if v is not None]
        last = F.col(partition_by[-1]).isin([_lit(v) for v in given]) if given else F.lit(False)
        if len(given) < len(values):
            last = F.coalesce(last, F.lit(False)) | F.col(partition_by[-1]).isNull()
        for col, v in zip(partition_by, head):
            last = equals(col, v) & last
        conds.append(last)
    while len(conds) > 1:
        conds = [x if y is None else x | y for x, y in zip(conds[::2], [*conds[1::2], None])]
    return conds[0] if conds else F.lit(False)


def layout_of(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of an existing table, from the folders above one of its
    data files. A partition folder left empty says nothing about the layout."""
    file = first_data_file(spark, path)
    if file is None:
        return []
    depth = len(_qualified(spark, path).split("/"))
    return [unquote(f.split("=", 1)[0]) for f in file.split("/")[depth:-1] if "=" in f]


def rebalanced(df: DataFrame, partition_by: Sequence[str] | None) -> DataFrame:
    """Group rows by the table's partition columns before writing, through
    the REBALANCE hint: adaptive execution coalesces small output partitions
    and splits a skewed one (a hot day) across tasks, so neither thousands of
    tiny files nor one overloaded writer task appear."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def full_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Write the table from scratch (first write, or a layout change)."""
    w = rebalanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], partitions,
                       metrics: Sequence[Column] = ()) -> dict:
    """Swap exactly the declared partitions of the table at ``path``.

    ``partitions`` lists value tuples in ``partition_by`` order. Rows outside
    them fail the write; declared partitions without rows are removed. A new
    table, or one with a different layout, is written in full. Returns the
    observed metrics (row count, the partitions that received rows, and the
    named aggregates in ``metrics``, all from the write job itself).
    """
    spark = df.sparkSession
    configure(spark)
    partition_by = list(partition_by)
    tuples = _as_tuples(partitions, len(partition_by))
    inside = in_partitions(partition_by, tuples)
    # Checked per row inside the write job: a stray row aborts the job before
    # its commit, so no foreign partition is ever overwritten.
    first = partition_by[0]
    checked = df.withColumn(first, F.when(inside, F.col(first)).otherwise(
        F.raise_error(F.lit(f"row outside the partitions being replaced at {path}"))))
    obs = Observation("replace_partitions")
    checked = checked.observe(obs, F.count(F.lit(1)).alias("rows"),
                              F.collect_set(F.struct(*partition_by)).alias("written"), *metrics)
    if not table_exists(spark, path) or layout_of(spark, path) != partition_by:
        full_overwrite(checked, path, partition_by)
    else:
        (rebalanced(checked, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))
    m = observed(obs)
    if not m and not df.isEmpty():
        # metrics are only absent when no task ran, i.e. an empty input;
        # anything else must not be taken as "nothing written"
        raise RuntimeError(f"write metrics missing for a non-empty input at {path}")
    written = {tuple(_fmt(v) for v in r) for r in (m.get("written") or [])}
    cleared = 0
    for t in tuples:
        if tuple(_fmt(v) for v in t) not in written:
            cleared += delete_path(spark, partition_dir(path, partition_by, t))
    out = {"rows": int(m.get("rows") or 0), "partitions_written": len(written), "partitions_cleared": cleared}
    if metrics:
        out["metrics"] = {k: v for k, v in m.items() if k not in ("rows", "written")}
    return out


def observed(obs: Observation) -> dict:
    """Metrics of a finished write ({} when none were reported: an input with
    no partitions runs no task, so nothing reports)."""
    try:
        return dict(obs.get)
    except Exception:
        return {}


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a table written by these sinks. Without a contract ``schema`` the
    files' schemas are merged (they may have widened), which opens the footers
    of the whole table; layers with a fixed contract pass it."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def key_places(df: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Directory entries of the rows of ``df``: key hashes, bucket and partition values. NULL keys have no place."""
    return df.where(_all_not_null(keys)).select(*key_hash(keys), *partition_by)


def directory_of(spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str]) -> KeyDirectory:
    """The key directory of the table at ``path`` (a sibling folder)."""
    places = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in partition_by)
    return KeyDirectory(spark, path.rstrip("/") + "_key_directory", places)


def rebuild_directory(spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> KeyDirectory:
    """Read every key of the table once and note where it lies."""
    table = read_table(spark, path)
    directory = directory_of(spark, path, table, partition_by)
    directory.rebuild(key_places(table, keys, partition_by))
    return directory


def merge_upsert(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str],
                 order_by: str | Sequence[str] | None = "file_arrival_date", use_directory: bool = False,
                 before_replace: Callable[[list[tuple]], None] | None = None) -> dict:
    """The latest version of each key wins, wherever it comes from; create the
    table if absent.

    Versions, those already in the table included, rank by ``order_by`` (NULLs
    first), so replaying an older change never undoes a newer one; at equal
    rank the source wins. Source duplicates rank by ``order_by``, then all
    columns. A target column missing from the source keeps its old value on
    matched rows; source columns missing from the target widen the table. NULL
    keys never match, so such rows are always inserted.

    Only partitions that receive a source row, or hold an older version of a
    source key, are rewritten, so a key whose partition value changed (an
    event re-dated) leaves no stale copy behind. The second set is looked up in
    the table's key directory with ``use_directory`` (built from the table when it
    is missing or no longer agrees with it; all merges of a table should then use
    it), else found with a scan of the table's key and partition columns.
    ``before_replace`` is called with the partitions before any of them changes.
    The returned ``partitions`` are all those that were rewritten.
    """
    spark = df.sparkSession
    configure(spark)
    keys, partition_by = list(keys), list(partition_by)
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    order = [c for c in order if c not in keys]
    src = _latest_per_key(df, keys, order)
    if not table_exists(spark, path):
        obs = Observation("merge_created")
        if use_directory or before_replace:     # the partitions must be known before the table is written
            src = _staged(src, "merge-source")
        if before_replace:
            before_replace([tuple(r) for r in src.select(*partition_by).distinct().collect()])
        full_overwrite(src.observe(obs, F.collect_set(F.struct(*partition_by)).alias("written")), path, partition_by)
        if use_directory:
            directory_of(spark, path, src, partition_by).rebuild(key_places(src, keys, partition_by))
        return {"created": True, "partitions": [tuple(r) for r in (observed(obs).get("written") or [])]}
    target = read_table(spark, path)
    if use_directory:
        src = _staged(src, "merge-source")
        directory = directory_of(spark, path, target, partition_by)
        if not directory.usable():
            rebuild_directory(spark, path, keys, partition_by)
        try:
            return _merge(src, target, path, keys, partition_by, order, directory, before_replace)
        except DirectoryStale:
            rebuild_directory(spark, path, keys, partition_by)
            return _merge(src, target, path, keys, partition_by, order, directory, before_replace)
    return _merge(src, target, path, keys, partition_by, order, None, before_replace)


def _staged(df: DataFrame, name: str) -> DataFrame:
    out = scratch_path(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def _merge(src: DataFrame, target: DataFrame, path: str, keys: list[str], partition_by: list[str], order: list[str],
           directory: KeyDirectory | None, before_replace) -> dict:
    spark = src.sparkSession
    src_keys = src.select(*keys).where(_all_not_null(keys))
    if directory:
        known = directory.lookup(key_places(src, keys, partition_by))
        holding = known.select(*partition_by)
    else:
        holding = target.select(*keys, *partition_by).join(src_keys, keys, "left_semi").select(*partition_by)
    touched = [tuple(r) for r in src.select(*partition_by).union(holding).distinct().collect()]
    if not touched:
        return {"rows": 0, "partitions_written": 0, "partitions_cleared": 0, "partitions": []}
    tgt = target.where(in_partitions(partition_by, touched))
    kept = tgt.join(src_keys, keys, "left_anti")
    # every older version of a source key lies in a touched partition
    held = tgt.join(src_keys, keys, "left_semi")
    old = _latest_per_key(held, keys, [c for c in order if c in held.columns])
    shared = [c for c in src.columns if c in old.columns and c not in keys]
    extra = [c for c in old.columns if c not in src.columns and c not in keys]
    both = (src.select(*keys, F.struct(*[c for c in src.columns if c not in keys]).alias("_s"))
            .join(old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("_t")), keys, "left"))
    rank = lambda side: F.struct(*[x for c in order if c in src.columns and c in old.columns
                                   for x in (F.col(f"{side}.{c}").isNotNull(), F.col(f"{side}.{c}"))], F.lit(0))
    older = F.col("_t").isNotNull() & (rank("_s") < rank("_t"))
    pick = [F.when(older, F.col(f"_t.{c}").cast(src.schema[c].dataType)).otherwise(F.col(f"_s.{c}")).alias(c) for c in shared]
    new = [F.when(~older, F.col(f"_s.{c}")).alias(c) for c in src.columns if c not in shared and c not in keys]
    found = Observation("merge_found")
    matched = both.select(*keys, *pick, *new, *[F.col(f"_t.{c}").alias(c) for c in extra], F.col("_t").isNotNull().alias("_matched"))
    matched = matched.observe(found, F.count_if("_matched").alias("found")).drop("_matched")
    merged = kept.unionByName(matched, allowMissingColumns=True)
    stage = scratch_path(spark, "merge")
    merged.write.parquet(stage)
    merged = spark.read.schema(merged.schema).parquet(stage)
    try:
        if directory and known.count() != int(observed(found).get("found") or 0):
            raise DirectoryStale(f"{path}: keys do not lie where the directory has them")
        if before_replace:
            before_replace(touched)
        run = directory.open() if directory else None
        out = replace_partitions(merged, path, partition_by, touched)
        if directory:
            places = key_places(merged.join(src_keys, keys, "left_semi"), keys, partition_by)
            same = [F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in partition_by]
            was = known.select("k1", "k2", *[F.col(c).alias(f"_was_{c}") for c in partition_by], F.lit(True).alias("_was"))
            stays = F.coalesce("_was", F.lit(False)) & reduce(lambda x, y: x & y, same)
            directory.close(run, places.join(was, ["k1", "k2"], "left").where(~stays).select("k1", "k2", "bucket", *partition_by))
    finally:
        delete_path(spark, stage)
    return out | {"partitions": touched}


def _all_not_null(cols) -> Column:
    c = None
    for k in cols:
        e = F.col(k).isNotNull()
        c = e if c is None else c & e
    return c


def _latest_per_key(df: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    order = [c for c in order if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    lead = [x for k, c in enumerate(order) for x in (F.col(c).isNotNull().alias(f"_o{k}"), F.col(c))]
    return (with_own_group(df, _all_not_null(keys)).groupBy(*keys, OWN_GROUP)
            .agg(F.max(F.struct(*lead, *rest)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}") for c in [*order, *rest]])).select(*df.columns)


def export_snapshot(df: DataFrame, path: str, files: int | None = None) -> None:
    """Plain Parquet copy; ``files`` bounds the output file count (1 only on
    request: it funnels the table through one task)."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").parquet(path)


def register_external_table(spark: SparkSession, db: str, table: str, path: str, touched=None) -> bool:
    """Catalog entry over a Parquet folder, brought up to date in place (False when there is no data).

    The first call creates the entry and takes in every partition folder. Later
    calls add columns that the files have gained and add or drop the ``touched``
    partitions only (value tuples; all folders when None), so readers never meet a
    missing table and only touched folders are listed. An entry with another location or
    partitioning is made anew.
    """
    if not table_exists(spark, path):
        return False
    name = f"`{db}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    parts = layout_of(spark, path)
    known = _registered(spark, name)
    if known is None or known != (_qualified(spark, path), parts):
        schema = read_table(spark, path).schema
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{by} LOCATION '{path}'")
        touched = None
    elif touched is not None:
        present, gone = [], []
        for values in _as_tuples(touched, len(parts)):
            folder = partition_dir(path, parts, values)
            (present if table_exists(spark, folder) else gone).append((values, folder))
        if present:
            files = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*[f for _, f in present])
            _widen(spark, name, files.schema)
        for verb, some in (("ADD IF NOT EXISTS", present), ("DROP IF EXISTS", gone)):
            _alter_partitions(spark, name, verb, parts, [v for v, _ in some])
        spark.sql(f"REFRESH TABLE {name}")
        return True
    else:
        _widen(spark, name, read_table(spark, path).schema)
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    return True


def _qualified(spark: SparkSession, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def _registered(spark: SparkSession, name: str) -> tuple[str, list[str]] | None:
    """(location, partition columns) of a catalog table, None when there is none."""
    if not spark.catalog.tableExists(name):
        return None
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return _qualified(spark, about.get("Location", "")) if about.get("Location") else "", parts


def _widen(spark: SparkSession, name: str, schema) -> None:
    have = {c.lower() for c in spark.table(name).columns}
    more = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name.lower() not in have]
    if more:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(more)})")


def _alter_partitions(spark: SparkSession, name: str, verb: str, parts: Sequence[str], values: list[tuple], at_once: int = 200) -> None:
    def spec(t: tuple) -> str:
        text = lambda v: "null" if v is None else "'" + _fmt(v).replace("'", "\\'") + "'"
        return "PARTITION (" + ", ".join(f"`{c}` = {text(v)}" for c, v in zip(parts, t)) + ")"

    for i in range(0, len(values), at_once):
        some = [spec(t) for t in values[i:i + at_once]]
        spark.sql(f"ALTER TABLE {name} {verb} {(' ' if verb.startswith('ADD') else ', ').join(some)}")
