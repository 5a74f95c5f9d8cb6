"""Silver tables laid out for the strong match: bucketed by its key, replaced day by day.

The strong match joins both silver streams on business date, operator and
transaction id. As plain tables both sides are shuffled in every run. Here a
stream is kept as two catalog tables:

* ``<name>_keyed``: rows whose match key is complete, partitioned by business
  date, bucketed by operator and transaction id, sorted by them. Two such tables
  with equal bucket counts join without an exchange, as buckets that agree on a
  part of the join key agree on the whole of it.
* ``<name>_unkeyed``: rows with a NULL in the key. They never match, and in
  buckets all of an operator's would lie in one. Plain, partitioned by date.

A bucket is read by one task, so a key that holds a large share of the rows
(a sentinel, a replayed id) would make one task long, and a join without an
exchange cannot be split. The rows of each bucket are therefore counted before a
stream's first write (a partial aggregate to one number a bucket); if one holds
over ``HOT_SHARE`` times the mean and over ``HOT_ROWS`` rows, the keyed table is
made without buckets, and the join shuffles and is skew-split as before. Later
writes keep the layout; ``relayout`` decides anew from all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matching import STRONG_KEY, filter_dates
from ..session import configure
from ..sources.tables import delete_path

DAY = "business_date"
BUCKET_BY = tuple(k for k in STRONG_KEY if k != DAY)
HOT_SHARE = 8
HOT_ROWS = 1_000_000
#: by default the planner shuffles again unless both sides are split by every column of the join key
PART_OF_KEY_SUFFICES = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def keyed_rows():
    """The rows that can match: no part of the key is NULL."""
    cond = F.col(STRONG_KEY[0]).isNotNull()
    for k in STRONG_KEY[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def has_hot_bucket(df: DataFrame, buckets: int, hot_rows: int = HOT_ROWS) -> bool:
    """Whether one bucket would hold far more rows than the others."""
    sizes = df.groupBy(F.pmod(F.hash(*BUCKET_BY), F.lit(buckets)).alias("b")).count()
    top, rows = sizes.agg(F.max("count"), F.sum("count")).first()
    return bool(top) and top > hot_rows and top > HOT_SHARE * rows / buckets


def _create(df: DataFrame, table: str, path: str, buckets: int | None) -> None:
    writer = df.limit(0).write.format("parquet").partitionBy(DAY).option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, *BUCKET_BY).sortBy(*BUCKET_BY)
    writer.saveAsTable(table)


def buckets_of(spark: SparkSession, table: str) -> int:
    """Number of buckets of a catalog table; 0 for a plain one."""
    for r in spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").collect():
        return int(r["data_type"])
    return 0


def location_of(spark: SparkSession, table: str) -> str:
    """Folder of a catalog table."""
    return spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _put(df: DataFrame, table: str, buckets: int) -> None:
    columns = df.sparkSession.table(table).columns
    # one task a bucket, so a day has at most one file in each
    df = df.repartition(buckets, *BUCKET_BY) if buckets else df.hint("rebalance", F.col(DAY))
    df.select(*columns).write.insertInto(table, overwrite=True)


def replace_days(df: DataFrame, name: str, path: str, dates, buckets: int, hot_rows: int = HOT_ROWS) -> None:
    """Replace the given business dates of the stream ``name`` (``db.name``) by ``df``'s rows of these dates.

    Tables are created below ``path`` (shared storage) on first use. A date without rows ends empty. A row
    outside the dates is left out. Rerunning is idempotent; a run that dies between the two tables is
    mended by its rerun. Rows with a NULL business date belong to no day and are left out.
    """
    spark = configure(df.sparkSession)      # overwrites must be dynamic: only the written days are replaced
    dates = sorted(dates)
    keyed, unkeyed = f"{name}_keyed", f"{name}_unkeyed"
    rows = df.where(F.col(DAY).isin(dates))
    full = rows.where(keyed_rows())
    if not spark.catalog.tableExists(keyed):
        _create(df, keyed, f"{path}/keyed", None if has_hot_bucket(full, buckets, hot_rows) else buckets)
    if not spark.catalog.tableExists(unkeyed):
        _create(df, unkeyed, f"{path}/unkeyed", None)
    for part, table in ((full, keyed), (rows.where(~keyed_rows()), unkeyed)):
        present = {r[DAY] for r in part.select(DAY).distinct().collect()}
        _put(part, table, buckets_of(spark, table))
        held = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        for gone in (d for d in dates if d not in present and str(d) in held):
            # a dynamic overwrite leaves days without new rows as they were
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY} = DATE '{gone}')")
            delete_path(spark, f"{location_of(spark, table)}/{DAY}={gone}")


def relayout(spark: SparkSession, name: str, path: str, buckets: int, hot_rows: int = HOT_ROWS) -> None:
    """Write the keyed table anew below ``path`` (a fresh folder), with or without buckets as its rows now
    call for, and let the catalog name point to it. Running readers keep the old folder; between dropping
    and renaming the name is missing for a moment, so this belongs between runs."""
    table = f"{name}_keyed"
    rows = spark.table(table)
    hot = has_hot_bucket(rows, buckets, hot_rows)
    fresh = f"{table}_fresh"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    _create(rows, fresh, path, None if hot else buckets)
    _put(rows, fresh, 0 if hot else buckets)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")


def read_days(spark: SparkSession, name: str, dates=None) -> tuple[DataFrame, DataFrame]:
    """``(keyed, unkeyed)`` rows of a stream, restricted to dates by partition filters.

    Sets ``PART_OF_KEY_SUFFICES`` on the session, so that joins of the keyed tables need no exchange. It
    concerns only joins whose both sides are already split alike by a part of their key.
    """
    spark.conf.set(*PART_OF_KEY_SUFFICES)
    return tuple(filter_dates(spark.table(f"{name}_{part}"), dates) for part in ("keyed", "unkeyed"))
