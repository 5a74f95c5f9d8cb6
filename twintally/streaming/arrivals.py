"""Restate on arrival: a file-source stream over the landing zone.

The batch pipeline restates the business dates touched by a set of arrival
dates. Which arrival dates are new is exactly what a Structured Streaming
file source tracks: its checkpoint records every file already seen, so each
run (``trigger(availableNow=True)``) sees only files that landed since the
last one, exactly once, and stops. ``foreachBatch`` turns a micro-batch of
new file paths into its distinct arrival dates (one small row per date; file
contents are never read, only listed) and runs ``pipeline.restate`` for them.
Restatement replaces partitions, so a micro-batch replayed after a failure
rewrites the same tables.

Late data needs no watermark here: a late file carries its own arrival date
and restates the business dates its rows belong to.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_RECON, ReconConfig
from ..plans.pipeline import Lake, restate
from ..sources.landing import arrival_date_of_any

LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrival_dates_of(paths_df):
    """Distinct arrival dates named by a frame of landing paths, by the rule
    the readers follow. A data file whose path names no date is an error: it
    would be marked as seen and never be processed."""
    date = arrival_date_of_any(F.col("path"))
    data = F.lower(F.col("path")).rlike(r"\.(csv|json)$")
    checked = F.when(date.isNull() & data, F.raise_error(F.concat(F.lit("landing file without an arrival date: "), F.col("path")))
                     .cast("date")).otherwise(date)
    return paths_df.select(checked.alias("d")).where(F.col("d").isNotNull()).distinct()


def restate_on_arrival(spark: SparkSession, landing: dict, lake: Lake, checkpoint: str,
                       cfg: ReconConfig = DEFAULT_RECON, run_ts=None,
                       max_files_per_trigger: int | None = None) -> list[dict]:
    """Process every landing file not seen by ``checkpoint``; returns one
    restatement log per micro-batch."""
    logs: list[dict] = []

    def on_batch(batch_df, batch_id):
        dates = sorted(r["d"] for r in arrival_dates_of(batch_df).collect())
        if dates:
            log = restate(spark, landing, lake, dates, cfg, run_ts)
            log["batch_id"] = batch_id
            logs.append(log)

    queries = []
    for zone in ("operator_feeds", "internal"):
        reader = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA)
                  .option("recursiveFileLookup", "true"))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        queries.append(reader.load(landing[zone]).select("path"))
    files = queries[0].unionByName(queries[1])
    q = (files.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return logs
