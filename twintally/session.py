"""Spark session settings the library relies on.

Every operator assumes a UTC session clock (business dates are UTC dates),
ANSI SQL on (bad text must go through ``try_*`` helpers, never silently to
NULL), adaptive execution on, and dynamic partition overwrite for sinks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Runtime settings that may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
    # plan text is for logs only; keep it bounded for deep plans
    "spark.sql.maxPlanStringLength": "1000000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators depend on (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(app_name: str = "twintally", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults.

    On a cluster the master, memory and checkpoint directory come from the
    submit configuration; locally (tests, bench) pass ``master``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session. Only a local-mode session without one (tests, the
    bench) gets a scratch folder created and registered; on a cluster an
    unset value is an error rather than a machine-local folder.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not spark.sparkContext.master.startswith("local"):
                # a machine-local folder is invisible to other executors
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            d = tempfile.mkdtemp(prefix="twintally-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the checkpoint root for one run."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"



def together(spark: SparkSession, steps: Sequence[Callable], at_once: int = 8) -> list:
    """Results of independent steps, whose Spark jobs are submitted side by side, so that the planning,
    commits and last tasks of one do not leave the executors idle. All end before an error is raised."""
    if len(steps) < 2:
        return [f() for f in steps]
    checkpoint_root(spark)          # named once, before several steps ask for it
    with ThreadPoolExecutor(min(at_once, len(steps))) as pool:
        running = [pool.submit(inheritable_thread_target(f)) for f in steps]
    return [r.result() for r in running]
