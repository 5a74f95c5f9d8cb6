"""The key directory of a merged table: equal results, what a merge reads, and lost or stale entries."""

import glob
import json
import os
import random
import subprocess
import sys

import pytest

from twintally.sinks import directory as D
from twintally.sinks import partitions as K

COLS, PARTS, KEYS = "k string, op string, day string, at int, v int", ["op", "day"], ["k", "op"]


def image(spark, path):
    return sorted((tuple(r) for r in K.read_table(spark, path).select("k", "op", "day", "at", "v").collect()), key=str)


def audit(spark, path):
    table = K.read_table(spark, path)
    return K.directory_of(spark, path, table, PARTS).audit(K.key_places(table, KEYS, PARTS)).count()


def merged(spark, path, rows, **more):
    return K.merge_upsert(spark.createDataFrame(rows, COLS), path, KEYS, PARTS, "at", **more)


def batch(rng, step):
    rows = [(f"k{rng.randrange(25)}", rng.choice("xy"), f"d{rng.randrange(6)}", rng.randrange(8), step * 100 + i) for i in range(12)]
    rows = list({(r[0], r[1], r[3]): r for r in rows}.values())          # one version per key and time
    return [*rows, (None, "x", "d1", 1, step)] if step % 3 == 0 else rows


def test_merges_with_and_without_a_directory_agree(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(D, "COMPACT_AFTER", 3)
    rng = random.Random(7)
    a, b = f"{tmpdir_path}/a", f"{tmpdir_path}/b"
    for step in range(5):
        rows = batch(rng, step)
        seen = []
        with_it = merged(spark, a, rows, use_directory=True, before_replace=seen.append)
        without = merged(spark, b, rows)
        assert sorted(with_it["partitions"]) == sorted(without["partitions"]) == sorted(seen[0])
        assert image(spark, a) == image(spark, b)
    assert audit(spark, a) == 0
    assert len(glob.glob(f"{a}_key_directory/generation-*")) == 1 and not os.path.exists(f"{a}_key_directory/generation-0")


def test_lost_stale_and_unfinished_directories_are_noticed(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    merged(spark, path, [(f"k{i}", "x", f"d{i % 4}", 1, i) for i in range(20)], use_directory=True)
    table = K.read_table(spark, path)
    directory = K.directory_of(spark, path, table, PARTS)
    # an entry file is lost: the lookup counts fewer entries than were written
    os.remove(glob.glob(f"{path}_key_directory/generation-0/bucket=*/*.parquet")[0])
    with pytest.raises(D.DirectoryStale, match="do not hold the entries"):
        directory.lookup(K.key_places(table, KEYS, PARTS))
    merged(spark, path, [(f"k{i}", "x", "d9", 2, i) for i in range(0, 20, 2)], use_directory=True)
    assert audit(spark, path) == 0
    assert {(k, d) for k, _, d, _, _ in image(spark, path)} == {(f"k{i}", "d9" if i % 2 == 0 else f"d{i % 4}") for i in range(20)}
    # someone else moves k1 from d1 to d3
    rows = [r for r in image(spark, path) if r[2] in ("d1", "d3")]
    K.replace_partitions(spark.createDataFrame([(k, o, "d3" if k == "k1" else d, at, v) for k, o, d, at, v in rows], COLS), path, PARTS,
                         [("x", "d1"), ("x", "d3")])
    assert audit(spark, path) == 1
    merged(spark, path, [("k1", "x", "d2", 5, 77)], use_directory=True)
    assert [r for r in image(spark, path) if r[0] == "k1"] == [("k1", "x", "d2", 5, 77)] and audit(spark, path) == 0
    # a run that died between the table and its entries
    directory.open()
    assert not directory.usable()
    merged(spark, path, [("k3", "x", "d0", 6, 1)], use_directory=True)
    assert audit(spark, path) == 0 and [r for r in image(spark, path) if r[0] == "k3"] == [("k3", "x", "d0", 6, 1)]


READS = """
import sys, datetime as dt
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import functions as F
from twintally.config import ReconConfig
from twintally.session import build_session
from twintally.sinks import partitions as K
from twintally.plans import pipeline as P
from test_restatement import RUN, put_feed, zones
import os
spark = build_session(master="local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {work!r} + "/ckpt",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + {work!r} + "/events", "spark.eventLog.compress": "false"}})
rows = spark.range({days} * 20).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("x").alias("op"),
    F.concat(F.lit("d"), (F.col("id") % {days}).cast("string")).alias("day"), F.lit(1).alias("at"), F.lit(0).alias("v"))
path = {work!r} + "/image"
K.merge_upsert(rows, path, ["k", "op"], ["op", "day"], "at", use_directory=True)
spark.sparkContext.setJobGroup("merge", "MARK")
K.merge_upsert(rows.where("id in (3, 4)").withColumn("at", F.lit(2)).withColumn("day", F.lit("d5")), path, ["k", "op"], ["op", "day"], "at",
               use_directory=True)
spark.sparkContext.setJobGroup("feeds", "setup")
root = {work!r} + "/landing"
zones(root)
for op in P.FEEDS:
    os.makedirs(root + "/operator_feeds/" + op, exist_ok=True)
day0 = dt.date(2024, 1, 1)
for i in range({days}):
    d = day0 + dt.timedelta(days=i)
    put_feed(root, "telco_a", d.strftime("%Y%m%d"), [("t%d" % i, "a", "SUB", "10.00", str(d) + " 12:00:00")])
cfg, lake = ReconConfig(rank_before_date_filter=True), P.Lake({work!r} + "/lake")
dates = [day0 + dt.timedelta(days=i) for i in range({days})]
log = P.ingest_operator_feeds(spark, root + "/operator_feeds", lake, dates, RUN, cfg)
P.build_silver_partner(spark, lake, log["business_dates"], cfg)
last = day0 + dt.timedelta(days={days})
put_feed(root, "telco_a", last.strftime("%Y%m%d"), [("t1", "a", "SUB", "10.00", str(day0 + dt.timedelta(days=3)) + " 12:00:00")])
spark.sparkContext.setJobGroup("feeds", "MARK")
log = P.ingest_operator_feeds(spark, root + "/operator_feeds", lake, [last], RUN, cfg)
P.build_silver_partner(spark, lake, log["business_dates"], cfg)
print("DATES", len(log["business_dates"]))
spark.stop()
"""


def files_read(work):
    """Data files that scans of each table read in the marked parts, from the event log."""
    files, scans, marked = {}, {}, set()
    with open(next(f for f in glob.glob(f"{work}/events/**", recursive=True) if os.path.isfile(f) and "appstatus" not in f)) as log:
        events = [json.loads(line) for line in log]
    def walk(node, execution):  # noqa: E306
        for m in node.get("metrics", []):
            if m["name"] == "number of files read":
                scans[m["accumulatorId"]] = (execution, node.get("metadata", {}).get("Location", ""))
        for child in node.get("children", []):
            walk(child, execution)
    for e in events:
        kind = e["Event"].rsplit(".", 1)[-1]
        if kind in ("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate"):
            walk(e["sparkPlanInfo"], e["executionId"])
        if kind == "SparkListenerJobStart" and e["Properties"].get("spark.job.description") == "MARK":
            marked.add(int(e["Properties"].get("spark.sql.execution.id", -1)))
        if kind == "SparkListenerDriverAccumUpdates":
            for acc, value in e["accumUpdates"]:
                files[acc] = value
    out = {}
    for acc, (execution, location) in scans.items():
        if execution in marked:
            name = next((n for n in ("image_key_directory", "image", "operator_feeds_arrival_index", "operator_feeds", "transaction_directory")
                         if f"/{n}" in location or f"_{n}" in location), None)
            if name:
                out[name] = out.get(name, 0) + files.get(acc, 0)
    return out


def test_what_a_merge_reads_does_not_grow_with_untouched_days(tmpdir_path):
    here = os.path.dirname(os.path.abspath(__file__))
    read = {}
    for days in (8, 24):
        work = f"{tmpdir_path}/{days}"
        os.makedirs(f"{work}/events")
        script = READS.format(root=os.path.dirname(here), tests=here, work=work, days=days)
        done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
        assert "DATES 2" in done.stdout, done.stderr[-2000:]
        read[days] = files_read(work)
    assert read[8]["image"] and read[8]["operator_feeds"]
    assert read[24]["image"] == read[8]["image"] and read[24]["operator_feeds"] == read[8]["operator_feeds"]
