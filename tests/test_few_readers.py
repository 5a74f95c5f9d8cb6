"""Cached pieces of a match are read by few tasks; landing text is compressed."""

import glob

from helpers import frames, i_row, p_row

from twintally.config import FEEDS, ReconConfig
from twintally.operators.matching import Match
from twintally.operators.pairing import OneToOneMatch
from twintally.sources import fixture, fixture_files, landing


def _sides(spark):
    partner = [p_row(f"p-{i}", 100 + i % 7) for i in range(300)] + [p_row(None, 100), p_row(None, 101)]
    platform = ([i_row(f"e-{i}", 100 + i % 7, key=f"p-{i}") for i in range(150)]
                + [i_row(f"n-{i}", 100 + i % 5) for i in range(90)] + [i_row("x", 5, key="none")])
    return frames(spark, partner, platform)[:2]


def _many_partitions(spark):
    return {"spark.sql.shuffle.partitions": "150", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _with(spark, conf, f):
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return f()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_tier_one_is_read_by_few_tasks(spark):
    def run():
        m = Match(*_sides(spark), persist=True)
        n = m.tier1.rdd.getNumPartitions()
        rows = sorted(map(str, m.classified.collect()))
        m.release()
        return n, rows

    n, rows = _with(spark, _many_partitions(spark), run)
    assert n <= max(4 * spark.sparkContext.defaultParallelism, 32)
    assert rows == sorted(map(str, Match(*_sides(spark), persist=False).classified.collect()))


def test_ranks_are_computed_once(spark):
    cfg = ReconConfig(pairing="one_to_one")
    m = OneToOneMatch(*_sides(spark), cfg, persist=True)
    got = sorted(map(str, m.classified.collect()))
    assert len(m._cached) == 3                      # tier 1 and the ranks of both sides
    m.release()
    assert got == sorted(map(str, OneToOneMatch(*_sides(spark), cfg, persist=False).classified.collect()))


def test_json_landing_files_are_compressed(spark, tmpdir_path):
    path = f"{tmpdir_path}/orders.parquet"
    spark.range(400).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus").write.parquet(path)
    fx = fixture.load(spark, tmpdir_path)
    zones = fixture_files.write_landing(fx, f"{tmpdir_path}/landing")
    for folder in (f"{zones['internal']}/sub_initial_telco_a", f"{zones['operator_feeds']}/telco_c"):
        files = glob.glob(f"{folder}/batch=*/part-*")
        assert files and all(f.endswith(".gz") for f in files)
    read = landing.scan_json_feed(spark, zones["operator_feeds"], FEEDS["telco_c"])
    rows = fx.partner_bronze().where("operator_code = 'telco_c'")
    assert read.count() == rows.count() + rows.where("dup").count()
