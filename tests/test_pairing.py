"""One-to-one fallback pairing: invariants and a row-level greedy check."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

from helpers import CHURN_DDL, PARTNER_DDL, PLATFORM_DDL, frames, i_row, p_row
from twintally.config import ReconConfig
from twintally.operators.pairing import OneToOneMatch, greedy_allocate, rank_within, tolerance_chains
from twintally.operators.reconcile import matcher
from twintally.plans.queries import QUERIES
from twintally.sources import fixture


def _tol(p, i):
    d = abs(p - i)
    return d <= Decimal("0.01") or d <= Decimal("0.005") * max(abs(p), Decimal("0.01"))


def row_greedy(prow, irow):
    """Plain row-level greedy: exact pairs first, then smallest distance."""
    edges = []
    for a, pr in enumerate(prow):
        for b, ir in enumerate(irow):
            if (pr[0], pr[3], pr[9]) == (ir[0], ir[2], ir[9]) and _tol(pr[5], ir[7]):
                edges.append((abs(pr[5] - ir[7]), pr[5], ir[7], pr[1], ir[1], a, b))
    edges.sort()
    up, ui, out = set(), set(), []
    for e in edges:
        if e[5] not in up and e[6] not in ui:
            up.add(e[5]); ui.add(e[6]); out.append((e[1], e[2]))
    return Counter(out)


def _random_case(seed, n_p=120, n_i=90):
    rnd = random.Random(seed)
    prices = [Decimal("99.00"), Decimal("99.40"), Decimal("100.00"), Decimal("100.30"), Decimal("150.00")]
    prow = [p_row(f"p{n:03d}", rnd.choice(prices), op=rnd.choice(["telco_a", "telco_b"])) for n in range(n_p)]
    irow = [i_row(f"e{n:03d}", rnd.choice(prices), None, op=rnd.choice(["telco_a", "telco_b"])) for n in range(n_i)]
    return prow, irow


def test_one_to_one_matches_row_level_greedy(spark):
    prow, irow = _random_case(3)
    p, i, _ = frames(spark, prow, irow)
    m = OneToOneMatch(p, i, ReconConfig(pairing="one_to_one"))
    fb = m.fallback.collect()
    ids = [r["platform_event_id"] for r in fb]
    assert len(ids) == len(set(ids))                       # each platform row at most once
    assert all(_tol(r["partner_amount"], r["internal_amount"]) for r in fb)
    got = Counter((r["partner_amount"], r["internal_amount"]) for r in fb)
    assert got == row_greedy(prow, irow)
    # every partner remainder row is classified exactly once
    f = m.classified.where("recon_status IN ('MATCHED', 'MISSING_ON_PLATFORM')")
    assert f.count() == len(prow)


def test_chunked_ranks_are_a_permutation(spark):
    rows = [("g", f"id{n:04d}") for n in range(500)] + [("h", f"x{n}") for n in range(7)]
    df = spark.createDataFrame(rows, "g string, id string")
    r = rank_within(df, ["g"], ["id"], chunk_rows=64).collect()
    by = {}
    for row in r:
        by.setdefault(row["g"], []).append(row["_rank"])
    assert sorted(by["g"]) == list(range(1, 501))
    assert sorted(by["h"]) == list(range(1, 8))


def test_one_to_one_with_hot_group_chunks(spark):
    prow, irow = _random_case(5, 200, 150)
    p, i, _ = frames(spark, prow, irow)
    m = OneToOneMatch(p, i, ReconConfig(pairing="one_to_one"))
    m.chunk_rows = 8
    fb = m.fallback.collect()
    ids = [r["platform_event_id"] for r in fb]
    assert len(ids) == len(set(ids))
    assert Counter((r["partner_amount"], r["internal_amount"]) for r in fb) == row_greedy(prow, irow)


def test_greedy_allocate_prefers_smallest_distance():
    D = Decimal
    out = greedy_allocate([(D("100.00"), 3, 0), (D("100.30"), 0, 2), (D("99.80"), 0, 1), (D("200.00"), 1, 0)],
                          ReconConfig())
    assert out == [(D("100.00"), D("99.80"), 1, 0, 0), (D("100.00"), D("100.30"), 2, 1, 0)]


def plain_chains(amounts):
    """First amount of the chain of each amount, one key, row by row."""
    out, start = {}, None
    for before, a in zip([None, *sorted(amounts)], sorted(amounts)):
        if before is None or (a - before > Decimal("0.01")
                              and a - before > Decimal("0.005") * max(abs(a), abs(before), Decimal("0.01"))):
            start = a
        out[a] = start
    return out


def test_chains_of_random_amounts(spark):
    rnd = random.Random(11)
    of = {}
    for key, (low, high, n) in {"dense": (9000, 11000, 900), "wide": (-200000, 900000, 300), "tiny": (-9, 9, 12),
                                "one": (5, 6, 1), "zero": (-1, 1, 2), "minus": (-30000, -20000, 400)}.items():
        of[key] = {Decimal(rnd.randint(low, high)) / 100 for _ in range(n)}
    rows = [(k, a) for k, amounts in of.items() for a in amounts] + [("dense", None), (None, Decimal(1))]
    df = spark.createDataFrame(rows, "k string, amount decimal(12,2)")
    got = {(r["k"], r["amount"]): r["chain"] for r in tolerance_chains(df, ["k"]).collect()}
    assert got == {(k, a): c for k, amounts in of.items() for a, c in plain_chains(amounts).items()}


def test_no_valid_pair_leaves_its_chain():
    rnd = random.Random(4)
    for _ in range(200):
        base = rnd.choice([0, 1, 10, 100, -100, 5000])
        amounts = {Decimal(base) + Decimal(rnd.randint(-300, 300)) / 100 for _ in range(25)}
        chain = plain_chains(amounts)
        assert all(chain[p] == chain[i] for p in amounts for i in amounts if _tol(p, i))


def test_chains_of_many_amounts_allocate_like_rows(spark):
    """Leftovers of several chains, days and operators in one pass, over Arrow batches of a few rows."""
    rnd = random.Random(8)
    cents = lambda: Decimal(rnd.choice([9900, 10000, 30000, 70000]) + rnd.randint(-90, 90)) / 100
    days = [dt.date(2024, 1, 15), dt.date(2024, 1, 16)]
    prow = [p_row(f"p{n:03d}", cents(), op=rnd.choice(["telco_a", "telco_b"]), bd=rnd.choice(days)) for n in range(240)]
    irow = [i_row(f"e{n:03d}", cents(), None, op=rnd.choice(["telco_a", "telco_b"]), bd=rnd.choice(days)) for n in range(200)]
    p, i, _ = frames(spark, prow, irow)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        m = OneToOneMatch(p, i, ReconConfig(pairing="one_to_one"))
        assert m.allocations.count() > 20
        got = Counter((r["partner_amount"], r["internal_amount"]) for r in m.fallback.collect())
    finally:
        spark.conf.set(size, old)
    assert got == row_greedy(prow, irow)


def test_tolerance_query_equals_row_level_greedy(spark):
    sf = "/root/testdata/sf0.001"
    f = fixture.load(spark, sf)
    m = matcher(f.partner_events(), f.platform_events(), ReconConfig(pairing="one_to_one"))
    prow = [(r["operator_code"], r["partner_txn_id"], None, r["txn_type"], None, r["amount"], None, None, None, r["business_date"])
            for r in m._p_in.collect()]
    irow = [(r["operator_code"], r["platform_event_id"], r["txn_type"], None, None, None, None, r["amount"], None, r["business_date"])
            for r in m._i_in.collect()]
    rows = QUERIES["match_fallback_one_to_one_tolerance"](spark, sf).collect()
    got = Counter((r["partner_amount"], r["internal_amount"]) for r in rows)
    assert got == row_greedy(prow, irow)
    assert sum(n for (a, b), n in got.items() if a != b) > 0           # the remainder has work to do
    assert len({r["platform_event_id"] for r in rows}) == len(rows)


def test_no_leftovers_and_empty_sides(spark):
    for prow, irow in (([], []), ([p_row("p1", "10.00")], []), ([], [i_row("e1", "10.00")])):
        p, i, _ = (spark.createDataFrame(rows, schema) for rows, schema in ((prow, PARTNER_DDL), (irow, PLATFORM_DDL), ([], CHURN_DDL)))
        m = OneToOneMatch(p, i, ReconConfig(pairing="one_to_one"))
        assert m.allocations.count() == 0 and m.fallback.count() == 0
