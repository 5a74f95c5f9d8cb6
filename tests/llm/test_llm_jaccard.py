import random

import numpy as np
from llm_frames import docs_frame, plain_components, shingles
from twintally.llm import jaccard_groups as J
from twintally.llm.components import components


def words(rnd, n):
    return [f"t{rnd.randint(0, 10**6)}" for _ in range(n)]


def edited(rnd, base, k):
    w = list(base)
    for _ in range(k):
        w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 10**9)}"
    return w


def corpus(seed=1):
    rnd = random.Random(seed)
    rows, i = [], 0
    passage = words(rnd, 50)

    def add(w):
        nonlocal i
        rows.append((i, " ".join(w), "s"))
        i += 1

    for _ in range(60):                                   # alone, some with a shared passage
        add(words(rnd, 80) + (passage if rnd.random() < 0.5 else []))
    for n, edits in ((40, 3), (25, 6), (12, 1)):          # copies of one text, near the threshold
        base = words(rnd, 120)
        for _ in range(n):
            add(edited(rnd, base, rnd.randint(0, edits)))
    chain = words(rnd, 200)                               # each links with the next only
    for _ in range(15):
        add(chain)
        chain = edited(rnd, chain, 4)
    for t in ("a b", "A  B", "a b c d", "b a", "a", "a"):
        add(t.split(" "))
    return rows


ODD = [(900, None, "s"), (901, "", "s"), (902, " \n", "s"), (900, None, "s"), (903, "x y z w v", "s"), (904, "X y\tz w v", "s")]


def test_components_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP_MEMBERS", 8)            # so that families span groups
    for seed in (1, 2):
        rows = corpus(seed) + ODD
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(docs_frame(spark, rows, "n k1 cid")).collect()}
        assert got == plain_components([(i, t) for i, t, _ in rows])


def test_links_without_the_star_pass(spark, monkeypatch):
    """The matrix alone finds every link."""
    rows = corpus(3)
    empty = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(J, "star_candidates", lambda classes: empty)
    monkeypatch.setattr(J, "BROADCAST_CLASSES", 0)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == plain_components([(i, t) for i, t, _ in rows])


def test_keep_one(spark):
    rows = corpus(4) + ODD + [(903, "x y z w v", "s"), (None, "x y z w v", "s"), (None, "own words of a row without id", "s"),
                              (0, "another text of id zero altogether new", "s")]
    docs = docs_frame(spark, rows, "n cid tokens")
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    want = plain_components([(i, t) for i, t, _ in corpus(4)])
    firsts = [i for i, (_, c) in want.items() if i == c]
    # 900 (twice alike), 901, 902 have no words; 903 stands for 904 and the row without id
    assert got == sorted([*firsts, 0, 900, 901, 902, 903, None], key=str)
    plain = docs_frame(spark, corpus(4))
    assert sorted(r.doc_id for r in J.keep_one(plain).collect()) == sorted(firsts)


def test_empty(spark):
    docs = docs_frame(spark, [(1, "a", "s")])
    assert J.near_duplicates(docs.limit(0)).count() == 0 and J.keep_one(docs.limit(0)).count() == 0
    assert [tuple(r) for r in J.near_duplicates(docs).collect()] == [(1, 1, 1)]


def test_sharing_filter_bound():
    """Linked sets share the promised number of first tokens, in any order of tokens."""
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = rng.choice(1000, n, replace=False)
        y = np.concatenate([x[rng.random(n) < 0.93], 2000 + rng.choice(1000, int(rng.integers(0, 1 + n // 6)), replace=False)])
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        assert both >= J.needed(len(x), len(y))
        first = lambda s: set(np.sort(s)[:J.first_tokens(len(s))].tolist())
        assert len(first(x) & first(y)) >= max(J.shared_first(len(x)), J.shared_first(len(y)))


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(9)
    chain = list(range(0, 300))
    rnd.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(300)}, **{1000 + i: 1000 for i in range(200)}}


def test_token_sets_fold_ascii_only(spark):
    import pyarrow as pa
    texts = ["A B C D E f", "a b c d e F", "É b c d e f", "é b c d e f", "one two", "ONE two", None]
    tokens, edges = J.token_sets(pa.array(texts, pa.large_string()).cast(pa.large_binary()))
    sets = [frozenset(tokens[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:])]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[0] == sets[1] and sets[2] != sets[3] and sets[4] == sets[5] and not sets[6]
