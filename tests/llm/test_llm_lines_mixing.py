from collections import Counter

from llm_frames import WORD, docs_frame
from pyspark.sql import functions as F
from twintally.llm import line_dedup, mixing
from twintally.llm.common import id_hash

BANNER = "Subscribe to our letter"
PAGES = ([(i, f"{BANNER}\nunique line {i}\n  {BANNER}  \n\nlast {i}", "a") for i in range(20)]
         + [(100 + i, f"own {i}", "a") for i in range(20)] + [(200 + i, f"{BANNER}\nfree {i}", "b") for i in range(2)]
         + [(300, None, "a"), (301, "", None), (302, BANNER, "a"), (302, BANNER, "a"), (None, "x", None)])


RULE = ((line_dedup.RATIO, line_dedup.MIN_PAGES),)


def plain_lines(rows, rules=RULE):
    total, pages = Counter(), Counter()
    for _, t, h in rows:
        total[h] += 1
        for line in {x.strip(" \t\r") for x in (t or "").split("\n")} - {""}:
            pages[h, line] += 1
    bad = {k for k, n in pages.items() if any(n >= least and n > ratio * total[k[0]] for ratio, least in rules)}
    return sorted(((i, None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(" \t\r")) not in bad))
                   for i, t, h in rows), key=str)


def plain_once(rows, rules=RULE):
    """plain_lines with the lines counted over the distinct texts of a host."""
    texts_of = sorted({(t or "", h) for _, t, h in rows}, key=str)
    marks = plain_lines([(k, t, h) for k, (t, h) in enumerate(texts_of)], rules)
    clean = {texts_of[k]: t for k, t in marks}
    return sorted(((i, None if t is None else clean[t or "", h]) for i, t, h in rows), key=str)


def texts(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_lines_by_host(spark):
    docs = docs_frame(spark, PAGES, "host key pages line")
    for kept in (line_dedup.BROADCAST_LINES, 0):        # broadcast, and the way beyond it
        got = line_dedup.drop_boilerplate(docs, broadcast_lines=kept)
        assert got.columns == docs.columns
        assert texts(got) == plain_once(PAGES)
        assert texts(line_dedup.drop_boilerplate(docs, broadcast_lines=kept, copies_once=False)) == plain_lines(PAGES)
    report = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(docs, report=True).collect()}
    assert report[0] == (5, 2) and report[300] == (0, 0) and report[200] == (2, 0)
    assert line_dedup.drop_boilerplate(docs.limit(0)).count() == 0


def test_lines_on_other_ratios(spark):
    docs = docs_frame(spark, PAGES)
    for ratio in (0.0, 0.45, 1.0):
        assert texts(line_dedup.drop_boilerplate(docs, ratio=ratio)) == plain_once(PAGES, ((ratio, line_dedup.MIN_PAGES),))


COPIED = ([(i, "one copied text\nits second line\nits end", "hot") for i in range(20)]
          + [(100 + i, f"{BANNER}\nown line {i}", "hot") for i in range(40)]
          + [(200 + i, "a small group\nof copies", "small") for i in range(3)] + [(300 + i, f"page {i}", "small") for i in range(17)])


def test_copies_of_a_text_are_one_page(spark):
    """A third of a source, and 3 of 20 rows, are copies of one document: it stays, the banner goes."""
    docs = docs_frame(spark, COPIED, "host key keys a b pages line")
    got = texts(line_dedup.drop_boilerplate(docs))
    by = dict(got)
    assert by[0] == COPIED[0][1] and by[200] == "a small group\nof copies" and by[100] == "own line 0"
    assert got == plain_once(COPIED)
    assert texts(line_dedup.drop_boilerplate(docs_frame(spark, PAGES))) == plain_once(PAGES)


def test_working_names_give_way_to_columns(spark):
    """Columns with the operators' own working names, and names with a dot, pass through."""
    from twintally.llm import jaccard_groups

    names = "__line_bad __line_key __line_row __mix_below __mix_hash __mix_source __jac_id __jac_k1 a.b"
    docs = docs_frame(spark, [*PAGES, *COPIED[:5], *COPIED[:2]], names)
    for kept in (line_dedup.BROADCAST_LINES, 0):
        out = line_dedup.drop_boilerplate(docs, broadcast_lines=kept)
        assert out.columns == docs.columns and texts(out) == plain_once([*PAGES, *COPIED[:5], *COPIED[:2]])
        assert {r[-1] for r in out.collect()} == {"clash"}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r[-1] for r in mixed.collect()} == {"clash"}
    one = jaccard_groups.keep_one(docs)
    assert one.columns == docs.columns and {r[-1] for r in one.collect()} == {"clash"}
    assert sum(r.doc_id == 0 for r in one.collect()) == 2          # two texts share the id


def test_pipeline_keeps_a_copied_document(spark):
    import corpus_pipeline

    cleaned = corpus_pipeline.drop_lines(spark, docs_frame(spark, COPIED), "")
    assert texts(cleaned) == plain_once(COPIED)
    kept = dict(texts(corpus_pipeline.drop_near_duplicates(spark, cleaned, "")))
    assert kept[0] == COPIED[0][1] and kept[200] == "a small group\nof copies"
    assert not {*range(1, 20), 201, 202} & set(kept)


def test_common_lines_of_a_large_source(spark):
    """A line on 15 of 400 different pages goes in the pipeline, one on 8 stays; neither is near a tenth."""
    import corpus_pipeline

    rows = [(i, f"page {i}" + ("\nAll rights reserved" if i < 15 else "\nquoted" if i < 23 else ""), "big") for i in range(400)]
    rows += [(500 + i, f"leaf {i}" + ("\nShared" if i < 3 else ""), "small") for i in range(40)]
    got = dict(texts(corpus_pipeline.drop_lines(spark, docs_frame(spark, rows), "")))
    assert got == {i: t.replace("\nAll rights reserved", "") for i, t, _ in rows}


def plain_mix(rows):
    """Targets by the stated rule, then the nearest prefix in hash order by sorting."""
    import hashlib

    size = lambda t: len(WORD.findall(t or ""))
    h = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {n: sum(size(t) for _, t, s in rows if s == n) for n in names}
    weight = {n: (3, 1, 2)[k % 3] for k, n in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(total.values())
    while True:
        level = left / (sum(weight[n] for n in open_) or 1)
        over = {n for n in open_ if weight[n] * level > 2 * total[n]}
        if not over:
            break
        for n in over:
            target[n] = 2.0 * total[n]
            left -= target[n]
        open_ -= over
    target |= {n: weight[n] * level for n in open_}
    out = []
    for n in names:
        own = [(h(i), size(t), i) for i, t, s in rows if s == n]
        full = int(target[n] // total[n]) if total[n] else 0
        rest, run, taken = target[n] - full * total[n], 0, set()
        for k in sorted({x[0] for x in own}):
            group = sum(x[1] for x in own if x[0] == k)
            if group and 2 * run + group > 2 * rest:
                break
            run += group
            taken.add(k)
        out += [(i, s, total[n], round(target[n], 6), s * (full + (k in taken))) for k, s, i in own]
    return sorted(out, key=str)


MIXED = ([(i, "w " * (i % 13), "big") for i in range(400)] + [(500 + i, "a b c", "tiny") for i in range(5)]
         + [(600 + i, "x y " * 10, None) for i in range(60)] + [(700, None, "void"), (None, "no id", "big"), (3, "again a", "big")]
         + [(800 + i, "é ü", "Zed") for i in range(30)])


def test_mix_matches_a_sort(spark):
    docs = docs_frame(spark, MIXED, "size hash target full below budget")
    got = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mix_report(docs).collect()]
    assert sorted(got, key=str) == plain_mix(MIXED)
    assert all(r[4] <= 2 * r[1] for r in got)
    again = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mix_report(docs.repartition(3)).collect()]
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_mix_repeats_rows(spark):
    docs = docs_frame(spark, [r for r in MIXED if r[0] not in (3, None)], "size copies")
    taken = {r.doc_id: r.taken for r in mixing.mix_report(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert {r.doc_id: r.n for r in words if r.n} == {i: n for i, n in taken.items() if n}


def test_mix_of_nothing(spark):
    docs = docs_frame(spark, MIXED)
    assert mixing.mix_report(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = mixing.mix_report(docs_frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted((r.doc_id, r.size, r.taken, r.target) for r in blank) == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]


def test_no_python_on_the_native_paths(spark):
    docs = docs_frame(spark, PAGES)
    for frame in (line_dedup.drop_boilerplate(docs), mixing.mix(docs), mixing.mix_report(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_threshold_levels_agree(spark):
    docs = docs_frame(spark, MIXED)
    sizes = mixing.document_sizes(docs)
    targets = mixing.source_targets(sizes)
    rows = lambda bits: {(r.source, r.full, r.below) for r in mixing.thresholds(sizes, targets, bits).collect()}
    coarse, fine = rows(20), rows(6)
    pick = lambda limits: {(r.source, r.hash) for r in sizes.collect() if r.size and r.hash < {s: b for s, _, b in limits}[r.source]}
    assert pick(coarse) == pick(fine)
    assert id_hash is not None
