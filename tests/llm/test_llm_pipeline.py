import os

import corpus_pipeline as P
from twintally.llm import line_dedup
import pytest
from llm_frames import plain_components
from test_llm_lines_mixing import RULE, plain_mix, plain_once
from test_llm_quality import plain_base
from test_llm_tokens import check_packing, library_ids

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_each_stage_against_a_plain_version(spark):
    from twintally.llm.common import staged, table

    docs = table(spark, SF, "documents")
    start = docs.collect()
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    names = docs.columns

    def run(k, frame):
        out = staged(P.STAGES[k][1](spark, frame, SF), "test-stage")
        return out, out.collect()

    kept, rows = run(0, docs)
    assert kept.columns == names
    failed = {r.doc_id for r in start if (lambda b: b[0] < 50 or 100 * b[4] > 50 * b[0])(plain_base(r.text))}
    gone = {r.doc_id for r in start} - {r.doc_id for r in rows}
    assert failed <= gone
    assert not [i for i in gone - failed if labels.get(i) == 1]           # clean documents stay

    cleaned, lines = run(1, kept)
    assert cleaned.columns == names
    assert sorted(((r.doc_id, r.text) for r in lines), key=str) == plain_once(
        [(r.doc_id, r.text, r.source) for r in rows], (*RULE, *line_dedup.COMMON_RULES))
    assert all(r.n_chars == len(r.text) for r in lines if r.text is not None)

    unique, one = run(2, cleaned)
    assert unique.columns == names
    comp = plain_components([(r.doc_id, r.text) for r in lines])
    assert sorted(r.doc_id for r in one) == sorted(i for i, (_, c) in comp.items() if i == c)

    mixed, taken = run(3, unique)
    assert mixed.columns == names
    want = {i: n // s for i, s, _, _, n in plain_mix([(r.doc_id, r.text, r.source) for r in one]) if s}
    count = {}
    for r in taken:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert {i: c for i, c in count.items() if i in want} == {i: c for i, c in want.items() if c}

    _, pieces = run(4, mixed)
    total = sum(len(library_ids("byte_bpe_50k.json", r.text)) + 1 for r in taken)
    assert sum(r.length for r in pieces) == total
    assert check_packing(pieces, 2048) >= -(-total // 2048)

    whole = P.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, pieces))


def test_registration():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op")] + ["pipeline"]
    assert len(names) == 11 and {n.split("_")[0] for n in names[:10]} == {f"op{i}" for i in range(1, 11)}
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["op1_hamming_topk", "op4_line_dedup", "op6_mixing"])
def test_against_sql(spark, name):
    import __spark_entry__ as E
    from oracle_compare import compare, duck_connect

    got = compare(spark, duck_connect(SF), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert got["status"] == "MATCH", got
