import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_frames import docs_frame, library_ids, vocabulary
from twintally.llm import genetic_packing, repair_tokens, separator_scan
from twintally.llm.unit_tokens import UnitTokenizer

LETTERS = list("abcXYZ  \n\t'sré0123 ,.!?<|>ßñİΣÀé中文\r\x0b_#") + [" ", "　", " ", "\x85", "'ll", "<|endoftext|>", "\x1c"]
LONG = " ".join(f"w{i % 97} thing" for i in range(9000))
ROWS = [(5, "Hello world, it's", "a"), (1, None, "a"), (3, "", None), (3, "", None), (2, "tie tie tie " * 40, "b"),
        (9, LONG, "b"), (None, "no id", "b"), (4, "a b c d e f g h " * 300, "c")]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name,mode", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "spaced")])
def test_units_equal_the_library(name, mode):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 50))) for _ in range(1500)] + [None, "", " ", LONG]
    for plain in (False, True):
        coder = UnitTokenizer(vocabulary(name), mode, table_units=300, plain_specials=plain)
        col = pa.array(texts, pa.large_string()).cast(pa.large_binary())
        for at in range(0, len(texts), 400):
            ids, sizes = coder.encode(col.slice(at, 400))
            run = np.append(0, np.cumsum(sizes))
            for i, t in enumerate(texts[at:at + 400]):
                assert ids[run[i]:run[i + 1]].tolist() == library_ids(name, t, plain), repr(t)


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    for _ in range(80):
        n = int(rng.integers(0, 500))
        ids = rng.integers(0, rng.integers(1, 7), n).astype(np.uint32)
        at = np.concatenate([[0], np.sort(rng.integers(0, n + 1, 6)), [n]])
        symbols, where, rules, length = repair_tokens.compress(ids, at, min_count=2)
        assert len(symbols) <= n
        shard = {"rules": rules.tobytes(), "rule_length": length.tobytes(), "symbols": symbols.tobytes(), "symbol_at": where}
        for k in range(7):
            assert (repair_tokens.read_document(shard, k) == ids[at[k]:at[k + 1]]).all()


def test_grammar_compresses_repetition():
    ids = np.tile(np.arange(50, dtype=np.uint32), 2000)
    symbols, *_ = repair_tokens.compress(ids, np.array([0, len(ids)]))
    assert len(symbols) < len(ids) / 20


def test_shards_match_a_plain_encoding(spark):
    docs = docs_frame(spark, ROWS, "start part n_tokens")
    got = repair_tokens.read_shards(repair_tokens.write_shards(docs, vocabulary("word_bpe_49k.json"), shard_ids=500,
                                                               min_count=4)).collect()
    want, start = [], 0
    for i, t, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library_ids("word_bpe_49k.json", t) + [1]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=str) == sorted(want, key=str)
    empty = repair_tokens.read_shards(repair_tokens.write_shards(docs.limit(0), vocabulary("word_bpe_49k.json")))
    assert empty.count() == 0


@pytest.mark.parametrize("block_ids", [7, 1000, 1 << 18])
def test_separators_are_stitched_over_blocks(spark, monkeypatch, block_ids):
    monkeypatch.setattr(separator_scan, "SEGMENT_BLOCKS", 3)
    rows = [r for r in ROWS if r[1] is not LONG] + [(11, "ends <|endoftext|> inside", "a")]
    docs = docs_frame(spark, rows, "file block names")
    got = separator_scan.count_tokens(docs, vocabulary("byte_bpe_50k.json"), 50256, block_ids=block_ids).collect()
    want = [(i, len(library_ids("byte_bpe_50k.json", t, True))) for i, t, _ in rows]
    assert sorted([(r.doc_id, r.n_tokens) for r in got], key=str) == sorted(want, key=str)


def test_raw_flat_files(spark, tmp_path):
    ids = [5, 6, 9, 9, 7, 9, 8, 8, 8, 8, 8, 8, 8]
    (tmp_path / "a.bin").write_bytes(np.array(ids, "<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    (tmp_path / "c.bin").write_bytes(np.array([1, 2, 9], "<u2").tobytes())
    blocks = separator_scan.read_flat_files(spark, str(tmp_path), block_ids=2)
    got = {(r.file[-5:], r.ordinal, r.start, r.n_tokens, r.ended) for r in separator_scan.scan_documents(blocks, 9).collect()}
    assert got == {("a.bin", 0, 0, 2, True), ("a.bin", 1, 3, 0, True), ("a.bin", 2, 4, 1, True), ("a.bin", 3, 6, 7, False),
                   ("c.bin", 0, 0, 2, True)}


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_whole_and_gapless(spark):
    docs = docs_frame(spark, ROWS, "uid size bin shard")
    got = genetic_packing.pack_documents(docs, vocabulary("byte_bpe_50k.json")).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    total = 0
    for i, t, _ in ROWS:
        ids = library_ids("byte_bpe_50k.json", t) + [0]
        total += len(ids)
        if i == 3:
            assert len(pieces[3]) == 2          # a repeated row is packed again
            continue
        at = 0
        for k, p in enumerate(sorted(pieces[i], key=lambda p: p.piece)):
            assert (p.piece, p.start) == (k, at) and p.ids_crc32 == crc(ids[at:at + p.length])
            assert p.length == 2048 or k == 0
            at += p.length
        assert at == len(ids)
    assert check_packing(got, 2048) == -(-total // 2048)
    assert genetic_packing.pack_documents(docs.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0


def test_packing_against_bounds(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(1)
    sizes = np.concatenate([rng.integers(1, 2049, 1500), np.full(300, 683), np.full(200, 1025)])
    items = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "uid long, size int")
    placed = genetic_packing.pack(items, 2048, shard_items=700).join(items, "uid")
    rows = placed.withColumn("length", F.col("size")).collect()
    assert len(rows) == len(sizes) and len({r.uid for r in rows}) == len(sizes)
    first_fit = len(genetic_packing.best_fit(np.argsort(-sizes, kind="stable").tolist(), sizes.tolist(), 2048))
    assert check_packing(rows, 2048) <= first_fit + 3      # shards apart cost at most one sequence each


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 100, 300).tolist()
    a = genetic_packing.best_fit(list(range(300)), sizes, 100)
    b = genetic_packing.best_fit(sorted(range(300), key=lambda i: -sizes[i]), sizes, 100)
    for child in (genetic_packing.crossover(a, b, sizes, 100, rng), genetic_packing.mutate(a, sizes, 100, rng)):
        assert sorted(i for items, _ in child for i in items) == list(range(300))
        assert all(sum(sizes[i] for i in items) + room == 100 and room >= 0 for items, room in child)


def test_pair_kinds_as_numpy_has_them():
    from twintally.llm.repair_tokens import _kinds

    rng = np.random.default_rng(3)
    for pair in (rng.integers(0, 1 << 63, 5000).astype(np.uint64) % np.uint64(97) << np.uint64(33), np.zeros(0, np.uint64)):
        for got, want in zip(_kinds(pair), np.unique(pair, return_inverse=True, return_counts=True)):
            assert np.array_equal(got, want)


def test_unit_ids_end_to_end_match_the_tokenizer():
    """New units are cut and looked up in one go; those with the separator, other scripts or special
    strings lie between plain ones, and a full table of pieces is begun anew."""
    import public_tokenizers

    words = ["plain", "don't", "a\x00b", "Ünder", "日本語x", "12ab", "_x_", "<|endoftext|>", "x日", "\x00", "İst", "plain2", "ß"]
    for file, mode, lead in (("word_bpe_49k.json", "word", ""), ("byte_bpe_50k.json", "spaced", " ")):
        units = [(lead + w).encode() for w in words] + [b"ab\xc3", b"end"]
        coder = UnitTokenizer(public_tokenizers.path(file), mode, table_pieces=6)
        for some in (units, units[::-1], units[:1], units[2:3]):
            flat, n = coder._ids_of(some)
            want = [coder.tokenizer.encode(u.decode("utf-8", "replace"), add_special_tokens=False).ids for u in some]
            assert n.tolist() == [len(x) for x in want]
            assert flat.tolist() == [i for x in want for i in x]
