"""Token files: round trip against the library."""

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from junctura.llm.elias_fano import EliasFano
from junctura.llm.token_files import TokenFile, check_spec, pack, read_token_files, write_token_files

SPEC = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n,top", [(0, 0), (1, 0), (1, 10**12), (1000, 50), (5000, 10**6), (700, 2**40)])
def test_elias_fano(n, top):
    v = np.sort(np.random.default_rng(n).integers(0, top + 1, n)).astype(np.uint64)
    blob = EliasFano.encode(v).tobytes()
    got, size = EliasFano.frombytes(blob + b"more")
    assert size == len(blob)
    assert (got.select(0, n) == v).all()
    for a in range(0, n, max(1, n // 37)):
        assert (got.select(a, min(n, a + 3)) == v[a : a + 3]).all()
    if n >= 1000:
        assert len(blob) < 8 * n * 0.6


def test_file():
    ids = np.arange(70000, 70010, dtype=np.uint32)
    f = TokenFile(pack(np.array([-5, 2**40]), 1, np.array([3, 0, 7]), ids))
    assert f.doc_ids(0, 3) == [None, -5, 2**40] and f.doc_ids(1, 2) == [-5]
    assert f.tokens(2).tolist() == ids[3:].tolist() and f.tokens(1).tolist() == []


def test_matches_library(spark):
    t = Tokenizer.from_file(SPEC)
    r = random.Random(2)
    odd = ["", " ", "it's I'LL", "a\x1fb\xa0c d​e", "é é́ Å ΑΣ", "<|endoftext|>x <|startoftext|>", "12345 ③", "\n\n", "İx", "don't<|endoftext|>", "Hello, WORLD!! it's.'s x.'S end.", "a.\u0301 b,\u0301 e\u0301. =\u0338", "İ. ß! Ǆ; ﬁ. ①. ²,", "<|endoftext|>. <|endoftext|", "é. É, ñ:"]
    rows = [(3 * i - 9, x) for i, x in enumerate(odd)] + [(None, "no id"), (77, None)]
    rows += [(1000 - i, "".join(r.choice(["the ", "Ing", "\n", "é.", "字", "'s", " 9"]) for _ in range(r.randint(0, 90)))) for i in range(300)]
    index = write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), SPEC, 2, part_bytes=4000)
    assert index.count() > 3
    got = read_token_files(index).collect()
    want, at = [], 0
    for i, x in sorted(rows, key=lambda x: (x[0] is not None, x[0])):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        want.append((i, at, ids))
        at += len(ids)
    assert sorted(((x.doc_id, x.start, np.frombuffer(x.ids, "<u4").tolist()) for x in got), key=lambda x: x[1]) == want


def test_empty(spark):
    index = write_token_files(spark.createDataFrame([], "doc_id long, text string"), SPEC, 2)
    assert read_token_files(index).collect() == []


def test_files_are_cut(spark):
    t = Tokenizer.from_file(SPEC)
    rows = [(7 * i % 101, f"word{i} " * (i % 13)) for i in range(101)]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "doc_id long, text string, ids string, start int")
    index = write_token_files(df, SPEC, 2, file_ids=50, rows_a_turn=5)
    steps = sorted((r.part, r.step, r["first"]) for r in index.collect())
    assert len({p for p, *_ in steps}) == 1 and len(steps) > 8 and [s for _, s, _ in steps] == list(range(len(steps)))
    assert [f for *_, f in steps] == sorted(f for *_, f in steps)
    at, got = 0, sorted(read_token_files(index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == list(range(101))
    for r in got:
        ids = t.encode(dict(rows)[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (at, len(ids), ids)
        at += len(ids)


def test_query_matches_library(spark):
    import pyarrow.parquet as pq

    from junctura.llm.queries import op8_token_files

    sf, t, at, want = "/root/testdata/sf0.001", Tokenizer.from_file(SPEC), 0, []
    for r in sorted(pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist(), key=lambda r: r["doc_id"]):
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in op8_token_files(spark, sf).collect()) == want


def test_unsuitable_tokenizers_are_refused():
    with open(SPEC, encoding="utf-8") as f:
        spec = json.load(f)
    check_spec(json.dumps(spec))
    for key, value in (
        ("normalizer", None),
        ("normalizer", {"type": "Sequence", "normalizers": [{"type": "Lowercase"}, {"type": "Strip", "strip_left": True, "strip_right": True}]}),
        ("pre_tokenizer", {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}),
        ("pre_tokenizer", {"type": "Split", "pattern": {"Regex": "\\s?\\w+"}, "behavior": "Removed", "invert": True}),
        ("pre_tokenizer", {"type": "Split", "pattern": {"Regex": "\\s+|\\w+"}, "behavior": "Removed", "invert": True}),
        ("post_processor", {"type": "ByteLevel"}),
    ):
        with pytest.raises(ValueError):
            check_spec(json.dumps(spec | {key: value}))


def test_one_id_fills_many_parts(spark):
    rows = [(None if i % 2 else 7, f"text {i}") for i in range(3_000)]
    starts = []
    for n in (3, 7):
        index = write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), SPEC, 2, part_bytes=4_000)
        assert index.groupBy("part").sum("docs").agg({"sum(docs)": "max"}).first()[0] < 1_500
        starts.append(sorted((x.start, x.n_tokens, bytes(x.ids)) for x in read_token_files(index).collect()))
    assert starts[0] == starts[1] and len(starts[0]) == 3_000
