"""Ids and texts against the library itself."""

import random

import public_tokenizers
import pytest
import sentencepiece

from junctura.llm import pieces
from junctura.llm.pieces import encode_decode, marked_words

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "\n", "\n\n a", " a", "a ", "a  b   c", "▁x▁ y", "▁", "é́e", "中文 字", "😀‍😀 ok", "\x00\t a\x1f", "a\n \nb", "<s> </s> <0x0A>", "�\xa0b", "\r\nx", "ﬁ Å"]


def test_matches_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = random.Random(4)
    rows = [(i, t, 1.5) for i, t in enumerate(ODD)] + [(500, None, None), (None, "null id", 1.0), (3, "\n", 2.0), (3, "\n", 2.0)]
    for i in range(120):
        rows.append((1000 + i, "".join(r.choice(["the", "Ing", " ", " ", "\n", "é", ".", "字", "99", "▁", "  "]) for _ in range(r.randint(0, 80))), 0.0))
    df = spark.createDataFrame(rows, "doc_id long, text string, ids double")
    got = sorted(((x.doc_id, list(x.ids), x.decoded) for x in encode_decode(df, MODEL, block_bytes=900, bucket_bytes=4000).collect()), key=str)
    want = sorted(((i, ids := sp.encode(t or "", add_eos=True), sp.decode(ids)) for i, t, _ in rows), key=str)
    assert got == want


def test_words_cover_the_text():
    assert "".join(marked_words("a  b\n\nc ")) == " a  b\n\nc "


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert encode_decode(df, MODEL).collect() == []
    long = "word " * 50000
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    row = encode_decode(spark.createDataFrame([(1, long)], "doc_id long, text string"), MODEL).first()
    assert list(row.ids) == sp.encode(long, add_eos=True) and row.decoded == long


class Fake:
    """A model of given pieces, as the library would show it."""

    def __init__(self, pieces, real=None):
        self.pieces, self.real = pieces, real

    def get_piece_size(self):
        return len(self.pieces)

    def id_to_piece(self, i):
        return self.pieces[i]

    def is_control(self, i):
        return self.pieces[i] == "</s>"

    def is_unknown(self, i):
        return self.pieces[i] == "<unk>"

    def is_byte(self, i):
        return self.pieces[i].startswith("<0x")

    def encode(self, text, **_):
        return self.real.encode(text) if self.real else [[0]] * len(text) if isinstance(text, list) else [0]

    def decode(self, ids):
        return " ⁇ " * len(ids)


def test_crossing_models_are_refused(monkeypatch):
    real = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    with open(MODEL, "rb") as f:
        pieces.check_model(f.read())
    for bad in (["<unk>", "a▁b"], ["</s>", "▁the▁end"], ["x\ny"]):
        monkeypatch.setattr(pieces, "_processor", lambda proto, bad=bad: Fake(bad, real))
        with pytest.raises(ValueError, match="crosses a whitespace marker"):
            pieces.check_model(b"")
    # spaces that collapse
    monkeypatch.setattr(pieces, "_processor", lambda proto: Fake(["▁a"]))
    with pytest.raises(ValueError, match="repeated spaces"):
        pieces.check_model(b"")


def test_query_matches_library(spark):
    import hashlib

    import pyarrow.parquet as pq

    from junctura.llm.queries import op6_sentencepiece

    sf, sp, want = "/root/testdata/sf0.001", sentencepiece.SentencePieceProcessor(model_file=MODEL), []
    for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        ids = sp.encode(r["text"] or "", add_eos=True)
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(tuple(r) for r in op6_sentencepiece(spark, sf).collect()) == sorted(want)


def test_unknown_pieces_and_caches():
    stuff, width = pieces._piece_bytes(Fake(["<unk>", "</s>", "<0x0A>", "▁a"]))
    assert stuff.tobytes() == " ⁇ \n a".encode() and width.tolist() == [5, 0, 1, 2]
    with open(MODEL, "rb") as f:
        proto = f.read()
    pieces._processor(proto)
    assert all(len(k) == 32 for k in pieces._models)


def test_probes_refuse_models_that_normalise_line_feeds(monkeypatch):
    real = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    class Normalising(Fake):
        def encode(self, text, **_):
            flat = lambda t: self.real.encode(t.replace("\n", " ").strip(" "))
            return [flat(t) for t in text] if isinstance(text, list) else self.real.encode(text.replace("\n", " "))

        def id_to_piece(self, i):
            return self.real.id_to_piece(i)

        def get_piece_size(self):
            return 1

        def piece_to_id(self, piece):
            return self.real.piece_to_id(piece)

    monkeypatch.setattr(pieces, "_processor", lambda proto: Normalising(["<unk>"], real))
    with pytest.raises(ValueError, match="word by word"):
        pieces.check_model(b"")
