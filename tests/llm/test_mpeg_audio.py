"""MPEG audio: round trips and damaged streams."""

import random

import pytest

from junctura.llm.mpeg_audio import checksum, decode_audio, encode_text, padded, parse_header, read, store


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1021, 1024, 5000, 300_000])
def test_round_trip(n):
    payload = padded(random.Random(n).randbytes(n))
    assert len(payload) % 64 == 0 and payload
    s = read(store(payload))
    assert s.payload == payload and s.bad == 0 and s.skipped == 0
    assert s.table.kind == "Xing" and s.table.frames == len(s.offsets) and len(s.table.offsets) == 100
    assert s.samples == 1152 * len(s.offsets) and s.hertz == 44100
    assert s.tags["title"] == "stored bytes"


def test_header_and_checksum():
    assert parse_header(b"\xff\xfb\x90\x00").size == 417
    assert parse_header(b"\xff\xf3\x80\xc0").hertz == 22050
    two, one = parse_header(b"\xff\xfd\x90\x00"), parse_header(b"\xff\xff\x92\x00")
    assert (two.layer, two.kbps, two.size, two.samples) == (2, 160, 522, 1152) and (one.layer, one.kbps, one.size, one.samples) == (1, 288, 316, 384)
    for bad in (b"\xff\xfb\xf0\x00", b"\xff\xfb\x9c\x00", b"\xff\xe9\x90\x00", b"\xff\xf9\x90\x00", b"abcd", b"\xff"):
        assert parse_header(bad) is None
    assert checksum(b"") == 0xFFFF and checksum(b"123456789") == 0xAEE7


def test_resynchronises_and_counts_errors():
    payload = padded(random.Random(1).randbytes(9000))
    media = bytearray(store(payload))
    s = read(bytes(media))
    at = s.offsets[3]
    media[at + 10] ^= 1  # side information
    media[at:at] = b"\xff\xfb noise \xff\xff"
    t = read(bytes(media))
    assert t.bad == 1 and t.skipped == len(b"\xff\xfb noise \xff\xff") and t.payload == payload
    assert [x for x in t.offsets if x < at] == s.offsets[:3]
    cut = read(bytes(media[: s.offsets[2] + 50]))
    assert len(cut.offsets) == 2
    assert read(b"").offsets == [] and read(b"\xff" * 100).offsets == []


def test_operator(spark):
    rows = [(1, "abc", 5), (2, None, 6), (3, "", 7), (4, "é" * 5000, 8), (4, "é" * 5000, 8), (None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, frames int")
    got = decode_audio(encode_text(df)).collect()
    want = sorted((str(i), padded((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.doc_id), bytes(r.payload)) for r in got) == want
    assert all(r.bad_checksums == 0 and r.table_frames == r.frames == len(r.seek) for r in got)
    assert decode_audio(encode_text(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def frame(rate=9, body=b"", four=None):
    four = four or bytes([0xFF, 0xFB, rate << 4, 0xC4])
    h = parse_header(four)
    return (four + bytes(h.side) + body).ljust(h.size, b"\0")


def tag(version, frames, flags=0, extra=b"", footer=b""):
    body = extra + b"".join(frames) + bytes(20)
    n = len(body)
    return b"ID3" + bytes([version, 0, flags]) + bytes(n >> s & 0x7F for s in (21, 14, 7, 0)) + body + footer


def safe(n):
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def test_foreign_tags():
    audio = frame() * 5
    long = b"\0" + b"t" * 300
    v3 = tag(3, [b"TIT2" + len(long).to_bytes(4, "big") + b"\0\0" + long, b"TPE1" + (7).to_bytes(4, "big") + b"\0\0" + b"\x01" + "é字".encode("utf-16")], 0x40, (6).to_bytes(4, "big") + bytes(6))
    s = read(v3 + audio)
    assert s.tags == {"TIT2": "t" * 300, "TPE1": "é字"} and s.skipped == 0 and len(s.offsets) == 5
    v4 = tag(4, [b"TIT2" + safe(301) + b"\0\0" + long, b"TXXX" + safe(8) + b"\0\0" + b"\x03key\0val", b"APIC" + safe(3) + b"\0\0abc", b"TALB" + safe(4) + b"\0\x0c" + b"\0zip"], 0x50, safe(6) + bytes(2), b"3DI" + bytes(7))
    s = read(v4 + audio)
    assert s.tags == {"TIT2": "t" * 300, "key": "val"} and s.skipped == 0 and len(s.offsets) == 5
    v2 = tag(2, [b"TT2" + (5).to_bytes(3, "big") + b"\0name", b"TXX" + (5).to_bytes(3, "big") + b"\0a\0bc"])
    assert read(v2 + audio).tags == {"TT2": "name", "a": "bc"}
    be = tag(4, [b"TIT2" + safe(5) + b"\0\0" + b"\x02" + "é字".encode("utf-16-be")])
    assert read(be + audio).tags == {"TIT2": "é字"}
    assert read(tag(3, [b"TIT2" + (3).to_bytes(4, "big") + b"\0\0\0a\xff\0b"[:5]], 0x80) + audio).offsets != []


def test_variable_bitrate_tables():
    rates = [9, 5, 14, 1, 9]
    audio = [frame(r) for r in rates]
    sizes = [len(x) for x in audio]
    steps = b"".join((n // 4).to_bytes(2, "big") for n in sizes)
    vbri = b"VBRI" + b"\0\1\0\0\0\0" + sum(sizes).to_bytes(4, "big") + (5).to_bytes(4, "big") + (5).to_bytes(2, "big") + (4).to_bytes(2, "big") + (2).to_bytes(2, "big") + (1).to_bytes(2, "big") + steps
    head = bytearray(frame())
    head[36 : 36 + len(vbri)] = vbri
    s = read(bytes(head) + b"".join(audio))
    assert (s.table.kind, s.table.frames, s.table.bytes) == ("VBRI", 5, sum(sizes)) and s.table.offsets[1] == sizes[0] // 4 * 4
    assert s.samples == 5 * 1152 and s.seconds == 5 * 1152 / 44100 and s.offsets == [len(head) + sum(sizes[:i]) for i in range(5)]
    only_toc = frame(body=b"Xing" + (4).to_bytes(4, "big") + bytes(range(100)))
    s = read(only_toc + b"".join(audio))
    assert (s.table.kind, s.table.frames, s.table.bytes, s.table.offsets) == ("Xing", None, None, []) and len(s.offsets) == 5
    info = frame(body=b"Info" + (2).to_bytes(4, "big") + (999).to_bytes(4, "big"))
    s = read(info + b"".join(audio))
    assert (s.table.kind, s.table.frames, s.table.bytes) == ("Info", None, 999) and len(s.offsets) == 5


def test_other_layers():
    for four, n, samples in ((b"\xff\xfd\x90\xc4", 7, 1152), (b"\xff\xff\x92\xc4", 9, 384)):
        s = read(b"junk" + frame(four=four) * n)
        assert (len(s.offsets), s.samples, s.skipped, s.bad) == (n, n * samples, 4, 0) and s.table is None


def test_query_columns(spark):
    import hashlib
    import zlib

    import pyarrow.parquet as pq

    from junctura.llm.queries import op9_mpeg_audio

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    rows = op9_mpeg_audio(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        payload = text + bytes(-len(text) % 64 or (64 if not text else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        # 320 kbit/s frames of 44.1 kHz have 1044 bytes, of which 6 + 17 are not the payload's, and one smaller frame holds the rest
        n = -(-len(payload) // 1021)
        assert len(r.seek_offsets) == n and r.duration_seconds == n * 1152 / 44100
        assert r.media_bytes > len(payload) and all(b - a == 1044 for a, b in zip(r.seek_offsets, r.seek_offsets[1:]))
