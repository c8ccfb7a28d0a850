"""Gzip files of many members: no line is lost or torn, whatever the cuts."""

import gzip
import random
import zlib

import pytest

from junctura.sources import binary
from junctura.sources import gz as Z
from junctura.sources import text as IO


def lines_of(n=4_000):
    r = random.Random(1)
    return ["".join(r.choices("abc\u00e9 ,", k=r.choice([0, 3, 40, 200]))) for _ in range(n)]


def blocked(data, size=3_000):
    """Blocked gzip: members that tell their length in an extra field."""
    out = b""
    for i in range(0, len(data) + 1, size):
        part = data[i : i + size]
        press = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = press.compress(part) + press.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(part).to_bytes(4, "little") + len(part).to_bytes(4, "little")
    return out


@pytest.mark.parametrize("kind", ["members", "blocked", "one", "stored"])
@pytest.mark.parametrize("end", ["\n", ""])
def test_every_line_once(spark, tmp_path, kind, end):
    lines = lines_of()
    data = ("\n".join(lines) + end).encode()
    if kind == "members":  # cut anywhere, lines and characters torn; some members are empty
        r, at, blob = random.Random(2), 0, b""
        while at < len(data):
            n = r.choice([0, 1, 500, 9_000])
            blob += gzip.compress(data[at : at + n])
            at += n
    elif kind == "stored":  # the data of a stored member look like members themselves
        inner = gzip.compress(b"inner text") * 3
        data = data.replace(b"\n", inner.replace(b"\n", b" ") + b"\n", 5)
        blob = gzip.compress(data[:9_000], 0) + gzip.compress(data[9_000:], 0)
    else:
        blob = blocked(data) if kind == "blocked" else gzip.compress(data)
    (tmp_path / "a.gz").write_bytes(blob)
    want = (data.removesuffix(b"\n") if end else data).split(b"\n")
    for split in (2_000, 30_000, 1 << 30):
        d = Z.gz_lines(spark, str(tmp_path / "a.gz"), split)
        if kind != "stored":
            got = [x.value for x in IO._numbered(d).orderBy("line").collect()]
            assert got == [x.decode() for x in want], (kind, split)
        else:
            assert d.count() == len(want)
    if kind in ("members", "blocked"):
        assert Z.gz_lines(spark, str(tmp_path / "a.gz"), 2_000).select("split").distinct().count() > 10


def test_fastq_of_one_blocked_file(spark, tmp_path):
    r = random.Random(3)
    reads = [(f"r{i}", "".join(r.choices("ACGT", k=r.randint(1, 150)))) for i in range(3_000)]
    text = "".join(f"@{i} x\n{s}\n+\n{'@' * len(s)}\n" for i, s in reads)
    (tmp_path / "r.fastq.gz").write_bytes(blocked(text.encode(), 60_000))
    d = IO.fastq(spark, str(tmp_path / "r.fastq.gz"), True, 4_000)
    assert sorted((x.id, x.seq) for x in d.collect()) == sorted(reads)
    parts = Z._Reader({"path": str(tmp_path / "r.fastq.gz"), "splitbytes": "4000"}).partitions()
    assert len(parts) > 8


def test_tables(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.gz").write_bytes(gzip.compress(f"a\tb c\n{i}\tx\n".encode()) + gzip.compress(b"9\t\n"))
    got = Z.gz_table(spark, str(tmp_path), 10)
    assert got.columns == ["a", "b c"] and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("0", "x"), ("9", None), ("1", "x"), ("9", None)]))


def test_damage_is_seen(tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"some text" * 100)[:-9])
    with binary.Ranges(str(tmp_path / "a.gz")) as r, pytest.raises(ValueError, match="ends inside"):
        list(Z._inflated(r, 0))
