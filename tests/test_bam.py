"""BAM files against SAM text of the same records."""

import random
import re
import struct
import zlib

import pytest

from junctura.sources import bam as B
from junctura.sources import binary
from junctura.sources import text as IO

SIZES = [("chr1", 5_000_000), ("chr2", 90_000), ("chrM", 16_000)]


def rows_of(n=6_000):
    r = random.Random(1)
    rows = []
    for i in range(n):
        chrom, size = r.choice(SIZES[:2] + SIZES[:1] * 4)
        k = r.randint(1, 150)
        cigar = r.choice([f"{k}M", f"{k}M{r.randint(1, 90_000)}N5M", f"3S{k}M2I4M", f"{k}=1X7D2M"])
        length = {"S": 3}.get(cigar[1], 0) + sum(int(x[:-1]) for x in re.findall(r"\d+[MIS=X]", cigar)) - (3 if cigar[1] == "S" else 0)
        seq = "".join(r.choices("ACGTN", k=length))
        qual = "".join(chr(r.randint(33, 73)) for _ in seq) if i % 5 else "*"
        rows.append((f"read{i}", r.choice([0, 16, 99, 147]), chrom, r.randint(0, size - 100_000) if size > 100_000 else r.randint(0, 80_000), cigar, seq if i % 11 else "*", qual if i % 11 else "*", i % 7 if i % 3 else None, None if i % 4 else -3, "chr2,+5,10M,1;" if i % 10 == 0 else None))
    rows += [(f"un{i}", 4, "*", -1, "*", "ACGT", "IIII", None, None, None) for i in range(50)]
    return rows + [("long" * 50, 0, "chr1", 7, "90000M", "A" * 90_000, "*", None, None, None)]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("bam")
    rows = spark.createDataFrame(rows_of(), B.SCHEMA)
    sizes = spark.createDataFrame(SIZES, "chrom string, size long")
    B.write_bam(rows, sizes, f"file://{d}/many", 60_000)
    B.write_bam(rows.coalesce(1), sizes, f"file://{d}/one")
    return d


def key(rows):
    return sorted(map(tuple, rows), key=str)


def bare(folder, to):
    """The one largest file of a folder without its index."""
    uri, _ = max(binary.files(f"file://{folder}", ".bam"), key=lambda x: x[1])
    to.mkdir()
    (to / "x.bam").write_bytes(open(uri[7:], "rb").read())
    return f"file://{to}/x.bam", uri


def test_equal_to_sam_text(spark, written, tmp_path):
    want = rows_of()
    assert len(binary.files(f"file://{written}/many", ".bam")) > 3
    assert key(B.bam(spark, f"file://{written}/many").collect()) == key(want)
    lines = ["@HD\tVN:1.6"]
    for read, flag, tag, start, cigar, seq, qual, score, second, others in want:
        optional = [f"AS:i:{score}"] * (score is not None) + [f"XS:i:{second}"] * (second is not None) + [f"XA:Z:{others}"] * (others is not None)
        lines.append("\t".join([read, str(flag), tag, str(start + 1), "255", cigar, "*", "0", "0", seq, qual, *optional]))
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")
    assert key(IO.sam(spark, str(tmp_path / "x.sam")).collect()) == key(want)


def test_many_splits_lose_no_record(spark, written, tmp_path):
    path, indexed = bare(written / "one", tmp_path / "bare")
    whole = key(B.bam(spark, path).collect())
    for split in (3_000, 20_000, 70_000):
        for p in (path, indexed):
            d = B.bam(spark, p, split)
            assert key(d.collect()) == whole, (split, p)
        assert d.rdd.getNumPartitions() > 2
    assert B.bam(spark, path, 3_000).rdd.getNumPartitions() > 20


def test_regions_read_few_blocks(spark, written, tmp_path):
    _, indexed = bare(written / "one", tmp_path / "bare")
    everything = B.bam(spark, f"file://{written}/one")
    for chrom, start, end in [("chr1", 1_000_000, 1_000_500), ("chr2", 0, 50), ("chr1", 4_899_000, 5_000_000), ("chrM", 0, 16_000), ("gone", 1, 2)]:
        got = B.bam_region(spark, f"file://{written}/one", chrom, start, end)
        assert key(got.collect()) == key(IO.region_reads(everything, chrom, start, end).collect())
    with binary.Ranges(indexed) as r:
        blocks = B.Blocks(r)
        total, at = 0, 0
        while at < r.size:
            _, at = blocks.load(at)
            total += 1
        blocks.count = 0
        for part in B._Reader({"path": indexed, "regions": '[["chr1", 1000000, 1000500]]'}).partitions():
            seen = [p for _, places in B._wanted(blocks, part) for p in places]
        assert seen and 0 < blocks.count < total / 2


def test_bins():
    r = random.Random(3)
    for _ in range(2_000):
        s = r.randint(0, 1 << 28)
        e = s + r.choice([1, 100, 1 << 14, 1 << 17, 1 << 25])
        own = B.bin_of(s, e)
        assert own in set(B.bins_of(s, e))
        q = s + r.randint(0, e - s - 1)
        assert own in set(B.bins_of(q, q + 1))


def test_damage_is_seen(spark, written, tmp_path):
    path, _ = bare(written / "one", tmp_path / "bare")
    blob = bytearray(open(path[7:], "rb").read())
    with pytest.raises(ValueError, match="not a BAM"):
        (tmp_path / "y.bam").write_bytes(_block(b"SAM text"))
        with binary.Ranges(str(tmp_path / "y.bam")) as r:
            B.header(B.Blocks(r))
    blob[5_000] ^= 0xFF
    (tmp_path / "z.bam").write_bytes(blob)
    with pytest.raises(Exception):  # noqa: B017
        B.bam(spark, str(tmp_path / "z.bam")).collect()


def _block(data):
    press = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = press.compress(data) + press.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], B.SCHEMA)
    B.write_bam(none, spark.createDataFrame(SIZES, "chrom string, size long"), f"file://{tmp_path}/e")
    assert B.bam(spark, f"file://{tmp_path}/e").collect() == []


def test_read_pairs(spark):
    rows = [
        ("a", 0x1 | 0x40, "chr1", 5, "4M", "ACGT", "abcd", None, None, None),
        ("a", 0x1 | 0x80 | 0x10, "chr1", 50, "4M", "AACC", "abcd", None, None, None),
        ("a", 0x1 | 0x40 | 0x100, "chr2", 5, "4M", "ACGT", "abcd", None, None, None),
        ("a", 0x1 | 0x40 | 0x800, "chr2", 9, "2M2H", "AC", "ab", None, None, None),
        ("b", 0x10, "chr1", 5, "3M", "AAN", "xyz", None, None, None),
        ("c", 0x1 | 0x80, "*", -1, "*", "GG", "xx", None, None, None),
        ("d", 0x1 | 0x40, "chr1", 1, "2M", "*", "*", None, None, None),
    ]
    reads = B.read_pairs(spark.createDataFrame(rows, B.SCHEMA))
    first, second, single = (sorted(map(tuple, d.collect())) for d in B.paired(reads))
    assert first == [("a", "ACGT", "abcd")] and second == [("a", "GGTT", "dcba")]
    assert single == [("b", "NTT", "zyx"), ("c", "GG", "xx")]


def test_equal_cigars_are_parsed_once():
    B._operations.cache_clear()
    row = {"read": "r", "flag": 0, "tag": "c", "start": 5, "cigar": "3S10M4N2D5M", "score": 1, "seq": None, "qual": None, "second": None, "others": None}
    made = {B._record(row | {"start": s}, {"c": 0})[1:] for s in range(100)}
    assert made == {(0, s, s + 21) for s in range(100)} and B._operations.cache_info().misses == 1
    assert B._operations("*") == B._operations(None) == (b"", 0, 1)
