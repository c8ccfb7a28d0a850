"""bigWig files against the rows they were written from, and against bedGraph text."""

import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

from junctura.sources import bigwig as B
from junctura.sources import binary
from junctura.sources import text as IO

SIZES = [("chr1", 400_000), ("chr10", 90_000), ("chr2", 5_000), ("empty", 100)]


def rows_of(n=30_000):
    r = random.Random(1)
    rows, at = [], 0
    for i in range(n):
        at += r.randint(0, 5)
        size = r.randint(1, 12)
        rows.append(("chr1", at, at + size, round(r.uniform(-2, 2) * 64) / 64))
        at += size
    return rows + [("chr10", i * 10, i * 10 + 10, float(i % 7)) for i in range(900)] + [("chr2", 0, 5_000, 0.5), ("unlisted", 1, 2, 1.0)]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('bw')}/values"
    rows = rows_of()
    B.write_bigwig(spark.createDataFrame(rows, "chrom string, start int, end int, value double"), spark.createDataFrame(SIZES, "chrom string, size long"), path, 20_000)
    return path, [r for r in rows if r[0] != "unlisted"]


def test_whole_files(spark, written):
    path, rows = written
    assert len(binary.files(path, ".bw")) > 3
    assert sorted(map(tuple, B.bigwig(spark, path).collect())) == sorted(rows)
    assert {r.chrom: r["size"] for r in B.chrom_sizes(spark, path).collect()}["chr1"] == 400_000


def test_filters_prune_blocks(spark, written):
    path, rows = written
    some = B.bigwig(spark, path).where("chrom = 'chr1' and end > 100000 and start < 101000")
    assert sorted(map(tuple, some.collect())) == sorted(r for r in rows if r[0] == "chr1" and r[2] > 100_000 and r[1] < 101_000)
    reader = B._Reader({"path": path})
    list(reader.pushFilters([EqualTo(("chrom",), "chr1"), GreaterThan(("end",), 100_000), LessThan(("start",), 101_000)]))
    leaves = sum(len(batch) for p in reader.partitions() for batch in reader.read(p))
    assert 0 < leaves <= 3 * 1024 < len(rows)


def test_regions_read_only_their_blocks(spark, written):
    path, rows = written
    regions = spark.createDataFrame([("chr1", 5_000, 5_010), ("chr1", 5_005, 5_300), ("chr10", 88, 92), ("gone", 1, 5)], "chrom string, start int, end int")
    found = B.touched(regions, B.blocks(spark, path)).count()
    assert found in (2, 3) and B.blocks(spark, path).count() > 30
    got = sorted(map(tuple, B.values(spark, path, regions).collect()))
    assert len(got) <= found * 1024
    hit = lambda r: any(r[0] == c and r[1] < e and s < r[2] for c, s, e in (("chr1", 5_000, 5_300), ("chr10", 88, 92)))
    assert [r for r in got if hit(r)] == sorted(r for r in rows if hit(r))


def test_means_equal_those_of_text(spark, written, tmp_path):
    path, rows = written
    r = random.Random(2)
    regions = [(f"m{i}", c, s, s + r.randint(3, 30)) for i in range(300) for c, n in [r.choice(SIZES[:3])] for s in [r.randint(2, n - 40)]]
    regions += [("edge", "chr1", 1, 9), ("behind", "chr2", 4_980, 4_999), ("none", "chr1", 390_000, 390_020), ("gone", "chrX", 5, 9), ("empty", "empty", 10, 20)]
    d = spark.createDataFrame(regions, "me string, chrom string, start int, end int")
    spark.createDataFrame(rows, "chrom string, start int, end int, value double").write.option("sep", "\t").csv(str(tmp_path / "text"))
    want = {x.me: x["mean"] for x in IO.conservation(d, IO.bedgraph(spark, str(tmp_path / "text")), ["me"]).collect()}
    want |= dict.fromkeys(["edge", "behind"], 0.0)  # widened regions that leave their chromosome
    got = {x.me: x["mean"] for x in B.conservation(spark, d, path, ["me"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert got["gone"] == got["empty"] == got["none"] == 0.0 and any(got.values())
    assert {x["mean"] for x in B.conservation(spark, d, None, ["me"]).collect()} == {0.0}


@pytest.mark.parametrize("order", "<>")
def test_kinds_of_blocks(order):
    head = lambda kind, n: struct.pack(order + "IIIIIBBH", 3, 100, 160, 20, 5, kind, 0, n)
    fixed = head(3, 3) + struct.pack(order + "fff", 1, 2, 3)
    varied = head(2, 2) + struct.pack(order + "IfIf", 100, 1.5, 130, 2.5)
    chrom, s, e, v = B.decode(zlib.compress(fixed), True, order)
    assert (chrom, s.tolist(), e.tolist(), v.tolist()) == (3, [100, 120, 140], [105, 125, 145], [1, 2, 3])
    chrom, s, e, v = B.decode(varied, False, order)
    assert (s.tolist(), e.tolist(), v.tolist()) == ([100, 130], [105, 135], [1.5, 2.5])
    with pytest.raises(ValueError, match="kind of block"):
        B.decode(head(9, 0), False, order)


def test_other_files_are_refused(spark, tmp_path):
    (tmp_path / "x.bw").write_bytes(b"no bigWig at all" * 9)
    with pytest.raises(ValueError, match="not a bigWig"):
        B.chrom_sizes(spark, f"file://{tmp_path}/x.bw")
    with pytest.raises(FileNotFoundError):
        B.chrom_sizes(spark, f"file://{tmp_path}/none")


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "chrom string, start int, end int, value double")
    B.write_bigwig(none, spark.createDataFrame(SIZES, "chrom string, size long"), f"file://{tmp_path}/e")
    assert B.bigwig(spark, f"file://{tmp_path}/e").collect() == []


def test_many_chromosomes(spark, tmp_path):
    """More than a node of the tree can count, each with one value."""
    n = 70_000
    rows = spark.range(n).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("chrom"), F.lit(5).alias("start"), F.lit(9).alias("end"), (F.col("id") % 8).cast("double").alias("value"))
    path = f"file://{tmp_path}/many"
    B.write_bigwig(rows, rows.select("chrom", F.lit(20).alias("size")), path)
    assert rows.exceptAll(B.bigwig(spark, path)).isEmpty() and B.bigwig(spark, path).count() == n
    assert B.chrom_sizes(spark, path).where("size = 20").count() == n
    mes = rows.where("cast(substr(chrom, 2) as int) % 7 = 0").select(F.col("chrom").alias("me"), "chrom", "start", "end")
    assert B.conservation(spark, mes, path, ["me"]).join(rows.withColumnRenamed("chrom", "me"), "me").where("mean = value").count() == n // 7


def test_chromosome_tree_in_one_file(tmp_path):
    names = [(f"c{i:06}", i + 1) for i in range(70_000)]
    section = ((0, 5), (0, 9), zlib.compress(struct.pack("<IIIIIBBHIIf", 0, 5, 9, 0, 0, 1, 0, 1, 5, 9, 1.0)))
    binary.put(f"{tmp_path}/x.bw", B._file([section], names, 36, 1))
    with binary.Ranges(f"{tmp_path}/x.bw") as r:
        f = B.BigWig(r)
        assert f.chroms() == dict(enumerate(names)) and [x.size for x in f.children(f.root())] == [len(section[2])]
