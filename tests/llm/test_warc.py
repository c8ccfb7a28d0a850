"""WARC archives against plain grouping, and range reads."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from junctura.llm.files import read
from junctura.llm.warc import parse, ranges, read_warc, record, write_warc

ROWS = [(1, "http://a/", "<p>x</p>", 1), (2, None, "<p>x</p>", 2), (5, "http://b/\nz", None, 3), (6, "u", "", 4), (7, "é", "é" * 100_000, 5), (9, "u", "<p>x</p>", 6), (9, "v", "<p>x</p>", 6), (None, "n", "<p>x</p>", 7), (None, "m", "alone", 8)]


def brute(rows, least=0):
    out = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        top = max((j for j, _, g, _ in rows if (g or "") == (h or "") and j is not None), default=None)
        again = len(b) >= least and top is not None and i != top
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_matches_brute_force(spark, least):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, top int").repartition(3)
    index = write_warc(df, least)
    got = read_warc(index)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=str) == brute(ROWS, least)
    for r in index.collect():
        one = gzip.decompress(read(r.file, r.offset, r.length))
        assert parse(one)["payload_digest"] == r.payload_digest
    assert got.where("page_id = 7").first().payload.decode() == "é" * 100_000


def test_ranges_are_joined_and_split(spark):
    rows = [("f", 0, 10), ("f", 10, 10), ("f", 500, 10), ("f", 505, 20), ("g", 90, 30), ("g", 130, 5), ("g", 130, 5)]
    index = spark.createDataFrame(rows, "file string, offset long, length long")
    got = {(r.file, r.start, r.end): len(r.records) for r in ranges(index, gap=20, most=100).collect()}
    assert got == {("f", 0, 20): 2, ("f", 500, 525): 2, ("g", 90, 120): 1, ("g", 130, 135): 1}


def test_selection_and_empty(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, top int")
    index = write_warc(df)
    assert [r.page_id for r in read_warc(index.where("page_id = 6")).collect()] == [6]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_warc(write_warc(empty)).collect() == []


def test_damage_is_found():
    good = record(1, "u", b"payload", None, False, "1970-01-01T00:00:00Z")
    assert parse(good)["payload"] == b"payload"
    for bad in (good.replace(b"payload\r", b"pAyload\r"), good[:-1], b"x" + good):
        with pytest.raises(ValueError):
            parse(bad)


def test_ranges_of_odd_indexes(spark):
    rows = [(i, f"http://h/{i}", "<p>" + "x" * (i * 40)) for i in range(40)]
    index = write_warc(spark.createDataFrame(rows, "page_id long, url string, html string")).cache()
    holes = index.limit(3).unionByName(index).unionByName(index.limit(2).withColumn("offset", F.lit(None).cast("long")))
    got = read_warc(holes, gap=0, most=500, part_bytes=300).collect()
    assert sorted(r.page_id for r in got) == list(range(40))
    assert read_warc(index, part_bytes=300).rdd.getNumPartitions() > 4
    assert read_warc(index.limit(0)).collect() == []


def test_very_long_payloads(spark):
    long = "<p>" + "x" * 9_000_000
    rows = [(1, "u1", long), (2, "u2", long), (3, "u3", None), (4, "u4", "y" * 5_000_000)] + [(10 + i, "u", None) for i in range(300)]
    index = write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    got = {x.page_id: (x.payload_bytes, x.record_type, x.refers_to) for x in read_warc(index).collect()}
    assert got[1] == (len(long), "revisit", 2) and got[2] == (len(long), "response", None) and got[4] == (5_000_000, "response", None) and len(got) == 304
