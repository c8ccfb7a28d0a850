"""Removal of repeats against brute force."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from junctura.llm import rolling
from junctura.llm import suffix_dedup as d
from junctura.llm.suffix_dedup import COVERS, remove_repeats


def brute(rows, length):
    rows = sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, out = set(), []
    for i, b in rows:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = [True] * length
            seen.add(w)
        out.append((i, len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def run(spark, rows, length, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in remove_repeats(df, length=length, **more).collect()]
    return sorted(got, key=lambda r: (r[0] is not None, r[0] or 0, r[3]))


@pytest.mark.parametrize("v", COVERS)
def test_covers(v):
    assert {(a - b) % v for a in COVERS[v] for b in COVERS[v]} == set(range(v))


@pytest.mark.parametrize("length,seed", [(12, 1), (100, 2), (40, 3)])
def test_matches_brute_force(spark, length, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé ") for _ in range(r.randint(1, 9)))
    passages = ["".join(word() for _ in range(length // r.randint(2, 6))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [r.choice(passages) if r.random() < 0.5 else "".join(r.choice("xyzäq") for _ in range(r.randint(1, 2 * length))) for _ in range(r.randint(0, 6))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[5][1]), (101, rows[5][1]), (102, None), (103, ""), (104, "aaaa" * length)]
    r.shuffle(rows)
    want = sorted(brute(rows, length), key=lambda x: (x[0] is not None, x[0] or 0, x[3]))
    assert run(spark, rows, length, blocks=3, chunk_bytes=700, bucket_keys=500, bucket_bytes=600) == want
    assert run(spark, rows, length) == want


def test_first_equal():
    import numpy as np

    from junctura.llm.suffix_dedup import first_equal

    for seed, length in enumerate([1, 3, 8, 9, 16, *range(17, 34), 40, 57, 64, 99, 100, 101]):
        r = random.Random(seed)
        unit = "".join(r.choices("ab", k=150))
        text = ("".join(r.choice([unit, unit[:80], "a" * 120, "".join(r.choices("ab", k=9))]) for _ in range(30))).encode()
        at = [i for i in range(len(text) - length + 1) if r.random() < 0.7]
        seen = {}
        want = [seen.setdefault(text[i : i + length], n) for n, i in enumerate(at)]
        assert first_equal(np.frombuffer(text, np.uint8), np.array(at), length).tolist() == want
    assert first_equal(np.zeros(0, np.uint8), np.zeros(0, np.int64), 100).tolist() == []


@pytest.mark.parametrize("collide", [False, True])
def test_fingerprints_decide_nothing(monkeypatch, collide):
    """The passes by hand over two chunks; with hashes that are all alike the result is the same."""
    import numpy as np
    import pyarrow as pa

    from junctura.llm import rolling, suffix_dedup as d

    if collide:
        monkeypatch.setattr(rolling, "windows", lambda sums, length, at: np.zeros(len(at), np.uint64))
        monkeypatch.setattr(rolling, "mix", lambda x: x * np.uint64(0))
    r = random.Random(3)
    passages = ["".join(r.choices("abc ", k=130)) for _ in range(4)]
    rows = [(i, "".join(r.choice([*passages, "".join(r.choices("abc ", k=r.randint(1, 150)))]) for _ in range(r.randint(0, 5)))) for i in range(30)]
    rows[7] = (7, rows[2][1])
    parts = [pa.table({"doc_id": pa.array([i for i, _ in own], pa.int64()), "text": [t for _, t in own]}) for own in (rows[::2], rows[1::2])]
    keyed = lambda f, tables, *more: [f((pa.scalar(k),), t, *(m[k] for m in more)) for k, t in enumerate(tables)]

    def by_bucket(f, sent):
        sent = pa.concat_tables(sent)
        done = [f((pa.scalar(b),), sent.filter(pa.compute.equal(sent["bucket"], b))) for b in sorted(set(sent["bucket"].to_pylist()))]
        done = pa.concat_tables([x.select(["__chunk", "piece", "bucket", "bits"]) for x in done])
        return [done.filter(pa.compute.equal(done["__chunk"], k)) for k in range(len(parts))]

    ranks = by_bucket(d._shared_ranks, keyed(d._send_samples("doc_id", "text", 100, 2), parts))
    ties = by_bucket(d._sort_bucket(100), keyed(d._send_runs("doc_id", "text", 100, 3, 0, 1), parts, ranks))
    both = [pa.concat_tables([a, b]) for a, b in zip(ranks, ties)]
    out = pa.concat_tables(keyed(d._remove("doc_id", "text", 100, 3, ["doc_id"]), parts, both)).to_pylist()
    assert sorted((x["doc_id"], x["n_bytes"], x["n_removed"], x["kept"]) for x in out) == sorted(brute(rows, 100))


def test_null_ids_and_equal_rows(spark):
    base = "".join(random.Random(5).choices("abcdefgh", k=3000))
    rows = [(3, base), (3, base), (None, base[:500]), (9, "z" + base + base)]
    assert [x[2] for x in run(spark, rows, 100)] == [0, 3000, 500, 6000]


def test_pieces_of_a_long_text():
    """A text cut into pieces has the same windows and ties as one piece."""
    import numpy as np
    import pyarrow as pa

    from junctura.llm import chunks, suffix_dedup

    text = "".join(random.Random(7).choices("abc", k=4000)) * 2
    chunk = chunks.load(pa.table({"doc_id": pa.array([1], pa.int64()), "text": [text]}), "doc_id", "text")
    found = []
    for lo in range(0, len(text), 900):
        piece = suffix_dedup._Piece(chunk, lo, min(lo + 900, len(text)), 100)
        at, short = piece.samples()
        found.append(lo + piece.tied(at, np.ones(len(at), bool)))
    assert np.concatenate(found).tolist() == list(range(len(text) - 99))


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(df).collect() == []
    df = spark.createDataFrame([(1, "x" * 300, "mine", 7)], "doc_id long, text string, kept string, other int")
    row = remove_repeats(df).first()
    assert row.other == 7 and row.n_removed == 299 and bytes(row.kept) == b"x" and row.spans[0].start == 1


def test_heavy_buckets_are_split(spark, monkeypatch):
    """One string of eight bytes that is the least of half of all windows: no task gets more than twice a bucket's bytes."""
    r, grams = random.Random(11), np.random.default_rng(3)
    many = grams.integers(97, 123, (200_000, 8), dtype=np.uint8)
    hot = many[np.argmin(rolling.mix(np.ascontiguousarray(many).view("<u8").ravel()))].tobytes().decode()
    text = lambda: "".join(hot if r.random() < 0.035 else r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(4_000))
    texts = [text() for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, r.choice(texts)[: r.randint(300, 4_000)] + text()[:200]) for i in range(60)]
    seen, own = {}, d._sorted

    def watch(scratch, runs, length, heavy, part_bytes, block):
        seen["buckets"] = [x.load for x in runs.groupBy("bucket").agg(F.sum("raw").alias("load")).collect()]
        loads = {x.bucket: -(-6 * x.load // part_bytes) for x in runs.groupBy("bucket").agg(F.sum("raw").alias("load")).where(F.col("load") > heavy).collect()}
        sizes = collections.Counter()
        for row in runs.where(F.col("bucket").isin(list(loads))).collect():
            table = pa.Table.from_pylist([row.asDict() | {"parts": loads[row.bucket]}])
            for x in d._split_heavy(length)((), table).to_pylist():
                sizes[x["bucket"], x["part"]] += x["raw"]
        seen["parts"] = sizes
        return own(scratch, runs, length, heavy, part_bytes, block)

    monkeypatch.setattr(d, "_sorted", watch)
    bound = 30_000
    got = run(spark, rows, 100, chunk_bytes=60_000, bucket_bytes=bound)
    assert got == brute(rows, 100)
    assert max(seen["buckets"]) > 4 * bound and len(seen["parts"]) > 8 and max(seen["parts"].values()) < 2 * bound
    monkeypatch.setattr(d, "_sorted", own)
    assert run(spark, rows[::4], 100, chunk_bytes=30_000, bucket_bytes=2_000, heavy_bytes=1) == brute(rows[::4], 100)  # all are split
    for length in (3, 8, 9, 20):
        small = [(i, "".join(r.choices("ab", k=r.randint(0, 60)))) for i in range(40)]
        assert run(spark, small, length, chunk_bytes=300, bucket_bytes=50, heavy_bytes=1) == brute(small, length)
