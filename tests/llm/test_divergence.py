"""Divergence of sources against whole-number loops."""

import collections
import random
import re

import numpy as np
import pyarrow as pa

from junctura.llm import words
from junctura.llm.divergence import audit, shares

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    docs, count, groups = collections.defaultdict(set), collections.Counter(), set()
    for r, (lang, source, text) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in TERM.findall((text or "").translate(UPPER)):
            docs[lang, t].add(r)
            count[lang, source, t] += 1
            count[lang, None, t] += 1
    out = []
    for lang in {x for x, _ in groups}:
        kept = sorted((t for (x, t), d in docs.items() if x == lang and len(d) >= min_docs), key=lambda t: t.encode())
        sources = sorted(s for x, s in groups if x == lang)

        def share(s, lang=lang, kept=kept):
            n = sum(count[lang, s, t] for t in kept)
            return {t: 1 + 10**9 * (count[lang, s, t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: share(s) for s in [*sources, None]}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], p[None][t]), t) for t in kept if count[lang, s, t] and p[s][t] > p[None][t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(items[: None if part == "pair" else top], 1)]
    return sorted(out)


def rows_of(seed, n=160):
    r = random.Random(seed)
    word = lambda s: r.choice(["a", "Bb", "é", "É", "字", "c", "dd", "x" * 40, f"only{s}", "ties1", "ties2"])
    rows = []
    for _ in range(n):
        s = r.choice(["s0", "s1", "s1", "s2", "é", "", None])
        rows.append((r.choice(["en", "en", "fr", None, ""]), s, r.choice([" ", "9", "\x00", "\n", "_"]).join(word(s) for _ in range(r.randint(0, 25)))))
    return rows + [("de", "s0", "few words"), ("de", "s1", None), ("it", "s0", ""), ("en", "empty", "..."), ("en", "s0", "big " * 20_000), *[("en", "copies", "Same text a")] * 60]


def test_against_brute_force(spark):
    rows = rows_of(1)
    docs = spark.createDataFrame([(*x, 1) for x in rows], "lang string, source string, text string, n int").repartition(3)
    got = lambda **k: sorted(map(tuple, audit(docs, **k).collect()))
    want = brute(rows, 10, 10)
    assert got() == want
    assert got(block_terms=2, tile_sources=2) == want  # many blocks, tiles of two sources
    assert got(min_docs=2, top=3, tile_sources=3) == brute(rows, 2, 3)
    assert audit(docs.limit(0)).collect() == []


def test_shares_are_exact():
    r = random.Random(2)
    total = [r.randint(10**k, 9 * 10**k) for k in range(1, 15) for _ in range(20)]
    count = [r.choice([0, 1, t // 3, t - 1, t]) for t in total]
    assert shares(np.array(count), np.array(total)).tolist() == [10**9 * c // t for c, t in zip(count, total, strict=True)]


def test_chunks_hold_every_row_once():
    r = random.Random(3)
    texts = [r.choice([None, "", "ab", "c" * r.randint(1, 300)]) for _ in range(200)]
    batches = [pa.record_batch([pa.array(texts[i : i + 17], pa.string())], ["text"]) for i in range(0, 200, 17)]
    for most in (1, 50, 500, 10**6):
        parts = list(words.gather(iter(batches), "text", most))
        assert [t for p in parts for t in p["text"].to_pylist()] == texts
        assert all(sum(len(t or "") for t in p["text"].to_pylist()) <= most or sum(bool(t) for t in p["text"].to_pylist()) == 1 for p in parts)
