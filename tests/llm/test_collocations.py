"""Phrases and their scores against loops in whole numbers."""

import collections
import random
import re

import pytest

from junctura.llm.collocations import collocations, frequent_phrases

UPPER = {c: c + 32 for c in range(65, 91)}


def counts(rows, most):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, min_count, most, top, share=100):
    f, n = counts(rows, most)
    f = {key: v for key, v in f.items() if v >= min_count}
    out = []
    for lang in n:
        own = []
        for (x, w), a in f.items():
            if x != lang or len(w) < 2:
                continue
            score, cut = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            holds = lambda long, w=w: any(long[i : i + len(w)] == w for i in range(len(long) - len(w) + 1))
            if not any(y == lang and len(long) > len(w) and 100 * v >= share * a and holds(long) for (y, long), v in f.items()):
                own.append((-score, -a, " ".join(w).encode(), f[lang, w[:cut]], f[lang, w[cut:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(own)[:top], 1)]  # noqa: E741
    return sorted(out)


def rows_of(seed, n=300):
    r = random.Random(seed)
    words = ["of", "The", "new", "york", "é", "É", "字", "a-b", "(x)", "z" * 50, "rare%d"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(r.randint(0, 30)):
            text += r.choice(["New  York\tcity", r.choice(words)]) if r.random() < 0.7 else "in the long run"
            text += r.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "!? ", "\xa0"])
        rows.append((r.choice(["en", "en", "fr", None, "und", ""]), text.replace("%d", str(r.randint(0, 999)))))
    return rows + [("en", None), ("de", ""), ("it", "..."), *[("en", "One exact copy of one text. of one")] * 40, ("en", "new york " * 3000)]


def test_against_brute_force(spark):
    rows = rows_of(1)
    docs = spark.createDataFrame([(*x, 1) for x in rows], "lang string, text string, f int").repartition(3)
    got = lambda **k: sorted(map(tuple, collocations(docs, **k).collect()))
    assert got(min_count=20) == brute(rows, 20, 5, 2000)
    # a table of bits that is nearly full: all the same
    assert got(min_count=3, max_bits=1 << 15, top=40, salts=3) == brute(rows, 3, 5, 40)
    assert got(min_count=12, most=3, share=80) == brute(rows, 12, 3, 2000, 80)


def test_levels(spark):
    rows = rows_of(2, 150)
    levels = frequent_phrases(spark.createDataFrame(rows, "lang string, text string"), min_count=10)
    f, n = counts(rows, 5)
    assert {(x.lang, tuple(x.phrase.split(" "))): x.f for x in levels.where("k > 0").collect()} == {k: v for k, v in f.items() if v >= 10}
    assert {x.lang: x.f for x in levels.where("k = 0").collect()} == dict(n)


def test_full_bit_table_changes_nothing(spark):
    rows = [("en", " ".join(f"w{i} v{i} u{i}" for i in range(j, j + 40))) for j in range(0, 4000, 10)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    small, large = (sorted(map(tuple, frequent_phrases(docs, min_count=2, most=3, max_bits=b).collect()), key=str) for b in (1 << 15, 1 << 24))
    assert small == large and len(small) > 12_000


def test_large_products(spark, monkeypatch):
    """Scores whose products pass 64 bits, from level tables of large counts."""
    levels = spark.createDataFrame([("en", 0, None, 10**13), ("en", 1, "a", 10**12 + 7), ("en", 1, "b", 10**11 + 3), ("en", 2, "a b", 10**11 + 1)], "lang string, k int, phrase string, f long")
    monkeypatch.setattr("junctura.llm.collocations.frequent_phrases", lambda *a: levels)
    row = collocations(levels).first()
    assert row.score == 1000 * (10**11 + 1) * 10**13 // ((10**12 + 7) * (10**11 + 3))


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations(empty).collect() == []
    assert collocations(spark.createDataFrame([("en", None)], "lang string, text string")).collect() == []
    with pytest.raises(ValueError):
        frequent_phrases(empty, most=0)
