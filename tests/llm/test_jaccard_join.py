"""Jaccard components against brute force."""

import random
import re

import numpy as np

from junctura.llm import shingles
from junctura.llm.jaccard_join import similar_components, similar_links, t_occurrence


def shingle_set(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def brute_rows(rows):
    """(id, set size, component number) of each row (id, text, ...)."""
    rows = [r[:2] for r in rows]
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    return [(d, len(s), find(i)) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def brute(rows):
    found, least = brute_rows(rows), {}
    for d, _, c in found:
        if d is not None:
            least[c] = min(least.get(c, d), d)
    return sorted(((d, n, least.get(c) if n else d) for d, n, c in found), key=str)


def make(seed, n=150):
    r = random.Random(seed)
    vocab = ["w%d" % i for i in range(3000)]
    base = [[r.choice(vocab) for _ in range(r.randint(3, 90))] for _ in range(12)]
    boiler = [r.choice(vocab) for _ in range(30)]
    rows = []
    for i in range(n):
        words = list(r.choice(base)) if r.random() < 0.7 else [r.choice(vocab) for _ in range(r.randint(0, 60))]
        if r.random() < 0.3:
            words = boiler + words
        for _ in range(r.randint(0, 3)):
            if words:
                words[r.randrange(len(words))] = r.choice(vocab)
        text = r.choice([" ", "\n", " \t"]).join(words)
        rows.append((i, text.upper() if r.random() < 0.2 else text))
    rows += [(n, None), (n + 1, ""), (n + 2, "  \n "), (n + 3, rows[3][1]), (n + 3, rows[3][1]), (None, rows[4][1]), (5, "other words than five has here today"), (n + 4, "é É"), (n + 5, "é é")]
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.id, r.n, r.component) for r in similar_components(df, **more).collect()), key=str)


def test_matches_brute_force(spark):
    rows = make(1)
    assert run(spark, rows, chunk_bytes=5000, bucket_keys=300) == brute(rows)


def test_classes_over_several_blocks(spark):
    rows = make(2, 120)
    assert run(spark, rows, chunk_bytes=20000, block_shingles=300) == brute(rows)


def test_search_in_one_block():
    r = np.random.default_rng(3)
    base = [np.unique(r.integers(0, 400, 60)).astype(np.uint64) for _ in range(4)]
    sets = [np.unique(np.where(r.random(len(b)) < 0.08, r.integers(0, 400, len(b)), b)).astype(np.uint64) for b in base for _ in range(12)]
    links = t_occurrence(sets, np.arange(len(sets)), np.arange(len(sets)), 80)
    want = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert {(a, b) for a, b, _ in links} <= want

    def parts(edges):
        root = list(range(len(sets)))
        for a, b in edges:
            x, y = root[a], root[b]
            root = [min(x, y) if z in (x, y) else z for z in root]
        return root

    assert parts((a, b) for a, b, _ in links) == parts(want)
    every = t_occurrence(sets, np.arange(len(sets)), np.arange(len(sets)), 80, True)
    assert {(a, b) for a, b, _ in every} == want
    assert all(t == len(np.intersect1d(sets[a], sets[b])) for a, b, t in every)
    # halves that tell nothing: the other half decides
    both = [np.stack([np.full(len(s), 5, np.uint64), s]) for s in sets]
    assert set(t_occurrence(both, np.arange(len(sets)), np.arange(len(sets)), 80, True)) == set(every)


def brute_links(rows):
    sets = [shingle_set(t) for _, t in rows]
    out = {i: 0 for i in range(len(rows))}
    pairs = set()
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                out[i] += 1
                out[j] += 1
                if a != b:
                    pairs.add(frozenset([a, b]))
    return out, len(pairs)


def test_every_link(spark):
    for seed, more in ((4, {}), (5, {"block_shingles": 300, "chunk_bytes": 20000})):
        rows = [(i, t) for i, (_, t) in enumerate(make(seed, 120))]
        pairs, members = similar_links(spark.createDataFrame(rows, "doc_id long, text string"), **more)
        counts, n = brute_links(rows)
        got = pairs.collect()
        assert len(got) == n == len({(r.u, r.v) for r in got}) and all(r.u < r.v and r.shared > 0 for r in got)
        assert {r.id: r.links for r in members.collect()} == counts


def test_words_of_one_structure(spark):
    """Thue-Morse words and their complements meet in any polynomial hash modulo a power of two."""
    t = "a"
    while len(t) < 2048:
        t += t.translate(str.maketrans("ab", "ba"))
    other = t.translate(str.maketrans("ab", "ba"))
    long = " ".join("w%d" % i for i in range(30))
    rows = [(1, t), (2, other), (3, t + " " + long), (4, other + " " + long), (5, "x" * 15 + " " + long), (6, "x" * 16 + " " + long), (7, "x\0 " + long), (8, "x " + long)]
    rows += [(10 + i, " ".join([t, other, t, t, other][i:] + [other] * i)) for i in range(4)]
    assert run(spark, rows) == brute(rows)


def test_word_codes_are_apart():
    words = [b"", b"a", b"a\0", b"\0a", b"abcdefgh", b"abcdefghi", b"abcdefghijklmno", b"abcdefghijklmnop", b"abcdefghijklmnopq", "é".encode(), b"A"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    codes, doc = shingles.word_codes(data, np.array([len(data)]))
    assert len(doc) == len(words) - 1 and len({tuple(c) for c in codes.T.tolist()}) == len(words) - 2  # A is a


def test_long_text_and_clashing_columns(spark):
    r = random.Random(8)
    words = [f"w{r.randrange(5000)}" for _ in range(60_000)] + ["y" * 3_000_000]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "z" * 3_000_000])), (3, "n sig id shingles cls")]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, n int, sig int, component string")
    assert sorted((x.id, x.n, x.component) for x in similar_components(df).collect()) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
