"""Windows of benchmark items in texts, against loops over words."""

import hashlib
import random
import re

import pytest

from junctura.llm import queries as q
from junctura.llm.decontamination import decontaminate, find_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items, width=10):
    """Number of words, hit places, ids of the items that occur."""
    words, hit, found = split(text), set(), set()
    for ident, item in items:
        w = split(item)
        n = min(len(w), width)
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    if ident is not None:
                        found.add(str(ident))
    return len(words), hit, sorted(found)


def tables(spark):
    r = random.Random(5)
    word = lambda: r.choice(["a", "B", "cé", "9", "Éa", "dd"])
    items = [(i, " ".join(word() for _ in range(r.choice([1, 3, 9, 10, 11, 14])))) for i in range(25)]
    items = [(i, t) for i, t in items if len(split(t)) > 2] + [(100, None), (101, ""), (102, "?! "), (3, "a-b-a-b-a"), (None, "only here"), (7, items[7][1])]
    texts = [None, "", "...", "a", "Only, HERE", "é" * 3000, "x " * 5000 + "only here"]
    for _ in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(3)]
        parts.insert(1, r.choice(items)[1] or "")
        texts.append(r.choice([" ", "-", "\x00", "\n"]).join(parts))
    rows = [(i, t, "m") for i, t in enumerate(texts)] + [(None, texts[10], "m"), (None, texts[10], "m"), (None, None, "m"), (None, None, "m"), (4, texts[12], "m")]
    return items, rows, spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string, n_words string")


def test_against_brute_force(spark):
    items, rows, item_table, docs = tables(spark)
    want = sorted(((i, n, len(h), f) for i, t, _ in rows for n, h, f in [brute(t, items)]), key=str)
    for block_bytes in (32 << 20, 900):  # one block, and many
        got = find_contamination(docs, item_table, block_bytes=block_bytes).collect()
        assert sorted(((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got), key=str) == want
        assert all(x.contaminated == (x.n_hit > 0) and sum(s.end - s.start for s in x.spans) == x.n_hit for x in got)


def test_removal(spark):
    items, rows, item_table, docs = tables(spark)
    left = sorted((str(x.doc_id), str(x.text), x.n_words) for x in decontaminate(docs, item_table).collect())
    want = []
    for i, t, m in rows:
        spots = [x.span() for x in WORD.finditer((t or "").translate(UPPER))]
        hit = brute(t, items)[1]
        gone = {k for w in hit for k in range(*spots[w])} | {k for w in hit if w + 1 in hit for k in range(spots[w][1], spots[w + 1][0])}
        want.append((str(i), str(t) if t is None else "".join(c for k, c in enumerate(t) if k not in gone), m))
    assert left == sorted(want)
    whole = sorted((str(x.doc_id), str(x.text)) for x in decontaminate(docs, item_table, "documents").collect())
    assert whole == sorted((str(i), str(t)) for i, t, _ in rows if not brute(t, items)[1])
    with pytest.raises(ValueError):
        decontaminate(docs, item_table, "lines")


def test_empty_tables(spark):
    _, rows, item_table, docs = tables(spark)
    assert find_contamination(docs.limit(0), item_table).collect() == []
    got = find_contamination(docs, item_table.limit(0)).collect()
    assert len(got) == len(rows) and not any(x.contaminated or x["items"] for x in got)


def test_query_has_a_digest_of_items(spark, tmp_path):
    items, rows, item_table, docs = tables(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    item_table.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(((x.doc_id, x.n_items, x.items_sha256) for x in q.op12_decontamination(spark, str(tmp_path)).collect()), key=str)
    want = [(i, len(f), hashlib.sha256(",".join(f).encode()).hexdigest()) for i, t, _ in rows for _, _, f in [brute(t, items)]]
    assert got == sorted(want, key=str)
