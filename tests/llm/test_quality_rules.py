"""Base statistics against brute force; learned lists on planted labels."""

import collections
import random
import re

from pyspark.sql import functions as F

from junctura.llm.quality_rules import Rules, base_statistics, judge, learn


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    r = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b c d e", "a b c d e a b c d e", "x x x x x x x", "é\x0bé 字\n\n|a\n|a", "a\xa0b c"]
    texts += ["".join(r.choice(["a ", "bb ", "c\n", "# ", "é", "\t"]) for _ in range(r.randint(0, 90))) for _ in range(150)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "a b", 1), (7, texts[7], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = base_statistics(df).collect()
    want = sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert sorted(((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got), key=str) == want


def plant(n=900):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(r.randint(20, 60))]
        low = i % 5 == 0
        if low:
            words = [w + "##" for w in words] if i % 2 else [w.upper() for w in words]
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(not low), 0))
    return rows, labels


def test_learns_planted_rules(spark):
    rows, labels = plant()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    rules = learn(docs, known)
    assert 1 <= len(rules.rules) <= 4
    held_out = judge(docs, rules).where(F.col("doc_id") % 3 == 0).collect()
    right = sum(x.kept == bool(x.doc_id % 5) for x in held_out)
    assert right >= 0.97 * len(held_out)
    assert all(x.kept for x in held_out if x.doc_id % 5)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame(plant(60)[0], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert learn(docs, none) == Rules(())
    assert judge(docs, Rules(())).where("not kept").count() == 0
    assert judge(docs.limit(0), Rules(())).collect() == []


def test_long_texts_and_ties(spark):
    long = " ".join("w%d" % (i % 50_000) for i in range(120_000)) + "\n" + "y" * 500_000
    row = base_statistics(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_repeat_words) == (120_001, 120_000) and row.word_chars == len(long) - 120_000
    # two features part the labels equally well: the same one is taken every time, and each row is judged
    rows = [(i, " ".join((f"W{i}X{j}" if i % 2 else f"w{i}x{j}") + ("#" if i % 2 else "") for j in range(30))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    first, second = learn(docs, labels), learn(docs.repartition(7), labels.repartition(3))
    assert first == second and len(first.rules) == 1 and len(first.rules[0]) == 1
    assert all(x.kept == (x.doc_id % 2 == 0) for x in judge(docs, first).collect())


def test_query_verdicts(spark):
    """The query's verdicts are those of the learned list on statistics counted by loops."""
    import pyarrow.parquet as pq

    from junctura.llm.queries import op3_quality_rules, table

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rules = learn(docs, table(spark, sf, "labels"))
    want = []
    for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        text = r["text"] or ""
        n, chars, symbols, dup, repeats = brute_fast(text)
        of = {
            "n_words": n, "symbols_per_1000_words": symbols * 1000 // max(n, 1), "tenths_of_letters_per_word": chars * 10 // max(n, 1), "dup_lines": dup, "repeats_per_1000_words": repeats * 1000 // max(n, 1),
            "capitals_per_1000_chars": len(re.findall("[A-Z]", text)) * 1000 // max(len(text), 1),
        }
        failed = n < 10 or 100 * repeats > 20 * n
        fits = any(all((of[x.feature] >= x.bound) == x.at_least for x in rule) for rule in rules.rules)
        want.append((r["doc_id"], n, chars, symbols, dup, repeats, failed, not failed and not fits))
    got = [tuple(x)[:8] for x in op3_quality_rules(spark, sf).collect()]
    assert sorted(got) == sorted(want)


def brute_fast(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_windows_are_compared_by_their_words(spark, monkeypatch):
    r = random.Random(8)
    texts = [" ".join(r.choices("abcde", k=r.randint(0, 40))) for _ in range(60)]
    weak = F.length
    monkeypatch.setattr(F, "xxhash64", lambda *c: sum((weak(x.cast("string")) for x in c), F.lit(0)).cast("long"))  # most windows share a hash
    got = base_statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.n_repeat_words) for x in got) == [(i, brute(t)[4]) for i, t in enumerate(texts)]
