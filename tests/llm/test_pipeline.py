"""Each pipeline stage on planted rows."""

import collections
import hashlib
import math
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
import test_jaccard_join as jaccard

import corpus_pipeline as p
from junctura.llm import queries as q


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    r = random.Random(9)
    text = lambda n: " ".join("".join(r.choices("abcdefghijk", k=r.randint(2, 8))) for _ in range(n))
    rows = [(i, text(60)) for i in range(200)]
    rows += [(300, "too short"), (301, None), (302, "one two three four five " * 9)]
    rows += [(400, rows[5][1]), (401, rows[5][1].replace(" ", "\n", 3)), (402, rows[5][1].rsplit(" ", 1)[0] + " changed")]
    passage = "é" + text(50)
    rows += [(500, text(40) + " " + passage + " " + text(40)), (501, text(40) + " " + passage + " " + text(40))]
    d = tmp_path_factory.mktemp("sf")
    pq.write_table(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows], "lang": ["en"] * len(rows), "source": ["s%d" % (i % 3) for i, _ in rows], "n_chars": [len(t or "") for _, t in rows]}), d / "documents.parquet")
    pq.write_table(pa.table({"doc_id": list(range(100)), "quality": pa.array([1] * 100, pa.int32()), "toxic": pa.array([0] * 100, pa.int32())}), d / "labels.parquet")
    return str(d), dict(rows), passage


def test_stages(spark, planted, tmp_path):
    sf_dir, texts, passage = planted
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = []
    for i, (_, stage) in enumerate(p.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        ids.append({r.doc_id for r in docs.collect()})
        assert i == len(p.STAGES) - 1 or docs.columns == p.COLUMNS
    assert set(texts) - ids[0] == {300, 301, 302}
    assert ids[0] - ids[1] == {400, 401, 402}
    assert ids[2] == ids[1]
    kept = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "2")).collect()}
    assert kept[500] == texts[500] and passage[10:-10] not in kept[501] and len(kept[501]) <= len(texts[501]) - len(passage)
    assert all(kept[i] == texts[i] for i in ids[2] - {501})
    assert ids[4] == ids[3] <= ids[2] and len(ids[3]) > 100


def test_run(spark, planted):
    assert p.run(spark, planted[0]).count() > 100


WORDS = [" ".join(f"{x}{i}" for i in range(60)) for x in "abcdef"]
ROW = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, tmp_path, stage, pairs):
    """(id, text) of the rows that a stage leaves, sorted."""
    pq.write_table(pa.table({"doc_id": [1], "quality": pa.array([1], pa.int32()), "toxic": pa.array([0], pa.int32())}), tmp_path / "labels.parquet")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], ROW).write.parquet(str(tmp_path / "docs"))
    out = stage(spark, spark.read.parquet(str(tmp_path / "docs")), str(tmp_path))
    assert out.columns == p.COLUMNS
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_quality_judges_rows(spark, tmp_path):
    a, b, c, *_ = WORDS
    bad = [(None, "too short"), (None, None), (2, "one two three four five " * 9), (3, None)]
    good = [(None, a), (1, b), (2, b), (2, c), (4, a), (4, a)]
    assert rows_of(spark, tmp_path, p.quality, bad + good) == sorted(good, key=str)


def test_near_duplicates_drops_rows(spark, tmp_path):
    a, b, c, d, e, f = WORDS
    near = a.rsplit(" ", 1)[0] + " changed"
    gone = [(9, a), (None, near), (3, b), (3, b), (None, c), (None, c)]
    stay = [(1, a), (9, d), (3, b), (None, c), (None, e), (None, f), (5, ""), (5, ""), (None, None)]
    assert rows_of(spark, tmp_path, p.near_duplicates, gone + stay) == sorted(stay, key=str)


def brute_mix(rows):
    """Raking and sampling of (id, text, lang, source) rows in plain Python."""
    def topic(t):
        for name, pattern in (("table", r" \| "), ("markup", "[#*$%&<>]{2}"), ("figures", "[0-9]{6}"), ("capitals", "[A-Z]{4}")):
            if re.search(pattern, t):
                return name
        return "prose"

    some = lambda x: "(none)" if x is None else x
    keys = [(some(r[3]), some(r[2]), topic(r[1] or "")) for r in rows]
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    cells = collections.Counter()
    for k, n in zip(keys, words):
        cells[k] += n
    targets = []
    for m, power in enumerate(q.MIX_POWERS):
        sums = collections.Counter()
        for k, n in cells.items():
            sums[k[m]] += n
        w = {k: n**power for k, n in sums.items() if n > 0}
        targets.append({k: x / sum(w.values()) for k, x in w.items()})
    f = [dict.fromkeys(t, 1.0) for t in targets]
    for _ in range(q.MIX_ROUNDS):
        for m in range(3):
            sums = collections.Counter()
            for k, n in cells.items():
                sums[k[m]] += n * math.prod(f[x].get(k[x], 0.0) for x in range(3) if x != m)
            f[m] = {k: targets[m][k] / sums[k] if sums[k] > 0 else 0.0 for k in targets[m]}
    factor = {k: math.prod(f[m].get(k[m], 0.0) for m in range(3)) for k in cells}
    top = max((factor[k] for k, n in cells.items() if n > 0), default=1.0)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    chance = lambda r: int(md5(f"{'(none)' + md5(r[1] or '') if r[0] is None else r[0]}:{q.MIX_SEED}")[:12], 16) / 2**48
    return [r for r, k, n in zip(rows, keys, words) if chance(r) < (factor[k] / top if n else 1.0)]


def brute_run(rows, low=None):
    """All five stages over (id, text, lang, source) rows; ``low`` says which texts the learned list rejects, if one is learned."""
    def kept(text):
        if low and low(text or ""):
            return False
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        inside = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        return len(w) >= 10 and 100 * len(inside) <= 20 * len(w)

    rows = [r for r in rows if kept(r[1])]
    component = [c for *_, c in jaccard.brute_rows(rows)]
    first = {}
    for c, r in sorted(zip(component, rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[1][1])):
        first.setdefault(c, r)
    rows = sorted(first.values(), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    seen, cut = set(), []
    for i, text, lang, source in rows:
        b, gone = text.encode(), set()
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone.update(range(p, p + 100))
            seen.add(b[p : p + 100])
        # whole characters go
        at = 0
        for c in text:
            size = len(c.encode())
            if gone & set(range(at, at + size)):
                gone.update(range(at, at + size))
            at += size
        left = bytes(x for k, x in enumerate(b) if k not in gone).decode() if gone else text
        if len(gone) < len(b):
            cut.append((i, left, lang, source))
    sp = sentencepiece.SentencePieceProcessor(model_file=q.vocabulary("piece_bpe_32k.model"))
    return sorted(((r[0], ids := sp.encode(r[1], add_eos=True), len(ids)) for r in brute_mix(cut)), key=str)


def put(folder, rows, labels=((1, 1, 0), (2, 1, 0))):
    """The tables of a run, with a column more, some of whose names operators use themselves."""
    cols = {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "lang": pa.array([r[2] for r in rows], pa.string()), "source": pa.array([r[3] for r in rows], pa.string())}
    n = len(rows)
    cols |= {"n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64()), "kept": ["x"] * n, "sig": [1] * n, "row": [2] * n, "factor": [3.0] * n, "spans": [4] * n}
    pq.write_table(pa.table(cols), folder / "documents.parquet")
    ids, quality, toxic = zip(*labels)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "quality": pa.array(quality, pa.int32()), "toxic": pa.array(toxic, pa.int32())}), folder / "labels.parquet")
    return str(folder)


def test_whole_run_matches_brute_force(spark, tmp_path):
    r = random.Random(12)
    word = lambda: "".join(r.choices("abcdefghijk", k=r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(30), "é" + text(35) + "ö", text(25) + " AAAA | 1234567"]
    rows = []
    for i in range(90):
        own = " ".join(r.choice([text(20), text(40), *passages]) for _ in range(r.randint(1, 4)))
        rows.append((r.choice([i, i, i, None]), own, r.choice(["en", "fr", None]), r.choice(["web", "web", "book", None])))
    rows += [(200 + i, x[1], x[2], x[3]) for i, x in enumerate(rows[:20])]
    rows += [(300 + i, x[1].rsplit(" ", 1)[0] + " end", "de", "web") for i, x in enumerate(rows[20:40])]
    # one id with several texts, equal rows, and what the base rules reject
    rows += [(7, text(50), "en", "web"), (7, text(30), "en", "book"), (400, None, "en", "web"), (401, "", "en", "web"), (402, "few words", None, None), (403, "one two three four five " * 12, "en", "web")]
    rows += [rows[3], rows[3], (None, rows[5][1], "en", "web")]
    got = sorted(((x.doc_id, list(x.ids), x.n_tokens) for x in p.run(spark, put(tmp_path, rows)).collect()), key=str)
    assert got == brute_run(rows) and len(got) > 20


def test_empty_run(spark, tmp_path):
    assert p.run(spark, put(tmp_path, [])).collect() == []


def test_whole_run_with_a_learned_rule(spark, tmp_path):
    r = random.Random(21)
    word = lambda: "".join(r.choices("abcdefghijk", k=r.randint(2, 8)))
    text = lambda n, mark="": " ".join(word() + mark for _ in range(n))
    passage = "é\ufffdß" * 40
    rows = [(i, text(r.randint(20, 60), "##" if i % 4 == 0 else ""), "en", "web") for i in range(400)]
    rows += [(1_000 + i, text(30) + " " + passage + " " + text(30), "fr", "book") for i in range(12)]
    rows += [(None, text(40, "##"), "en", "web"), (None, text(40), "en", "web"), (2_000, text(30) + " keeps its \ufffd mark " + "x" * 101, "en", "web"), (2_001, text(30) + " also \ufffd here " + "x" * 101, "en", "web")]
    labels = [(i, int(i % 4 != 0), 0) for i in range(300)]
    got = sorted(((x.doc_id, list(x.ids), x.n_tokens) for x in p.run(spark, put(tmp_path, rows, labels)).collect()), key=str)
    want = brute_run(rows, low=lambda t: t.count("##") > len(t.split()) / 2)
    assert got == want and 100 < len(got) < 330


def test_source_marks_stay(spark, tmp_path):
    """A replacement mark of the source is text like any other, though a passage beside it goes."""
    shared, other = "".join(f"<s{i}>" for i in range(30)), "".join(f"<o{i}>" for i in range(30))
    first, second = WORDS[0] + " \ufffd" + shared, WORDS[1] + " tail with \ufffd mark" + shared
    # é and ĩ share their second byte
    rows = [(1, first), (2, second), (3, "é" + other), (4, "a\ufffdĩ" + other), (5, None)]
    got = rows_of(spark, tmp_path, p.repeated_passages, rows)
    assert dict(got) == {1: first, 2: WORDS[1] + " tail with \ufffd mark", 3: "é" + other, 4: "a\ufffd", 5: None}
