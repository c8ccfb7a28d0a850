"""Quotation linking on small conversations."""

import random
import re

from pyspark.sql import functions as F

from junctura.llm.quotes import ATTRIBUTION, CLOSED, OPENING, build_conversations, parse_quotes, quote_level

A = "Hello everybody here.\nShall we meet on Monday?\n\nA second paragraph of mine."
ROWS = [
    (1, 0, "user", A),
    (1, 1, "assistant", "On Tuesday Ann wrote:\n> Shall  we meet on monday?\n\nYes, Monday is fine for me."),
    (1, 2, "user", "A message that quotes nothing at all."),
    (1, 3, "user", "> > Shall we meet on Monday?\n> Yes, Monday is fine for me.\n\nGood, see you then."),
    (1, 4, "user", "> A passage that nobody ever wrote.\nReally?"),
    (1, 5, "user", ">Good, see you then.\n>>> Hello everybody here.\nbye"),
    (2, 0, "user", "Shall we meet on Monday?"),
    (2, 1, "user", None),
    (2, 1, "user", "> Shall we meet on Monday?"),
    (None, 3, "user", "> Shall we meet on Monday?"),
]


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("own", F.lit(1))
    return build_conversations(df).collect()


def test_links_and_order(spark):
    got = run(spark, ROWS)
    assert len(got) == len(ROWS)
    first = {r.turn: r for r in got if r.conv_id == 1}
    assert {t: r.reply_to for t, r in first.items()} == {0: None, 1: 0, 2: None, 3: 1, 4: None, 5: 3}
    assert {t: (r.thread, r.depth) for t, r in first.items()} == {0: (0, 0), 1: (0, 1), 2: (2, 0), 3: (0, 2), 4: (4, 0), 5: (0, 3)}
    assert first[1].own == "Yes, Monday is fine for me." and first[3].own == "Good, see you then." and first[5].own == "bye"
    assert [r.turn for r in got if r.conv_id == 1] == [0, 1, 3, 5, 2, 4]
    assert [r.reply_to for r in got if r.conv_id == 2] == [None, 0, 0]
    assert [r.reply_to for r in got if r.conv_id is None] == [None]


def test_empty(spark):
    assert run(spark, []) == []


def test_levels(spark):
    df = spark.createDataFrame([("> > x",), (">>> x",), ("x > y",), ("",), ("  > x",)], "t string")
    assert [r[0] for r in df.select(quote_level(F.col("t"))).collect()] == [2, 3, 0, 0, 1]
    row = parse_quotes(spark.createDataFrame([("> one long line\n> another long line\nown long text",)], "text string")).first()
    assert sorted(p.level for p in row.parts) == [0, 1, 1, 1]


def test_short_passages(spark):
    rows = [
        (1, 0, "user", "Yes?"),
        (1, 1, "assistant", "> Yes?\nAgreed."),
        (1, 2, "user", "> Agreed.\nok"),
        (1, 3, "user", "> ok\n>\n>  \nfine"),
        (1, 4, "user", "A line of some length\nhm"),
        (1, 5, "user", "> hm\n> something that nobody wrote\n>> A line of some length\n>> hm\nwell"),
        (1, 6, "user", "> nobody wrote this\n> well\n>> fine\n>> nor this here\nend"),
        (1, 7, "user", ">\n>   \nblank"),
    ]
    got = {r.turn: r for r in run(spark, rows)}
    assert {t: r.reply_to for t, r in got.items()} == {0: None, 1: 0, 2: 1, 3: 2, 4: None, 5: 4, 6: 5, 7: None}
    assert {t: r.n_quotes for t, r in got.items()} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0, 5: 2, 6: 2, 7: 0}
    assert got[3].thread == 0 and got[3].depth == 3


def test_longer_passages_win(spark):
    rows = [
        (1, 0, "user", "A first line of mine\nno"),
        (1, 1, "user", "yes"),
        (1, 2, "user", "> nobody ever wrote this\n> yes\n>> A first line of mine\n>> no\nend"),
        (1, 3, "user", "> nobody ever wrote this\n> yes\nend"),
    ]
    got = {r.turn: r for r in run(spark, rows)}
    assert (got[2].reply_to, got[2].n_quotes) == (0, 2)
    assert (got[3].reply_to, got[3].n_quotes) == (1, 1)


PATTERN, OPENS = re.compile(ATTRIBUTION), re.compile(OPENING)


def brute(rows):
    """Linking by loops over the messages of each conversation."""
    def level(line):
        return re.match(r"(?:[ \t]*>)*", line)[0].count(">")

    def parse(text):
        lines = [(level(x), re.sub(r"^(?:[ \t]*>)+[ \t]?", "", x)) for x in re.split("\r?\n", text or "")]
        low = [x.strip(" ").lower() for _, x in lines]
        gone = set()
        for i, (n, x) in enumerate(lines):
            after = next((m for m, y in lines[i + 1 :] if m > 0 or y.strip(" ")), 0)
            for d in range(3):
                own = range(i - d, i + 1)
                if own[0] < 0 or after <= 0 or any(lines[k][0] or not low[k] for k in own) or not PATTERN.search(" ".join(low[k] for k in own)):
                    continue
                if not d or (OPENS.search(low[own[0]]) and not any(OPENS.search(low[k]) for k in own[1:]) and not any(re.search(CLOSED, low[k]) for k in own[:-1])):
                    gone.update(own)
        out = [(-1 if i in gone else n, x) for i, (n, x) in enumerate(lines)]
        norm = lambda p: re.sub(r"\s+", " ", p.lower()).strip(" ")
        parts, i = {}, 0
        while i < len(out):
            j = i
            while j < len(out) and out[j][0] == out[i][0]:
                j += 1
            run = "\n".join(x for _, x in out[i:j])
            wide = {norm(p) for p in (run, *re.split(r"\n\s*\n", run))}
            lines_ = {norm(p) for p in run.split("\n")} - wide
            sentences = {p for p in re.split(r"(?<=[.!?]) ", norm(run)) if len(p) >= 10} - wide - lines_
            for p, kind in [(p, 0) for p in wide] + [(p, int(len(p) < 10)) for p in lines_] + [(p, 2) for p in sentences]:
                if p and out[i][0] >= 0:
                    at = out[i][0], i if out[i][0] else 0, p
                    parts[at] = min(parts.get(at, 9), kind)
            i = j
        return "\n".join(x for n, x in out if n == 0).strip(), parts

    parsed = [(c, t, *parse(x)) for c, t, _, x in rows]
    first = {}
    for c, t, _, parts in parsed:
        for n, _, key in parts:
            if n == 0 and c is not None and t is not None:
                first[c, key] = min(t, first.get((c, key), t))
    replies, counts = {}, {}
    for c, t in {(c, t) for c, t, *_ in parsed if c is not None and t is not None}:
        links = {}
        hits = {}
        for _, _, _, parts in (p for p in parsed if p[:2] == (c, t)):
            for at, kind in parts.items():
                if at[0] > 0 and first.get((c, at[2]), t) < t:
                    hits[at] = min(hits.get(at, 9), kind)
        wide = {at[:2] for at, kind in hits.items() if kind < 2}
        for (n, run, key), kind in hits.items():
            if kind < 2 or (n, run) not in wide:
                o = first[c, key]
                links[n, o] = links.get((n, o), True) and kind == 1
        if links:
            short, n, o = min((s, n, -o) for (n, o), s in links.items())
            replies[c, t], counts[c, t] = -o, len(links)
    out = []
    for c, t, own, _ in parsed:
        thread, depth, at = t, 0, t
        while (c, at) in replies:
            at = thread = replies[c, at]
            depth += 1
        out.append((c, t, own, replies.get((c, t)), thread, depth, counts.get((c, t), 0)))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    r = random.Random(6)
    said = ["Yes, ok.", "no", "A longer sentence about the plan.", "We meet at\nnoon, as ever.", "Ünïcode Straße", "a\x1eb \x1f c", "", " ", "Another thing:\n\nit rains today", "First of all, hello there. The second point is\nthis one! And a third?", "The second point is this one! ok."]
    intro = ["On Monday Ann\nwrote:\n", "On Monday the 3rd,\nAnn B. Carter of\nExample wrote:\n", "On balance I agree.\nAnn wrote:\n", "Il giorno 3 Bo ha\nscritto:\n", "Ann wrote:\n", "Am Montag schrieb Bo:\n\n", "Le 3 mai, Ann a écrit :\n", "-----Original Message-----\n", "Ann said nothing here\n", ""]
    rows = []
    for c in range(40):
        texts = []
        for t in range(r.randint(1, 9)):
            text = r.choice(said)
            if texts and r.random() < 0.7:
                old = r.choice(texts)
                old = r.choice([old, old, old.split(". ")[-1], old.split("! ")[0]])
                text = r.choice(intro) + "\n".join(r.choice([">", "> ", " >"]) + x for x in old.split("\n")) + r.choice(["\n", "\n\n", "\r\n"]) + text
            texts.append(text)
            rows.append((c, t, "user", text))
    rows += [(3, 1, "user", "> Yes, ok.\nagain"), (3, 1, "user", "> Yes, ok.\nagain"), (None, 1, "user", "> no"), (5, None, "user", "> no"), (6, 7, None, None), (7, 90, "user", "> " + "no " * 100_000)]
    got = sorted(((x.conv_id, x.turn, x.own, x.reply_to, x.thread, x.depth, x.n_quotes) for x in run(spark, rows)), key=str)
    assert got == brute(rows) and sum(x[6] > 0 for x in got) > 40


def test_attribution_lines(spark):
    texts = ["Ann wrote:\n\n> x y z\nmine", "Ann a écrit :\n> x\nmine", "She wrote:\nnothing quoted", "He wrote:\nmine\n> x", "a\x1e\x1fb"]
    got = [x.own for x in parse_quotes(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    assert got == ["mine", "mine", texts[2], "He wrote:\nmine", "a\x1e\x1fb"]


def test_partial_quotes(spark):
    text = "First sentence of the message. Second sentence of the message. Third one."
    rows = [
        (1, 0, "u", text),
        (1, 1, "u", "> Second sentence of the message.\nyes"),
        (1, 2, "u", "> First sentence of the\n> message. Second sentence of the message.\nno"),
        (1, 3, "u", "Second sentence of the message."),
        (1, 4, "u", "Thanks a lot to you. A message of its own."),
        (1, 5, "u", "Thanks a lot to you. But no."),
        (1, 6, "u", "> Thanks a lot to you. But no.\nfine"),
        (1, 7, "u", "> one.\nshort"),
    ]
    got = {r.turn: r for r in run(spark, rows)}
    # a whole run that is linked keeps its sentences from linking elsewhere
    assert {t: (r.reply_to, r.n_quotes) for t, r in got.items()} == {0: (None, 0), 1: (0, 1), 2: (0, 1), 3: (None, 0), 4: (None, 0), 5: (None, 0), 6: (5, 1), 7: (None, 0)}


def test_wrapped_attributions(spark):
    texts = ["On Monday he\nwrote:\n> x\nmine", "On Monday the 3rd of May,\nAnn Carter <ann@example.org>\nwrote:\n\n> x\nmine", "On balance I agree.\nAnn wrote:\n> x", "I think so\nAnn wrote:\n> x", "On Monday he\n\nwrote:\n> x"]
    got = [x.own for x in parse_quotes(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    assert got == ["mine", "mine", "On balance I agree.", "I think so", "On Monday he"]


def test_long_text_of_many_quotes(spark):
    said = [f"Point {i} of a very long discussion, said once." for i in range(3_000)]
    rows = [(1, 0, "u", "\n\n".join(said)), (1, 1, "u", "\n".join(f"> {x}\nanswer {i}" for i, x in enumerate(said)))]
    got = {r.turn: r for r in run(spark, rows)}
    assert got[1].reply_to == 0 and got[1].own.count("answer") == 3_000
