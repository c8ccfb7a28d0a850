"""Quotation linking: conversations in reply order, without quotes.

Quoted lines (``>``, nested) are parsed, normalised and hashed, and joined to the first message of the same conversation that holds the passage as
text of its own.  Everything is DataFrame expressions; a passage's hash is joined to one original, so popular lines do not multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch

_PREFIX = r"^(?:[ \t]*>)+[ \t]?"
_SALTS = 16


def quote_level(line: Column) -> Column:
    """Number of ``>`` in front of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _PREFIX, 0), "[^>]", ""))


def normalised(text: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


#: How mail programs introduce a quote, in lower case; a line that fits counts only in front of a quote.
ATTRIBUTION = r"(wrote|writes|said|schrieb|schreef|skrev|escribi\u00f3|escreveu|ha scritto|a \u00e9crit|a ecrit|pisze|napisa\u0142(a|\(a\))?)\s*:\s*$|^-+ ?(original message|forwarded message|urspr\u00fcngliche nachricht|mensaje original) ?-+$"
#: How the first line of an attribution that is wrapped over two or three begins, in lower case, and how a line ends that none goes on behind.
OPENING, CLOSED = r"^(on|am|le|el|em|il|op|den|dnia|w dniu) ", r"[.!?:;]$"
_SENTENCE_END = "(?<=[.!?]) "
_LEAST = 10


def _attributed(lines: Column, attribution: str) -> Column:
    """Lines (level, line) with level -1 for those of an attribution: one that fits, or up to three that fit as one and begin like one."""
    d = F.transform(lines, lambda x: F.struct(x["level"].alias("level"), x["line"].alias("line"), F.lower(F.trim(x["line"])).alias("low")))
    at = lambda i: F.get(d, i)
    behind = lambda i: F.get(F.filter(F.slice(d, i + 2, F.size(d)), lambda y: (y["level"] > 0) | (y["low"] != "")), 0)["level"]
    plain = lambda x: (x["level"] == 0) & (x["low"] != "")
    opens = lambda x: x["low"].rlike(OPENING)
    goes_on = lambda x: plain(x) & ~x["low"].rlike(CLOSED)
    no = F.lit(False)

    def fits(i, n: int) -> Column:
        """Are the ``n`` lines up to line i an attribution?"""
        x = at(i)
        if n == 1:
            front, text = F.lit(True), x["low"]
        else:
            before = [at(i - k) for k in range(n - 1, 0, -1)]
            front = opens(before[0]) & goes_on(before[0]) & ~opens(x)
            for y in before[1:]:
                front = front & goes_on(y) & ~opens(y)
            text = F.concat_ws(" ", *(y["low"] for y in before), x["low"])
        return F.coalesce(F.when(plain(x) & F.coalesce(front, no), F.when(text.rlike(attribution), behind(i) > 0)), no)

    ends = F.transform(d, lambda x, i: F.array(fits(i, 1), fits(i, 2), fits(i, 3)))

    def gone(i, ends: Column) -> Column:
        out = no
        for n in (1, 2, 3):
            for k in range(n):
                out = out | F.coalesce(F.get(F.get(ends, i + k), n - 1), no)
        return out

    both = F.struct(d.alias("d"), ends.alias("ends"))
    return F.flatten(F.transform(F.array(both), lambda b: F.transform(b["d"], lambda x, i: F.struct(F.when(gone(i, b["ends"]), -1).otherwise(x["level"]).alias("level"), x["line"].alias("line")))))


def parse_quotes(messages: DataFrame, attribution: str = ATTRIBUTION) -> DataFrame:
    """Each message with ``own`` (its text without quotes and attribution lines) and ``parts``: (level, run, key, kind) of its passages.

    An attribution is a line that fits the pattern, in lower case and trimmed, with nothing but blank lines between it and a quote.  Two or three lines that fit as one are
    one too, if the first begins as :data:`OPENING` says, no other does, and none but the last ends like a sentence.

    Own passages have level 0 and run 0, quoted ones the number of their run.  A passage is a whole run of lines of one level, a paragraph, a line or, from ten characters
    on, a sentence; its key hashes the normalised text, and only a blank one has none.  ``kind`` is 2 for a sentence that is none of the others, 1 for a line of less than ten
    characters that is neither a run nor a paragraph, and else 0.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\r?\n")
    d = messages.withColumn("lines", F.transform(lines, lambda x: F.struct(quote_level(x).alias("level"), F.regexp_replace(x, _PREFIX, "").alias("line"))))
    # most messages quote nothing and have no attribution
    d = d.withColumn("lines", F.when(F.exists("lines", lambda x: x["level"] > 0), _attributed(F.col("lines"), attribution)).otherwise(F.col("lines")))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n")
    d = d.withColumn("own", F.regexp_replace(own, r"^\s+|\s+$", ""))
    # runs of one level as text: a separator stands in front of each line whose level is new
    new = lambda x, i: F.coalesce(F.get("lines", i - 1)["level"] != x["level"], F.lit(True))
    marked = F.array_join(F.transform("lines", lambda x, i: F.concat(F.when(new(x, i), F.concat(F.lit("\x1e"), x["level"].cast("string"), F.lit("\x1f"))).otherwise("\n"), F.translate(x["line"], "\x1e\x1f", "  "))), "")
    runs = F.transform(F.filter(F.split(marked, "\x1e"), lambda r: r != ""), lambda r, i: F.struct(F.substring_index(r, "\x1f", 1).cast("int").alias("level"), i.alias("run"), F.substring_index(r, "\x1f", -1).alias("text")))
    d = d.withColumn("runs", F.filter(runs, lambda r: r["level"] >= 0)).drop("lines")
    cut = lambda r: F.struct(
        r["level"].alias("level"),
        F.when(r["level"] > 0, r["run"]).otherwise(0).alias("run"),
        F.transform(F.concat(F.array(r["text"]), F.split(r["text"], r"\n\s*\n")), normalised).alias("wide"),
        F.transform(F.split(r["text"], "\n"), normalised).alias("lines"),
        F.filter(F.split(normalised(r["text"]), _SENTENCE_END), lambda p: F.length(p) >= _LEAST).alias("sentences"),
    )
    d = d.withColumn("runs", F.transform("runs", cut))
    named = lambda r, of, kind: F.transform(of, lambda p: F.struct(r["level"].alias("level"), r["run"].alias("run"), p.alias("p"), kind(p).alias("kind")))
    # lines that are a run or a paragraph are there already, and so are sentences that are a line
    pieces = lambda r: F.concat(
        named(r, F.array_distinct(r["wide"]), lambda p: F.lit(0)),
        named(r, F.array_except(r["lines"], r["wide"]), lambda p: F.when(F.length(p) < _LEAST, 1).otherwise(0)),
        named(r, F.array_except(F.array_except(r["sentences"], r["lines"]), r["wide"]), lambda p: F.lit(2)),
    )
    keyed = F.flatten(F.transform("runs", pieces))
    parts = F.transform(F.filter(keyed, lambda x: x["p"] != ""), lambda x: F.struct(x["level"].alias("level"), x["run"].alias("run"), F.sha2(x["p"], 256).alias("key"), x["kind"].alias("kind")))
    return d.withColumn("parts", F.array_distinct(parts)).drop("runs")


def link_quotes(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, origin, hits, short): the earlier messages whose own passages a message quotes, by level; ``short`` if by short lines only.

    The longest match wins: sentences of a quoted run count only where neither the run nor a paragraph or line of it is linked.
    """
    parts = messages.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("parts").alias("p")).select("conv_id", "turn", "p.*")
    firsts = parts.where("level = 0").groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))
    quoted = parts.where("level > 0").groupBy("conv_id", "turn", "level", "run", "key").agg(F.min("kind").alias("kind")).withColumn("salt", F.pmod("turn", F.lit(_SALTS)).cast("int"))
    firsts = firsts.join(quoted.select("conv_id", "key").distinct(), ["conv_id", "key"], "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    hit = quoted.join(firsts, ["conv_id", "key", "salt"]).where("origin < turn")
    wider = F.min(F.when(F.col("kind") == 2, 1).otherwise(0)).over(Window.partitionBy("conv_id", "turn", "level", "run")) == 0
    hit = hit.withColumn("wider", wider).where("kind < 2 or not wider")
    return hit.groupBy("conv_id", "turn", "level", "origin").agg(F.count("*").alias("hits"), F.min(F.col("kind") == 1).alias("short"))


def reply_order(replies: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, reply_to) with ``thread`` (the first message of the chain of replies) and ``depth``, by pointer doubling.

    Each (conv_id, turn) comes once and replies to an earlier turn; none of the three is null.  An empty table gives an empty one.
    """
    now = scratch.write(replies.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "hop0")
    step = 0
    while True:
        # a thread may hold most rows: its messages ask from some salts
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"), F.col("depth").alias("more"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
        far = now.withColumn("salt", F.pmod("turn", F.lit(_SALTS)).cast("int")).join(up, ["conv_id", "thread", "salt"], "left").select("conv_id", "turn", "reply_to", F.coalesce("next", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"))
        step += 1
        far = scratch.write(far, f"hop{step}")
        now = far.drop("moved")
        if far.where("moved").isEmpty():
            return now


def build_conversations(messages: DataFrame, attribution: str = ATTRIBUTION) -> DataFrame:
    """Conversations (conv_id, turn, role, text) in reply order: each row with ``own`` text, ``reply_to``, ``thread``, ``depth``, ``n_quotes``.

    A message replies to the latest of the messages that its least nested linked quotes come from; without a linked quote it begins a thread.  Single
    lines of less than ten characters count as quotes, but decide the reply only where no run, paragraph or longer line is linked.
    Rows are sorted by (conv_id, thread, turn) within ranges, so that a reply follows what it answers.  Rows that share conv_id and turn are one message for
    linking, and all are returned; rows without conv_id or turn, and null texts, have no links.  Other columns are dropped.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    parsed = scratch.write(parse_quotes(messages.select("conv_id", "turn", "role", "text"), attribution), "parsed")
    links = scratch.write(link_quotes(parsed), "links")
    best = links.groupBy("conv_id", "turn").agg(F.min(F.struct("short", "level", (-F.col("origin")).alias("o"))).alias("b"), F.count("*").alias("n_quotes"))
    replies = scratch.write(best.select("conv_id", "turn", (-F.col("b.o")).alias("reply_to"), "n_quotes"), "replies")
    order = reply_order(replies, scratch).join(replies.select("conv_id", "turn", "n_quotes"), ["conv_id", "turn"])
    out = parsed.join(order, ["conv_id", "turn"], "left")
    out = out.select("conv_id", F.coalesce("thread", "turn").alias("thread"), "turn", "role", "own", "reply_to", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"))
    return out.repartitionByRange("conv_id", "thread", "turn").sortWithinPartitions("conv_id", "thread", "turn")
