"""The subpackage's queries, each an operator applied to a whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .decontamination import find_contamination
from .divergence import audit
from .jaccard_join import similar_components
from .mixing import mix
from .mpeg_audio import decode_audio, encode_text
from .pieces import encode_decode
from .quality_rules import judge, learn
from .quotes import build_conversations
from .suffix_dedup import remove_repeats
from .token_files import read_token_files, write_token_files
from .url_cascade import Rule, judge_urls
from .warc import read_warc, write_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MIX_POWERS, MIX_ROUNDS, MIX_SEED = (0.5, 0.7, 1.0), 8, 42


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    out = mix(docs, powers=MIX_POWERS, rounds=MIX_ROUNDS, seed=MIX_SEED)
    return out.select("doc_id", F.col("m_source").alias("source"), F.col("m_lang").alias("lang"), F.col("m_topic").alias("topic"), F.col("m_tokens").alias("tokens"), F.round("probability", 6).alias("probability"), "sampled")


def _op1_sql() -> str:
    """The raking rounds unrolled: one factor table for each half step."""
    margins = ("source", "lang", "topic")
    out = """
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, CASE WHEN doc_id IS NULL THEN md5(coalesce(text, '')) END AS textmd5,
  CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN regexp_matches(coalesce(text, ''), '[#*$%&<>]{2}') THEN 'markup'
    WHEN regexp_matches(coalesce(text, ''), '[0-9]{6}') THEN 'figures' WHEN regexp_matches(coalesce(text, ''), '[A-Z]{4}') THEN 'capitals' ELSE 'prose' END AS topic,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL)"""
    for m, p in zip(margins, MIX_POWERS, strict=True):
        out += f""",
{m}_w AS MATERIALIZED (SELECT {m} AS k, pow(sum(tokens), {p}) AS w FROM cells GROUP BY 1 HAVING sum(tokens) > 0),
{m}_0 AS MATERIALIZED (SELECT k, w / (SELECT sum(w) FROM {m}_w) AS target, CAST(1.0 AS DOUBLE) AS f FROM {m}_w)"""
    at = dict.fromkeys(margins, 0)
    for step in range(1, MIX_ROUNDS + 1):
        for m in margins:
            a, b = (x for x in margins if x != m)
            sums = f"SELECT c.{m} AS k, sum(c.tokens * coalesce(x.f, 0) * coalesce(y.f, 0)) AS s FROM cells c LEFT JOIN {a}_{at[a]} x ON x.k = c.{a} LEFT JOIN {b}_{at[b]} y ON y.k = c.{b} GROUP BY 1"
            out += f""",
{m}_{step} AS MATERIALIZED (SELECT t.k, t.target, CASE WHEN s.s > 0 THEN t.target / s.s ELSE 0 END AS f FROM {m}_{step - 1} t LEFT JOIN ({sums}) s ON s.k = t.k)"""
            at[m] = step
    n = MIX_ROUNDS
    return out + f""",
r AS (SELECT c.*, coalesce(x.f, 0) * coalesce(y.f, 0) * coalesce(z.f, 0) AS factor FROM cells c LEFT JOIN source_{n} x ON x.k = c.source LEFT JOIN lang_{n} y ON y.k = c.lang LEFT JOIN topic_{n} z ON z.k = c.topic),
p AS (SELECT d.*, CASE WHEN d.tokens > 0 THEN r.factor / (SELECT max(factor) FROM r WHERE tokens > 0) ELSE 1 END AS p FROM d JOIN r USING (source, lang, topic))
SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability,
  CAST(CAST('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), '(none)' || textmd5), '{MIX_SEED}')), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 < p AS sampled FROM p"""


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read_warc(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base 32 from SHA-1 hex digits: five hex digits are four base-32 digits.
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INTEGER, 1)" for g in range(8) for s in (15, 10, 5, 0))
OP2_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
t AS (SELECT page_id, h, CAST(strlen(html) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM t"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_conversations(table(spark, sf_dir, "conversations"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("word_bpe_49k.json"), 2)
    return read_token_files(index).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    out = decode_audio(encode_text(docs))
    feature = F.format_string("mp3 %d Hz %d kbps %d frames %d samples %d bad", "hertz", "max_kbps", "frames", "samples", "bad_checksums")
    return out.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
        F.col("seconds").alias("duration_seconds"),
        F.col("seek").alias("seek_offsets"),
    )


RULES = [Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block")]
#: Sites of the default list.
LISTED = [f"{name}.example.{top}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")]


def op10_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(x,) for x in LISTED], "key string")
    out = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES, listed)
    return out.select("page_id", "host", "path", "rule", "verdict")


def _op10_sql() -> str:
    fits = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'" for r in sorted(RULES, key=lambda r: -len(r.text)))
    says = " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in RULES)
    listed = ", ".join(f"'{x}'" for x in LISTED)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {fits} END AS rule FROM h)
SELECT page_id, host, path, rule, CASE rule {says} ELSE CASE WHEN list_has_any(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')), [{listed}]) THEN 'block' ELSE 'allow' END END AS verdict FROM r"""


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collocations(table(spark, sf_dir, "documents").select("lang", "text"))
    return out.withColumn("rank", F.col("rank").cast("long"))


OP11_SQL = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS parts FROM documents),
w AS (SELECT lang, regexp_extract_all(part, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(parts) AS part FROM d)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(list_slice(w, j, j + k - 1), ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS j FROM w), (SELECT unnest(range(1, 6)) AS k) WHERE j + k - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT p.lang, p.phrase, p.k, p.f AS a, j, x.f AS l, y.f AS r, n.n, (1000 * CAST(p.f AS HUGEINT) * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k >= 2) p JOIN n USING (lang)
  JOIN f x ON x.lang = p.lang AND x.phrase = array_to_string(list_slice(p.w, 1, j), ' ') JOIN f y ON y.lang = p.lang AND y.phrase = array_to_string(list_slice(p.w, j + 1, p.k), ' ')),
s AS (SELECT lang, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, array_to_string(list_slice(w, b, b + m - 1), ' ') AS phrase, max(f) AS within FROM (SELECT *, unnest(range(1, k + 1)) AS b FROM f WHERE k >= 3), (SELECT unnest(range(2, 5)) AS m) WHERE m < k AND b + m - 1 <= k GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s LEFT JOIN i USING (lang, phrase) WHERE within IS NULL OR 100 * within < 100 * a
QUALIFY rank <= 2000"""


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w, least(len(w), 10) AS n FROM benchmark),
g AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
m AS MATERIALIZED (SELECT r, i, n, item_id FROM (SELECT r, i, n, list_slice(w, i, i + n - 1) AS g FROM p, (SELECT DISTINCT n FROM g) WHERE i + n - 1 <= len(w)) JOIN g USING (n, g)),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS at FROM m) GROUP BY r),
f AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN f USING (r)"""


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT) // (coalesce(s.n, 0) + 2 * v.v) AS BIGINT) AS p, 1 + CAST(1000000000 * CAST(k.n + 2 AS HUGEINT) // (v.n + 2 * v.v) AS BIGINT) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN s USING (lang, source)),
u AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(u.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN u ON u.lang = a.lang AND u.source = a.source AND u.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
WHERE part = 'pair' OR rank <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_warc_index, op3_quality_rules, op4_quotes, op5_suffix_dedup, op6_sentencepiece, op7_ngram_jaccard, op8_token_files, op9_mpeg_audio, op10_url_cascade, op11_collocations, op12_decontamination, op13_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": _op1_sql(), "op2_warc_index": OP2_SQL, "op10_url_cascade": _op10_sql(), "op11_collocations": OP11_SQL, "op12_decontamination": OP12_SQL, "op13_divergence": OP13_SQL}
