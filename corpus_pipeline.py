"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's ``docs``; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctura.llm import queries as q
from junctura.llm.jaccard_join import similar_components
from junctura.llm.mixing import mix
from junctura.llm.pieces import encode_decode
from junctura.llm.quality_rules import judge, learn
from junctura.llm.store import Scratch
from junctura.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that neither the base rules nor the learned list rejects, each judged by its own text, whatever its id."""
    # the whole row stands for its id, so that the verdict needs no join
    rows = docs.select(F.struct(*COLUMNS).alias("row"), "text")
    return judge(rows, learn(docs, q.table(spark, sf_dir, "labels")), "row").where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar ones, that with the smallest id; a null id is never the smallest."""
    # ids may be null or occur twice: each row has a number of its own, and equal ids go by a digest of the row
    numbered = docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("digest"), F.monotonically_increasing_id().alias("row"))
    numbered = Scratch(spark, "numbered").write(numbered, "rows")
    found = similar_components(numbered.select("row", "text"), "row").select(F.col("id").alias("row"), "component")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest", "row")
    stay = found.join(numbered.select("row", "doc_id", "digest"), "row").groupBy("component").agg(F.min(order).alias("first")).select("first.row")
    return numbered.join(stay, "row", "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 100 bytes that start earlier in the corpus; a character of which a byte went goes whole.

    A null text and one of which nothing goes stay as they are, one of which all goes is dropped; of equal long rows, or rows without id, the first in the
    operator's order keeps its text.
    """
    out = remove_repeats(docs.select(*COLUMNS), characters=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))
    return out.withColumn("text", text).where("n_removed < n_bytes or n_removed = 0").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target shares of sources, languages and topics.

    A null source or language is a margin of its own; rows are drawn by their ids, those without id by their texts, so equal rows stay or go together.
    """
    return mix(docs, powers=q.MIX_POWERS, rounds=q.MIX_ROUNDS, seed=q.MIX_SEED).where("sampled").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, whatever its id; a null text has the end id alone."""
    out = encode_decode(docs.select("doc_id", "text"), q.vocabulary("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_passages), ("mixing", mixture), ("SentencePiece", pieces)]
#: The stages learn, search and segment: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
