"""A training corpus from ``documents``: each stage takes what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlink.llm import bpe, jaccard, langid, lines, mixing
from rosterlink.store import settled

#: The rank file of the byte-level vocabulary.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Words of a shingle, and the least similarity of near copies; the query ``op9_jaccard`` has other values.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus itself teaches; rejected ones go."""
    return langid.accepted(docs, langid.train(docs.select("text", "lang")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many documents repeat; ``n_chars`` follows the text."""
    kept = lines.drop_repeated_lines(docs, whole_rows=True)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return kept if length is None else kept.withColumn("n_chars", length).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of similar ones."""
    judged = jaccard.similar_documents(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    gone = judged.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; rows with one id as often as the most of them."""
    copies = mixing.mix_sources(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies")).where("_copies > 0")
    taken = docs.alias("d").join(copies.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c._id")))
    rows = F.array_repeat(F.struct("d.*"), F.col("c._copies").cast("int"))
    return taken.select(F.explode(rows).alias("row")).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left."""
    return bpe.encode(docs, bpe.read_ranks(RANKS))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: The language models and the random rounding of the mix are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
