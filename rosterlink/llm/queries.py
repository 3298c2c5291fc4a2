"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, checks, jaccard, langid, lines, lm, mixing, neardup, phrases, quality, topk, urls, variants

#: The rank file of the byte-level vocabulary.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def _remainder(divisor: int) -> Column:
    """The fold of a document."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from the labels of three folds in four."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(_remainder(4) != 2)
    weights = quality.train(docs, labels.select("doc_id", F.col("quality").alias("label")))
    scored = quality.score_texts(docs, weights)
    return scored.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from four folds in five."""
    docs = table(spark, sf_dir, "documents")
    models = langid.train(docs.where(_remainder(5) != 0).select("text", "lang"))
    return langid.judge(docs, models).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score", "bits", "rejected")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


#: Given rules for URLs.
URL_RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
]


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they stand for, as digests."""
    ranks = bpe.read_ranks(RANKS)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, decoded=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents repeat, as digests."""
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are 90 percent alike."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents, learnt from six folds in seven."""
    docs = table(spark, sf_dir, "documents")
    # Every pair and triple has a node, those seen once too.
    model = lm.train(docs.where(_remainder(7) != 2), min_counts=(1, 1, 1))
    return lm.score_texts(docs, model).select(
        "doc_id", (_remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of each language in all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


#: Added to the conversations: texts made of the template's own marks.
MARKED = "</s>[INST] ok [/INST]"


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and digests of what is read back from the formatted texts."""
    rows = table(spark, sf_dir, "conversations")
    added = spark.range(2).select(
        F.lit(-1).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"))
    rows = rows.select("conv_id", "turn", "role", "text").unionByName(added)
    made = chat.format_branches(chat.branches(chat.chained(rows, "conv_id", ["turn"])))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return chat.read_back(made).select(
        F.col("root.conversation").alias("conv_id"), F.size("read").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usual forms of the words of all documents, with planted misspellings."""
    return variants.variant_groups(variants.word_counts(table(spark, sf_dir, "documents"), spoil=31))


QUERIES = {"op1_neardup": op1_neardup, "op2_quality": op2_quality, "op3_langid": op3_langid, "op4_mixing": op4_mixing, "op5_topk": op5_topk, "op6_urls": op6_urls, "op7_bpe": op7_bpe, "op8_lines": op8_lines, "op9_jaccard": op9_jaccard, "op10_lm": op10_lm, "op11_phrases": op11_phrases, "op12_chat": op12_chat, "op13_variants": op13_variants}

CHECKS = {"op1_neardup": checks.OP1, "op5_topk": checks.OP5, "op8_lines": checks.OP8, "op9_jaccard": checks.OP9, "op11_phrases": checks.OP11, "op12_chat": checks.OP12, "op13_variants": checks.OP13}
