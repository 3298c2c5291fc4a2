"""Classifiers over distinct values: a catalogue kept as a table, and plain Python functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import apply_classifier, classify_by_rules, python_classifier
from ..functions.text import characters, is_blank, strip
from ..store import settled
from . import grams as G
from .normalize import quoted

# Passes of a catalogue, the first that hits counts.
_EXACT, _PARTIAL = 0, 1


def _folded(text: Column) -> Column:
    return F.lower(strip(text))


def _pieces(text: Column) -> Column:
    """What a text that contains another must share with it: pairs of characters, and the characters for short ones."""
    return F.concat(G.inner_grams(text), characters(text))


def _rarest(text: Column, order: G.Order) -> Column:
    """One piece of a text: its rarest pair of characters, or its only character."""
    pieces = F.when(F.char_length(text) > 1, G.inner_grams(text)).otherwise(characters(text))
    return F.substring(F.array_min(F.transform(pieces, order.ranked)), 5, 2)


def contained(inner: DataFrame, outer: DataFrame, order: G.Order) -> DataFrame:
    """Pairs ``inner, outer`` (columns of that name) of which the first text stands inside the second.

    The rarest piece of the inner text looks up all pieces of the outer ones,
    so no pair is met that does not share it.
    """
    probes = inner.withColumn("_piece", _rarest(F.col("inner"), order))
    table = outer.withColumn("_piece", F.explode(F.array_distinct(_pieces(F.col("outer")))))
    return probes.join(table, "_piece").where(F.contains("outer", "inner")).drop("_piece")


def catalogue_hits(texts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``text, category`` of the distinct folded ``text`` that a catalogue knows.

    ``catalogue`` has ``priority, category, name`` (lower case). An equal name
    counts first, else the one of least priority that contains the text or is
    contained in it; of equal priorities the least category. Blank names and
    texts hit nothing.
    """
    texts = settled(texts.where(F.col("text").isNotNull() & (F.col("text") != "")).select("text").distinct())
    known = catalogue.where(F.col("name").isNotNull() & (F.col("name") != "") & F.col("category").isNotNull())
    rank = F.struct("priority", "category").alias("rank")
    # A name held by several categories is looked up once.
    known = settled(known.select("name", rank).groupBy("name").agg(F.min("rank").alias("rank")))
    order = G.Order(texts.select(_pieces(F.col("text"))).unionByName(known.select(_pieces(F.col("name"))).toDF(
        texts.select(_pieces(F.col("text"))).columns[0])))
    own = texts.select(F.col("text").alias("inner"))
    names = known.select(F.col("name").alias("inner"), "rank")
    hit = lambda level: F.struct(F.lit(level).alias("level"), "rank").alias("hit")
    found = [
        texts.join(known.withColumnRenamed("name", "text"), "text").select("text", hit(_EXACT)),
        contained(own, names.withColumnRenamed("inner", "outer"), order).select(F.col("inner").alias("text"), hit(_PARTIAL)),
        contained(names, own.withColumnRenamed("inner", "outer"), order).select(F.col("outer").alias("text"), hit(_PARTIAL)),
    ]
    every = found[0].unionByName(found[1]).unionByName(found[2])
    return every.groupBy("text").agg(F.min("hit").alias("hit")).select("text", F.col("hit.rank.category").alias("category"))


def classify_by_catalogue(
    frame: DataFrame, column: str, catalogue: DataFrame, *, patterns: Sequence[tuple[str, str]] = (), default: str, name: str
) -> DataFrame:
    """Adds the category ``name`` of ``column``, from a catalogue of any size that is a table.

    Gives what ``classify_by_rules`` gives for the same names as literals:
    equal names, names that overlap, ``patterns``, ``default``; blank text ``""``.
    """
    if name in frame.columns:
        frame = frame.drop(name)
    keyed = frame.withColumn("_folded", _folded(quoted(column)))
    hits = catalogue_hits(keyed.select(F.col("_folded").alias("text")), catalogue)
    hits = hits.select(F.col("text").alias("_folded"), F.col("category").alias("_category"))
    rest = classify_by_rules(quoted(column), patterns=patterns, default=default)
    category = F.when(is_blank(quoted(column)), F.lit("")).otherwise(F.coalesce("_category", rest))
    return keyed.join(hits, "_folded", "left").withColumn(name, category).drop("_folded", "_category")


def with_category(frame: DataFrame, name: str, text: Column, classifier: Callable) -> DataFrame:
    """Adds the category ``name`` of ``text``.

    A Column classifier is part of the projection. Any other function is called
    once for each distinct text, and its answers are joined back; ``frame`` is
    written once for that. It is called with ``None`` never: null stays null.
    """
    if getattr(classifier, "works_on_columns", False):
        return frame.withColumn(name, apply_classifier(classifier, text))
    keyed = settled(frame.drop(name).withColumn("_text", text))
    values = settled(keyed.where(F.col("_text").isNotNull()).select("_text").distinct())
    answers = settled(values.select(F.col("_text").alias("_value"), python_classifier(classifier)("_text").alias(name)))
    return keyed.join(answers, F.col("_text") == F.col("_value"), "left").drop("_text", "_value")
