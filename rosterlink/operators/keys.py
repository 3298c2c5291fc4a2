"""Tokens and substrings of names, and a join for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens

# Slack on computed bounds; the score itself always decides.
SLACK = 1e-9
# Longest name whose substrings are listed.
SUBSTRING_LENGTH = 64
# Slices a hot key is spread over.
SALTS = 16

def _length(text: Column | str) -> Column:
    return F.char_length(text)


def _up_to(first: Column, last: Column) -> Column:
    """``first..last``, empty when ``last < first`` (``sequence`` would count down)."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


# --- tokens ---------------------------------------------------------------------------


def with_tokens(names: DataFrame) -> DataFrame:
    """Adds ``size`` (length), sorted ``words``, distinct ``kinds`` and ``flat`` (kinds joined)."""
    return (
        names.withColumn("size", _length("name"))
        .withColumn("words", tokens("name"))
        .withColumn("kinds", F.array_distinct("words"))
        .withColumn("flat", F.array_join("kinds", " "))
    )


def substrings(names: DataFrame, shortest: Column, longest: Column, most: int) -> DataFrame:
    """Every substring ``key`` of ``name`` with a length in the given range.

    ``most`` is the length of the longest name; up to ``SUBSTRING_LENGTH`` the
    places come from a broadcast table of fixed size.
    """
    spark = names.sparkSession
    names = names.withColumn("_least", shortest).withColumn("_most", longest)
    if most <= SUBSTRING_LENGTH:
        places = spark.range(1, most + 1).select(F.col("id").cast("int").alias("_length"))
        places = places.withColumn("_width", F.explode(_up_to(F.lit(1), F.col("_length"))))
        places = places.withColumn("_start", F.explode(_up_to(F.lit(1), F.col("_length") - F.col("_width") + 1)))
        placed = names.withColumn("_length", _length("name")).join(F.broadcast(places), "_length")
        placed = placed.where((F.col("_width") >= F.col("_least")) & (F.col("_width") <= F.col("_most")))
    else:
        placed = names.withColumn("_width", F.explode(_up_to(F.col("_least"), F.col("_most"))))
        starts = _up_to(F.lit(1), _length("name") - F.col("_width") + 1)
        placed = placed.withColumn("_start", F.explode(starts))
    key = F.substring("name", F.col("_start"), F.col("_width"))
    return placed.withColumn("key", key).drop("_length", "_width", "_start", "_least", "_most")


# --- joins ----------------------------------------------------------------------------


def lookup(probes: DataFrame, table: DataFrame, by: str, salt_on: Column) -> DataFrame:
    """Inner join of many probes with a table that has few rows per key.

    A key may be hot among the probes.  The table is first cut down to keys
    that are probed at all, then repeated once per salt, so that the probes of
    one key spread over ``SALTS`` tasks.
    """
    live = table.join(probes.select(by).distinct(), by, "left_semi")
    live = live.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = probes.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(SALTS)).cast("int"))
    return salted.join(live, [by, "_salt"]).drop("_salt")
