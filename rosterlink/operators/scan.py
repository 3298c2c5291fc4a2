"""Similar names found by comparing signatures, block of names by block of names.

Names made of few parts, or cutoffs far below 100, let most names share some of
their rarest grams; keys then bring together more pairs than there are pairs of
names. So as long as the pairs of names are few enough (``MOST_SCANNED``), all of
them are compared instead, by bounds only: the character bag and the kinds of
grams, 24 bytes of a text, many pairs at once. Spark deals the pairs of blocks;
a task holds one pair of blocks. Pairs within the bounds are scored as others.
"""

from __future__ import annotations

from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from . import grams as G
from .index import Fresh

# Most pairs of names that are compared by signatures; a core compares some 300 million of them in a second.
MOST_SCANNED = 100_000_000_000
# Names of a block, about.
BLOCK = 16_384
# Pairs whose signatures are held at once.
_CELLS = 1 << 18
_PAIRS = "name string, contact_name string, contact_pos bigint, most double"
_WORDS = ("bag", "low", "high", "inner_low", "inner_high", "hay_bag", "hay_low", "hay_high")


def few_enough(wanted: DataFrame, contacts: DataFrame) -> bool:
    return wanted.count() * contacts.count() <= MOST_SCANNED


def _texts(names: DataFrame, position: list[str]) -> DataFrame:
    """One row per text of a name: its signatures, and what it is compared as."""
    words = F.array_join("words", " ")
    texts = F.array_distinct(F.array(words, F.col("name"), F.col("flat")))
    # Of all texts of a name together: what a window of it can hold.
    together = lambda of: F.aggregate("_texts", F.lit(0).cast("bigint"), lambda word, t: word.bitwiseOR(of(t)))
    named = names.withColumn("_items", G.item_texts()).withColumn("_texts", texts).select(
        "name", *position, "size", "_items", F.posexplode("_texts").alias("_at", "_text"),
        together(G.bag).alias("hay_bag"), G.gram_bits(F.flatten(F.transform("_texts", G.inner_grams))).alias("_hay"))
    text = F.col("_text")
    return named.select(
        "name", *position, "size", F.char_length(text).alias("n"), F.array_contains("_items", text).alias("item"),
        (text != "").alias("form"), (F.col("_at") == 0).alias("first"), G.bag(text).alias("bag"),
        G.gram_bits(G.padded_grams(text)).alias("_padded"), G.gram_bits(G.inner_grams(text)).alias("_inner"), "hay_bag", "_hay",
    ).select("*", *[F.col(f"_{of}")[i].alias(name) for of, pair in (
        ("padded", ("low", "high")), ("inner", ("inner_low", "inner_high")), ("hay", ("hay_low", "hay_high"))) for i, name in enumerate(pair)]
    ).drop("_padded", "_inner", "_hay")


def scanned_pairs(wanted: DataFrame, contacts: DataFrame, share: float, window: float | None = None, kept: Fresh | None = None) -> DataFrame:
    """Candidates as ``grams.similar_pairs`` gives them and, with a ``window`` share, those of ``grams.window_pairs`` for spreads of 1.5 to 8."""
    kept = kept or Fresh()
    left = _texts(wanted, [])
    right = kept.table("texts", ["name"], lambda: _texts(contacts, ["contact_pos"]))
    ours, theirs = (-(-names.count() // BLOCK) or 1 for names in (wanted, contacts))
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def block(blocks: int) -> Column:
        return F.pmod(F.xxhash64(F.lit("block"), "name"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    # By number, so that adaptive execution leaves the pairs of blocks apart: little to read, much to compare.
    left = left.withColumn("_ours", block(ours)).withColumn("_theirs", every(theirs)).repartition(parts, "_ours", "_theirs")
    right = right.withColumn("_theirs", block(theirs)).withColumn("_ours", every(ours)).repartition(parts, "_ours", "_theirs")

    def compare(one: pa.Table, other: pa.Table) -> pa.Table:
        a, b = _columns(one), _columns(other)
        found = _similar(a, b, share)
        if window is not None:
            found += _windows(a, b, window)
            found += [(i, j, most) for j, i, most in _windows(b, a, window)]
        rows, columns = (np.concatenate([np.zeros(0, dtype=np.int64), *[f[k] for f in found]]) for k in (0, 1))
        most = np.concatenate([np.zeros(0), *[f[2] for f in found]])
        return pa.table({
            "name": one["name"].combine_chunks().take(pa.array(rows)), "contact_name": other["name"].combine_chunks().take(pa.array(columns)),
            "contact_pos": other["contact_pos"].combine_chunks().take(pa.array(columns)), "most": most})

    return left.groupBy("_ours", "_theirs").cogroup(right.groupBy("_ours", "_theirs")).applyInArrow(compare, _PAIRS)


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: table[c].to_numpy().astype(bool) for c in ("item", "form", "first")}
    out |= {c: table[c].to_numpy().astype(np.int64) for c in ("n", "size")}
    return out | {c: table[c].to_numpy().astype(np.int64).view(np.uint64) for c in _WORDS}


def _groups(values: np.ndarray, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """``rows`` by their value."""
    rows = rows[np.argsort(values[rows], kind="stable")]
    kinds, starts = np.unique(values[rows], return_index=True)
    return list(zip(kinds.tolist(), np.split(rows, starts[1:]))) if len(rows) else []


def _lacking(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left & ~right).astype(np.int64)


def _within(left: np.ndarray, right: np.ndarray, most: int):
    """Places of all pairs of which the right word lacks ``most`` bits of the left one or fewer."""
    lacks, step = ~right, max(1, _CELLS // max(1, len(right)))
    for start in range(0, len(left), step):
        rows, columns = np.nonzero(np.bitwise_count(left[start: start + step, None] & lacks) <= most)
        if len(rows):
            yield rows + start, columns


def _similar(a: dict, b: dict, share: float) -> list[tuple]:
    found = []
    theirs = _groups(b["n"], np.flatnonzero(b["item"]))
    for n, ours in _groups(a["n"], np.flatnonzero(a["item"])):
        for m, other in theirs:
            edits = G.edits_of(share, n, m)
            if edits < abs(n - m):
                continue
            gone, come = (edits + n - m) // 2, (edits + m - n) // 2
            for i, j in _within(a["bag"][ours], b["bag"][other], gone):
                i, j = ours[i], other[j]
                near = _lacking(b["bag"][j], a["bag"][i]) <= come
                i, j = i[near], j[near]
                spoilt = _lacking(a["low"][i], b["low"][j]) + _lacking(a["high"][i], b["high"][j])
                new = _lacking(b["low"][j], a["low"][i]) + _lacking(b["high"][j], a["high"][i])
                # A removal spoils two grams, an insertion one.
                near = (spoilt <= 2 * gone + come) & (new <= 2 * come + gone)
                i, j, spoilt, new = i[near], j[near], spoilt[near], new[near]
                least = np.maximum(2 * _lacking(a["bag"][i], b["bag"][j]) - n + m, 2 * _lacking(b["bag"][j], a["bag"][i]) + n - m)
                least = np.maximum(least, np.maximum(2 * spoilt - n + m, 2 * new + n - m) / 3)
                found.append((i, j, (1.0 - least / max(n + m, 1)) * 100.0))
    return found


def _windows(a: dict, b: dict, share: float) -> list[tuple]:
    """Whole texts of ``a`` that a window in a text of ``b`` may resemble."""
    found = []
    hays = _groups(b["size"], np.flatnonzero(b["first"]))
    for n, needles in _groups(a["n"], np.flatnonzero(a["form"])):
        removed = floor(2 * n * (1 - share) / (2 - share) + G.SLACK)
        lost = floor(n * G._most_lost(share) + G.SLACK)
        for size, ours in _groups(a["size"], needles):
            fits = [rows for m, rows in hays if S.PARTIAL_FROM <= max(size, m) / min(size, m) <= S.FAR_FROM]
            if not fits:
                continue
            other = np.concatenate(fits)
            for i, j in _within(a["bag"][ours], b["hay_bag"][other], removed):
                i, j = ours[i], other[j]
                spoilt = _lacking(a["inner_low"][i], b["hay_low"][j]) + _lacking(a["inner_high"][i], b["hay_high"][j])
                i, j = i[spoilt <= lost], j[spoilt <= lost]
                gone = _lacking(a["bag"][i], b["hay_bag"][j])
                found.append((i, j, (1.0 - gone / (2 * n - gone)) * (100.0 * S.PARTIAL_WEIGHT)))
    return found
