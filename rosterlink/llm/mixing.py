"""Mixing sources to target weights by pivotal dependent rounding.

Every row of a source gets the same fractional number of copies. The whole
part is certain; the fraction is a mass of words (fraction times size). Two
rows at a time, mass moves at random from one to the other until one of them
is none or all, with chances that keep every row's expectation and the sum of
words as it is. What remains fractional of each bucket is paired again, bucket
by bucket, in a tree of reductions, so each source ends with one row that is
rounded to the nearer side.

Sources stand in code-point order, null last, and weigh as the given cycle.
A null text has size 0. Rows are told apart by id and size: repeated rows are
rows of their own. Random numbers depend on source, bucket and level only, so
reruns agree whatever the partitions.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..store import numbered, settled
from .words import BLOCK_BYTES, _IS_SPACE, text_buffers

WEIGHTS, MOST_COPIES = (5.0, 2.0, 1.0), 3
# Rows paired within one bucket, about.
BUCKET_ROWS = 128
# Fractions nearer than this to 0 or 1 are taken as such.
_FRACTION = 1e-12


def count_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each row, block by block."""
    counts = np.zeros(len(offsets) - 1, np.int64)
    edge = offsets[:-1]
    for low in range(0, len(data), BLOCK_BYTES):
        high = min(low + BLOCK_BYTES, len(data))
        word = ~_IS_SPACE[data[max(low - 1, 0): high]]
        before = np.concatenate([[False], word[:-1]]) if low == 0 else word[:-1]
        word = word if low == 0 else word[1:]
        cut = np.zeros(high - low, bool)
        inside = edge[(edge >= low) & (edge < high)]
        cut[inside - low] = True
        starts = np.flatnonzero(word & (cut | ~before)) + low
        counts += np.diff(np.searchsorted(starts, offsets))
    return counts


def with_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``id``, ``source`` and ``size`` (words) of each row."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                         F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = count_words(*text_buffers(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes)], names=["id", "source", "size"])

    fields = [narrow.schema["id"], narrow.schema["source"], T.StructField("size", T.LongType())]
    return narrow.mapInArrow(run, T.StructType(fields))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """``source``, ``source_size``, ``rows`` and ``target`` of each source.

    All words are shared out by weight; a source takes ``most`` times its
    words at most, and what is over is shared again among the others.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = numbered(sources, [F.col("source").asc_nulls_last()], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = settled(sources.withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int"))).drop("place"))
    limit = F.col("source_size") * float(most)
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    share, before = 0.0, -1
    while total:
        full = limit <= F.col("weight") * share
        at_limit, open_weight, count = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)), F.sum(F.when(~full, F.col("weight"))),
            F.coalesce(F.sum(full.cast("long")), F.lit(0))).first()
        if count == before or not open_weight:
            break
        before, share = count, max(share, (total - at_limit) / open_weight)
    return sources.select("source", "source_size", "rows", F.least(limit, F.col("weight") * share).alias("target"))


def _pair(one: list, two: list, draw: random.Random) -> None:
    """Move mass between two ``[fraction, size]`` until one fraction is 0 or 1."""
    (p, s), (q, t) = one, two
    gain, loss = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
    move = gain if draw.random() * (gain + loss) < loss else -loss
    one[0], two[0] = p + move / s, q - move / t
    for row in (one, two):
        if row[0] < _FRACTION or row[0] > 1 - _FRACTION:
            row[0] = float(round(row[0]))


def _settle_group(rows: list[list], draw: random.Random, last: bool) -> None:
    """Pair ``[fraction, size]`` rows in order; one stays fractional at most, none if ``last``."""
    carry = None
    for row in rows:
        if row[1] <= 0:
            row[0] = 0.0
        elif 0 < row[0] < 1:
            if carry is not None:
                _pair(carry, row, draw)
            if carry is None or not 0 < carry[0] < 1:
                carry = row if 0 < row[0] < 1 else None
    if last and carry is not None:
        carry[0] = float(carry[0] >= 0.5)


def _level(rows: DataFrame, level: int, seed: int, last: bool) -> DataFrame:
    """Settle every bucket of ``id, source, whole, size, fraction, bucket``; large rows are paired first."""
    order = ["source", "bucket", F.desc("size"), "id"]
    dealt = rows.repartition("source", "bucket").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cells() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[tuple] = []
        for key, group in itertools.groupby(cells(), lambda r: (r[1], r[5])):
            members = list(group)
            pairs = [[r[4], r[3]] for r in members]
            _settle_group(pairs, random.Random(xxhash.xxh64_intdigest(repr((seed, level, key)))), last)
            out.extend((*r[:4], p[0], r[5]) for r, p in zip(members, pairs))
            if len(out) >= 10_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    schema = to_arrow_schema(dealt.schema)
    return dealt.mapInArrow(run, dealt.schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES, bucket_rows: int = BUCKET_ROWS, seed: int = 0,
) -> DataFrame:
    """The id column, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size)."""
    sizes = settled(with_sizes(docs, id_col, text_col, source_col))
    sources = settled(source_targets(sizes, weights, float(most)))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ratio = F.least(ratio, F.lit(float(most)))
    known = sources.select(
        F.col("source").alias("_source"), F.floor(ratio).alias("whole"), (ratio - F.floor(ratio)).alias("fraction"),
        F.ceil(F.col("rows") / bucket_rows).alias("buckets"))
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.select(
        "id", "source", "whole", "size", "fraction",
        F.pmod(F.xxhash64("id", "size", F.lit(seed)), F.col("buckets")).alias("bucket"))
    most_buckets = known.agg(F.max("buckets")).first()[0] or 0
    decided, level = None, 0
    while True:
        last = most_buckets <= 1
        done = settled(_level(rows, level, seed, last))
        fractional = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        part = done if last else done.where(~fractional)
        decided = part if decided is None else decided.unionByName(part)
        if last:
            break
        rows = done.where(fractional).withColumn("bucket", F.expr(f"bucket div {bucket_rows}"))
        most_buckets, level = -(-most_buckets // bucket_rows), level + 1
    copies = (F.col("whole") + F.col("fraction").cast("long")).alias("copies")
    decided = decided.select("id", "source", "size", copies)
    totals = sources.select(F.col("source").alias("_source"), "source_size", "target")
    return (decided.join(totals, F.col("source").eqNullSafe(F.col("_source")))
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))
