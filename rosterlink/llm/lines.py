"""Dropping lines that many documents repeat.

Two Bloom filters of fixed size hold the hashes of long lines seen once and
seen twice. Tasks fill their own pair, pairs are merged by bit operations, and
only lines that may be in the second filter are shuffled: their whole keys are
counted exactly and the largest document that holds each is found. A false
positive costs one shuffled row, never a wrong answer.

A null or empty text is one empty line. Equal ids are one document; a null id
is a document smaller than all others. Columns of the input are carried in one
struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bits
from ..store import settled

MIN_CHARS, MIN_DOCS = 40, 5
# Bits of each filter at most; beyond, more lines are shuffled.
MOST_BITS = 1 << 26
_HASHES = 3
# Tasks that the rows of one key are dealt to.
_SALTS = 8
# Hashes a task gathers before it puts them into its filters.
_PENDING = 1 << 20


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z lower-cased."""
    return line.strip().lower()


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _positions(hashes: np.ndarray, size: int) -> np.ndarray:
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return np.stack([(low + np.uint64(k) * high) & np.uint64(size - 1) for k in range(_HASHES)]).astype(np.int64)


def _filled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A filter of ``size`` bits with these hashes."""
    places = np.unique(_positions(hashes, size))
    state = np.zeros(size // 8, np.uint8)
    if len(places):
        starts = np.flatnonzero(np.diff(places >> 3, prepend=-1))
        state[places[starts] >> 3] = np.bitwise_or.reduceat((128 >> (places & 7)).astype(np.uint8), starts)
    return state


def _interleaved(once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Both filters as one state whose slices hold the same places of both."""
    return np.stack([once, twice], axis=1).ravel()


def _combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a | b
    out[1::2] |= a[::2] & b[::2]
    return out


def _lines(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, list[bytes]]]:
    for batch in batches:
        texts = batch.column(column)
        for i in range(len(texts)):
            yield batch, i, (texts[i].as_py() or "").encode().split(b"\n")


def repeat_filter(texts: DataFrame, min_chars: int = MIN_CHARS, most_bits: int = MOST_BITS) -> np.ndarray:
    """The filter of long lines seen at least twice, from a frame of one text column."""
    chars = texts.agg(F.sum(F.char_length(texts.columns[0]))).first()[0] or 0
    size = 1 << 16
    while size < min(most_bits, 2 * chars // min_chars):
        size *= 2

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, pending = np.zeros(size // 4, np.uint8), []

        def flush() -> np.ndarray:
            hashes, counts = np.unique(np.array(pending, np.uint64), return_counts=True)
            pending.clear()
            return _combine(state, _interleaved(_filled(hashes, size), _filled(hashes[counts > 1], size)))

        for _, _, lines in _lines(batches, 0):
            keys = map(line_key, lines)
            pending.extend(xxhash.xxh3_64_intdigest(k) for k in keys if _long(k, min_chars))
            if len(pending) >= _PENDING:
                state = flush()
        yield from bits.slices(TaskContext.get().partitionId(), flush())

    tasks = texts.rdd.getNumPartitions()
    parts = bits.merged(texts.mapInArrow(gather, bits.SCHEMA), tasks, _combine)
    return bits.collected(parts, size // 4)[1::2].copy()


def _suspects(narrow: DataFrame, seen: np.ndarray, min_chars: int) -> DataFrame:
    """Distinct ``(id, key)`` of lines that may occur twice."""
    shared, size = narrow.sparkSession.sparkContext.broadcast(seen), len(seen) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = shared.value
        for batch in batches:
            rows, keys = [], []
            for _, i, lines in _lines([batch], 1):
                long = [k for k in set(map(line_key, lines)) if _long(k, min_chars)]
                rows.extend([i] * len(long))
                keys.extend(long)
            if keys:
                hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
                places = _positions(hashes, size)
                maybe = ((filled[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=0)
                chosen = np.flatnonzero(maybe)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.array(rows)[chosen])), pa.array([keys[k] for k in chosen], pa.binary())],
                    names=["id", "key"])

    kind = narrow.schema["id"]
    return narrow.mapInArrow(run, T.StructType([kind, T.StructField("key", T.BinaryType())]))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, most_bits: int = MOST_BITS, whole_rows: bool = False,
) -> DataFrame:
    """The id column, ``n_lines``, ``n_dropped`` and ``kept_text`` of every document.

    Lines with a key of ``min_chars`` code points or more that ``min_docs``
    documents hold stay only in the largest of these. With ``whole_rows`` the
    result is the input with the kept text in ``text_col``.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] if whole_rows else []
    wide = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
        (F.struct(*others) if others else F.lit(None).cast("string")).alias("row"))
    narrow = wide.select("id", "text")
    seen = repeat_filter(wide.select("text"), min_chars, most_bits)
    suspects = settled(_suspects(narrow, seen, min_chars))
    repeated = (suspects.groupBy("key", "id").agg(F.lit(1).alias("_one")).groupBy("key")
                .agg(F.count("*").alias("docs"), F.max("id").alias("keeper")).where(F.col("docs") >= min_docs))
    # A key may be in a third of all documents: its rows are dealt to several tasks.
    salted = suspects.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)))
    repeated = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    dropped = (salted.join(repeated, ["key", "salt"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
               .groupBy("id").agg(F.collect_set("key").alias("keys")))
    joined = wide.alias("d").join(dropped.alias("k"), F.col("d.id").eqNullSafe(F.col("k.id")), "left")
    joined = joined.select("d.row", "d.id", "d.text", "k.keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, totals, counts, texts = batch.column(3), [], [], []
            for _, i, lines in _lines([batch], 2):
                gone = lists[i].as_py()
                gone = set(gone) if gone else ()
                kept = [x for x in lines if line_key(x) not in gone] if gone else lines
                totals.append(len(lines))
                counts.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(texts, pa.string())], names=["row", "id", "n_lines", "n_dropped", "kept_text"])

    fields = [joined.schema["row"], joined.schema["id"], T.StructField("n_lines", T.LongType()),
              T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]
    result = joined.mapInArrow(run, T.StructType(fields))
    if not whole_rows:
        return result.select(F.col("id").alias(id_col), "n_lines", "n_dropped", "kept_text")
    return result.select(*[
        (F.col("kept_text") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
