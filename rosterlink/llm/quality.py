"""Quality of texts by logistic regression over hashed word n-grams.

Features are words, pairs of neighbouring words, and the same for word shapes,
and whether the two words of a pair are equal,
hashed into a fixed number of buckets; a text's value for a bucket is its count
over the root of all its n-grams. Weights are learnt with
follow-the-regularised-leader updates: every shard of the labelled rows goes
through its rows in a fixed order, the shards' states are averaged, and the
next round starts from there. A score is one sparse dot product.

Training reads ``most_rows`` labelled rows at most, chosen by hash; fewer are
all read. Null and empty texts have no n-grams and get the score of the bias
alone. Rows without a label of 0 or 1 are not learnt from; without any the
bias is 0 and every score 0.5. A row counts as often as it is labelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import settled
from .words import chunks, mix, text_buffers, word_hashes

BUCKETS = 1 << 18
MOST_ROWS, ROUNDS, SHARDS = 20_000, 3, 6
# Step size, its damping, and the two penalties of the updates.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.1
# N-grams handled at once.
_BLOCK = 1 << 18
_SIZES = (1, 2)


def _ngram_buckets(hashes: np.ndarray, rows: np.ndarray, kind: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of each n-gram inside a row, block by block."""
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    for size in _SIZES:
        salt = np.uint64(0x51ED27 * (kind * 8 + size))
        for low in range(0, max(len(hashes) - size + 1, 0), _BLOCK):
            high = min(low + _BLOCK, len(hashes) - size + 1)
            inside = owner[low:high] == owner[low + size - 1: high + size - 1]
            values = hashes[low:high] + salt
            for k in range(1, size):
                values = mix(values) + hashes[low + k: high + k]
            yield owner[low:high][inside], (mix(values[inside]) & np.uint64(BUCKETS - 1)).astype(np.int64)
            if size == 2:
                # Whatever the word, a pair of equal words.
                again = owner[low:high][inside & (hashes[low:high] == hashes[low + 1: high + 1])]
                yield again, np.full(len(again), kind)


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for kind in (0, 1):
        yield from _ngram_buckets(*word_hashes(data, offsets, shapes=bool(kind)), kind)


@dataclass
class Ftrl:
    """State of the updates: sums of gradients and of their squares; the last place is the bias."""

    sums: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + 1, np.float32))
    squares: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + 1, np.float32))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        sums, roots = self.sums[at], np.sqrt(self.squares[at])
        shrunk = np.sign(sums) * np.maximum(np.abs(sums) - L1, 0)
        return -shrunk / ((BETA + roots) / ALPHA + L2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: float) -> None:
        weights = self.weights(places)
        gradient = (_sigmoid(float(weights @ values)) - label) * values
        squares = self.squares[places]
        more = squares + gradient * gradient
        self.sums[places] += gradient - (np.sqrt(more) - np.sqrt(squares)) / ALPHA * weights
        self.squares[places] = more


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _text_features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and values of one text, with the bias."""
    found = [buckets for _, buckets in _features(data, np.array([0, len(data)]))]
    if sum(map(len, found)) > _BLOCK:
        counts = np.zeros(BUCKETS, np.int64)
        for buckets in found:
            counts += np.bincount(buckets, minlength=BUCKETS)
        places = np.flatnonzero(counts)
        counts = counts[places]
    else:
        places, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    values = counts / np.sqrt(max(counts.sum(), 1))
    return np.append(places, BUCKETS), np.append(values, 1.0).astype(np.float32)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
    most_rows: int = MOST_ROWS,
) -> np.ndarray:
    """Weights of all buckets and the bias, from the texts whose id has a label of 0 or 1."""
    spark = docs.sparkSession
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    rows = rows.where(F.col("label").isin(0.0, 1.0)).withColumn("draw", F.xxhash64("id"))
    count, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = min(1.0, most_rows / max(count, 1))
    # About ``most_rows`` ids and labels at most, so they can be broadcast.
    rows = rows.where(F.pmod("draw", F.lit(1_000_003)) < share * 1_000_003)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = settled(texts.join(F.broadcast(rows), "id")
                   .select("text", "label", F.pmod(F.shiftright("draw", 32), F.lit(SHARDS)).alias("shard"), "draw"))
    state = Ftrl()
    # The bias starts at the log odds of the labels.
    odds = float(np.log((positive + 1) / (count - positive + 1)))
    state.sums[BUCKETS] = -(odds * (BETA / ALPHA + L2) + np.sign(odds) * L1)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((state.sums, state.squares))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, own, seen = None, None, 0
            for batch in batches:
                data, offsets = text_buffers(batch.column(0))
                shards, labels = batch.column(2).to_pylist(), batch.column(1).to_pylist()
                for i in range(batch.num_rows):
                    if shards[i] != shard:
                        if own is not None:
                            yield _state_row(own, seen)
                        shard, own, seen = shards[i], Ftrl(*(a.copy() for a in shared.value)), 0
                    own.learn(*_text_features(data[offsets[i]: offsets[i + 1]]), labels[i])
                    seen += 1
            if own is not None:
                yield _state_row(own, seen)

        dealt = rows.repartition("shard").sortWithinPartitions("shard", "draw", "text")
        total, sums, squares = 0, 0.0, 0.0
        # At most SHARDS rows of fixed size.
        for row in dealt.mapInArrow(run, "seen bigint, sums binary, squares binary").toLocalIterator():
            total += row.seen
            sums = sums + row.seen * np.frombuffer(row.sums, np.float32)
            squares = squares + row.seen * np.frombuffer(row.squares, np.float32)
        if not total:
            break
        state = Ftrl((sums / total).astype(np.float32), (squares / total).astype(np.float32))
    return state.weights().astype(np.float32)


def _state_row(state: Ftrl, seen: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([seen]), pa.array([state.sums.tobytes()], pa.binary()), pa.array([state.squares.tobytes()], pa.binary())],
        names=["seen", "sums", "squares"])


def scores(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Score of each row of a chunk of texts."""
    count = len(offsets) - 1
    sums, sizes = np.zeros(count), np.zeros(count)
    for owner, buckets in _features(data, offsets):
        sums += np.bincount(owner, weights[buckets], count)
        sizes += np.bincount(owner, minlength=count)
    return _sigmoid(sums / np.sqrt(np.maximum(sizes, 1)) + weights[BUCKETS])


def score_texts(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and ``score``, from 0 to 1, of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            found = [scores(shared.value, data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]) for a, b in chunks(offsets)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], names=["id", "score"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
