"""Exact top-k inner products by an impact-ordered index, score at a time.

Vectors of whole numbers are dealt into shards. In each shard every dimension
has its postings ordered by value and cut into segments of one quantised value
each. A query takes the segments of all dimensions by descending impact (its
own component times the segment's extreme value) and adds them to the scores.
What a row can still gain is bounded by the next impacts, so the query stops
once few rows can reach its k best, and these are scored exactly from their
vectors. Without that proof all segments are taken. The k best of all shards
are merged.

Components become ``floor(scale * x)``. Vectors null or holding null or
non-finite components take no part; shorter vectors count as filled with
zeros; empty ones score 0. Ties go to the smaller id, rows with a query's id
are not its candidates, and a query id given twice gives its answer twice
over the same ranks. Sums beyond 64 bits are held at their limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .vectors import finite, matrix

# Rows of a shard, about; quantised values of a dimension.
SHARD_ROWS, LEVELS = 8192, 16
# Segments between two looks for a proof.
_STRIDE = 96


class ImpactIndex:
    """The postings of one shard: ids and a matrix of whole numbers."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels: int = LEVELS) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        count, width = self.rows.shape
        self.postings, self.values, self.cuts = [], [], []
        for d in range(width):
            column = self.rows[:, d]
            low, high = int(column.min()), int(column.max())
            level = ((column - low).astype(np.float64) * (levels / (high - low + 1))).astype(np.int64)
            place = np.argsort(-level, kind="stable")
            self.postings.append(place)
            self.values.append(column[place].astype(np.float64))
            self.cuts.append(np.concatenate([[0], np.flatnonzero(np.diff(level[place])) + 1, [count]]))
        self.dims = np.concatenate([np.full(len(c) - 1, d) for d, c in enumerate(self.cuts)]) if width else np.zeros(0, int)
        self.starts = np.concatenate([c[:-1] for c in self.cuts]) if width else np.zeros(0, int)
        self.ends = np.concatenate([c[1:] for c in self.cuts]) if width else np.zeros(0, int)
        extremes = [(v[a:b].min(), v[a:b].max()) for v, c in zip(self.values, self.cuts) for a, b in zip(c, c[1:])]
        self.low, self.high = np.array(extremes).reshape(-1, 2).T
        self.largest = float(np.abs(self.rows.astype(np.float64)).max(initial=0))

    def _exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.largest * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(len(query), 1) < 2.0 ** 62:
            return self.rows[rows] @ query
        sums = self.rows[rows].astype(object) @ query.astype(object)
        return np.array([min(max(s, -(2 ** 63)), 2 ** 63 - 1) for s in sums], np.int64)

    def possible(self, query: np.ndarray, k: int) -> tuple[np.ndarray, int]:
        """Rows that can be among the k best, and how many segments it took to prove it."""
        count, width = self.rows.shape
        numbers = query.astype(np.float64)
        bound = self.largest * np.abs(numbers).max(initial=0) * max(width, 1)
        if count <= 4 * k or bound >= 2.0 ** 50:
            return np.arange(count), 0
        weights = numbers[self.dims]
        least = np.minimum(numbers * self.rows.min(axis=0), numbers * self.rows.max(axis=0))
        impacts = np.maximum(weights * self.low, weights * self.high) - least[self.dims]
        order = np.argsort(-impacts, kind="stable")
        scores = np.zeros(count)
        enough = max(4 * k, count // 64)
        left = np.zeros(width)
        np.maximum.at(left, self.dims, impacts)
        # The best impact of its dimension that is still to come after each segment.
        following = np.zeros(len(order))
        seen: dict[int, int] = {}
        for place in range(len(order) - 1, -1, -1):
            d = int(self.dims[order[place]])
            following[place] = impacts[seen[d]] if d in seen else 0.0
            seen[d] = order[place]
        for place, segment in enumerate(order.tolist()):
            d = self.dims[segment]
            a, b = self.starts[segment], self.ends[segment]
            scores[self.postings[d][a:b]] += self.values[d][a:b] * numbers[d] - least[d]
            left[d] = following[place]
            if place % _STRIDE == _STRIDE - 1:
                needed = np.partition(scores, count - k)[count - k]
                rows = np.flatnonzero(scores + left.sum() >= needed - 0.5)
                if len(rows) <= enough:
                    return rows, place + 1
        needed = np.partition(scores, count - k)[count - k]
        return np.flatnonzero(scores >= needed - 0.5), len(order)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows with another id than ``own``."""
        width = self.rows.shape[1]
        query = np.concatenate([query, np.zeros(max(width - len(query), 0), np.int64)])[:width]
        same = int(np.searchsorted(self.ids, own, "right") - np.searchsorted(self.ids, own, "left"))
        rows, _ = self.possible(query, min(k + same, len(self.ids)))
        rows = rows[self.ids[rows] != own]
        scores = self._exact(query, rows)
        # The complement of a whole number orders backwards, without overflow or rounding.
        best = np.lexsort((self.ids[rows], ~scores))[:k]
        return self.ids[rows[best]], scores[best]


def whole_numbers(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id",
    vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, id_col, score``: each query's k best rows (all, if fewer).

    Every shard meets every query, a batch of queries at a time; only the best
    k of each shard and query are shuffled. Rows with a null id take no part.
    """
    def valid(df: DataFrame) -> DataFrame:
        named = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
        return named.where(F.col("id").isNotNull() & finite(F.col("vector"))).select(
            "id", whole_numbers(F.col("vector"), scale).alias("vector"))

    rows, asked = valid(vectors), valid(queries)
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))).withColumn("asks", F.lit(0))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    dealt = rows.unionByName(asked.withColumn("asks", F.lit(1))).repartition("shard")
    dealt = dealt.sortWithinPartitions("shard", "asks", "id").select("shard", "asks", "id", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, index, parts = None, None, []
        for batch in batches:
            shards_, asks = (batch.column(i).to_numpy() for i in range(2))
            cuts = np.flatnonzero((np.diff(shards_) != 0) | (np.diff(asks) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards_)]):
                if low == high:
                    continue
                if shards_[low] != shard:
                    shard, index, parts = shards_[low], None, []
                ids = batch.column(2).slice(low, high - low).to_numpy()
                numbers = matrix(batch.column(3).slice(low, high - low), np.int64)
                if not asks[low]:
                    parts.append((ids, numbers))
                    continue
                if index is None and parts:
                    width = max(n.shape[1] for _, n in parts)
                    whole = np.concatenate([np.pad(n, ((0, 0), (0, width - n.shape[1]))) for _, n in parts])
                    index, parts = ImpactIndex(np.concatenate([i for i, _ in parts]), whole), []
                if index is None:
                    continue
                found = [(own, *index.search(own, query, k)) for own, query in zip(ids.tolist(), numbers)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found])),
                    pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
                    names=["query_id", "id", "score"])

    best = dealt.mapInArrow(run, "query_id bigint, id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
