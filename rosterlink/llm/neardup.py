"""Vectors with cosine at or above a threshold, by PCA-ordered tiled comparison.

Equal vectors are one class. Class vectors are scaled to length 1 and turned
to principal axes, which changes no cosine. The leading axes cut space into
cells as wide as linked vectors can be apart, cells are cut into tiles of
bounded size, and only tiles whose boxes on the leading axes are near enough
meet. Two tiles are compared some leading dimensions at a time: what the rest
can add is at most the product of the suffix norms, and pairs that cannot
reach the threshold stop there. Pairs that are left are decided in double
precision on the vectors as given.

Pairs are never written out: a comparison of two tiles gives the number of
links of each row and a forest of links that joins the same rows.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; shorter vectors count as filled with zeros. Rows with one id are
one vector if they are equal, else the one that sorts first counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..store import numbered, settled
from .components import components
from .vectors import finite, matrix

THRESHOLD = 0.95
# Leading axes that make the cells, and that bound the boxes of tiles.
CELL_AXES, BOX_AXES = 3, 8
# Rows of a tile, and of the group of tiles that one task holds while tiles pass by.
TILE_ROWS, GROUP_ROWS = 2048, 8192
# Dimensions added at a time, and columns of a block.
_STEP, _BLOCK = 16, 512
# Room for rounding in single precision.
_SLACK = 1e-4


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns are the principal axes of the unit vectors, strongest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _units(matrix(batch.column(0), np.float64, width))
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total))], names=["row", "sums"])

    sums = vectors.mapInArrow(run, "row int, sums array<double>").select("row", F.posexplode("sums").alias("at", "value"))
    moments = np.zeros((width, width))
    for row in sums.groupBy("row", "at").agg(F.sum("value").alias("value")).collect():
        moments[row.row, row.at] = row.value
    return np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1].copy()


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small components."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class _Rows:
    """Some class vectors: ids, sizes of the classes, units, turned units and their suffix norms."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray, axes: np.ndarray) -> None:
        self.ids, self.sizes = ids, sizes
        self.units = _units(rows.astype(np.float64))
        turned = self.units @ axes
        squares = np.cumsum(turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.suffix = np.sqrt(np.concatenate([squares, np.zeros((len(ids), 1))], axis=1)).astype(np.float32)
        self.turned = turned.astype(np.float32)


def linked_pairs(a: _Rows, b: _Rows, low: int, high: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i`` in ``a`` and ``j`` in columns ``low..high`` of ``b`` that are linked."""
    width = a.turned.shape[1]
    least = np.float32(threshold - _SLACK)
    at = min(_STEP, width)
    sums = a.turned[:, :at] @ b.turned[low:high, :at].T
    sums += np.outer(a.suffix[:, at], b.suffix[low:high, at])
    rows, columns = np.nonzero(sums >= least)
    found = []
    # Few enough pairs at a time to hold their dimensions.
    for cut in range(0, len(rows), 1 << 15):
        i, j = rows[cut: cut + (1 << 15)], columns[cut: cut + (1 << 15)] + low
        part = np.zeros(len(i), np.float32)
        for start in range(0, width, _STEP):
            end = min(start + _STEP, width)
            part += np.einsum("ij,ij->i", a.turned[i, start:end], b.turned[j, start:end])
            able = part + a.suffix[i, end] * b.suffix[j, end] >= least
            i, j, part = i[able], j[able], part[able]
        exact = np.einsum("ij,ij->i", a.units[i], b.units[j]) >= threshold
        found.append((i[exact], j[exact]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Some of the pairs, without a circle, that join all that the pairs join."""
    kept: list[tuple[int, int]] = []
    label: dict[int, int] = {}

    def root(x: int) -> int:
        while label.setdefault(x, x) != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    while len(left):
        # One pair for each row on either side, then only pairs between different trees.
        first = np.unique(left, return_index=True)[1]
        for k in np.union1d(first, np.unique(right, return_index=True)[1]).tolist():
            x, y = root(int(left[k])), root(int(right[k]))
            if x != y:
                label[x] = y
                kept.append((int(left[k]), int(right[k])))
        values, places = np.unique(np.concatenate([left, right]), return_inverse=True)
        roots = np.array([root(v) for v in values.tolist()])[places]
        apart = roots[: len(left)] != roots[len(left):]
        left, right = left[apart], right[apart]
    return kept


def _compare(group: _Rows, other: _Rows, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows ``a, b, links``: how many links ``a`` has, or with none an edge of the forest."""
    for low in range(0, len(other.ids), _BLOCK):
        high = min(low + _BLOCK, len(other.ids))
        i, j = linked_pairs(group, other, low, high, threshold)
        ids_a, ids_b = group.ids[i], other.ids[j]
        if same:
            keep = ids_a < ids_b
            i, j, ids_a, ids_b = i[keep], j[keep], ids_a[keep], ids_b[keep]
        if not len(i):
            continue
        for ids, own, weights in ((group.ids, i, other.sizes[j]), (other.ids, j, group.sizes[i])):
            places, at = np.unique(own, return_inverse=True)
            yield ids[places], ids[places], np.bincount(at, weights).astype(np.int64)
        edges = forest(ids_a, ids_b)
        if edges:
            a, b = np.array(edges).T
            yield a, b, np.zeros(len(a), np.int64)


def _tiles(classes: DataFrame, axes: np.ndarray, width: int, reach: float) -> DataFrame:
    """Class vectors with their cell, group and tile."""
    shared = classes.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = _units(matrix(batch.column(2), np.float64, width)) @ shared.value
            cells = np.floor(turned[:, :CELL_AXES] / reach).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(list(cells), pa.list_(pa.int32())), pa.array(list(turned[:, :BOX_AXES]))],
                names=["id", "size", "vector", "cell", "lead"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    placed = classes.mapInArrow(
        run, f"id {kinds['id']}, size bigint, vector {kinds['vector']}, cell array<int>, lead array<double>")
    cell = [F.get("cell", F.lit(k)) for k in range(CELL_AXES)]
    lead = F.get("lead", F.lit(CELL_AXES))
    placed = numbered(placed, [*[c.asc_nulls_first() for c in cell], lead.asc_nulls_first(), F.col("id")], "place")
    group = F.struct("cell", F.expr(f"place div {GROUP_ROWS}").alias("n"))
    return settled(placed.withColumn("group", group).withColumn("tile", F.struct("cell", F.expr(f"place div {TILE_ROWS}").alias("n"))))


def _near(groups: DataFrame, tiles: DataFrame, reach: float) -> DataFrame:
    """Pairs of a group and a tile of the same or a later group whose boxes are within reach."""
    axes = range(CELL_AXES)
    around = groups
    for k in axes:
        around = around.withColumn(f"_c{k}", F.explode(F.array(*[F.get("group.cell", F.lit(k)) + F.lit(d) for d in (-1, 0, 1)])))
    keys = [F.coalesce(F.col(f"_c{k}"), F.lit(0)).alias(f"_c{k}") for k in axes]
    left = around.select("group", F.col("low").alias("low_a"), F.col("high").alias("high_a"), *keys).distinct()
    right = tiles.select("tile", F.col("group").alias("group_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                         *[F.coalesce(F.get("tile.cell", F.lit(k)), F.lit(0)).alias(f"_c{k}") for k in axes])
    gap = F.zip_with(
        F.arrays_zip("low_a", "high_a"), F.arrays_zip("low_b", "high_b"),
        lambda x, y: F.greatest(x["low_a"] - y["high_b"], y["low_b"] - x["high_a"], F.lit(0.0)))
    near = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g) <= reach * reach * (1 + 1e-9)
    joined = left.join(right, [f"_c{k}" for k in axes]).where(F.col("group") <= F.col("group_b"))
    return joined.where(near).select("group", "tile", "group_b")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The id column, ``n_links``, ``component_id`` and ``kept`` of each vector.

    Ids are whole numbers of any type and sign; ``component_id`` has their type.
    """
    spark = vectors.sparkSession
    kind = vectors.select(F.col(id_col)).schema[0].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"ids are whole numbers, {id_col} is {kind.simpleString()}")
    named = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    able = finite(F.col("vector")) & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False)) & F.col("id").isNotNull()
    valid = named.where(able).groupBy("id").agg(F.min("vector").alias("vector"))
    classes = settled(valid.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("size")).select("id", "size", "vector"))
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    axes = principal_axes(classes.select("vector"), width)
    reach = float(np.sqrt(max(2 - 2 * (threshold - _SLACK), 0.0)))
    rows = _tiles(classes, axes, width, max(reach, 1e-6))

    def box(key: str) -> DataFrame:
        leads = range(min(BOX_AXES, width))
        kept = [key, "group"] if key == "tile" else [key]
        return rows.groupBy(*kept).agg(
            F.array(*[F.min(F.get("lead", F.lit(k))) for k in leads]).alias("low"),
            F.array(*[F.max(F.get("lead", F.lit(k))) for k in leads]).alias("high"))

    near = settled(_near(box("group"), box("tile"), reach))
    packed = rows.groupBy("tile").agg(F.collect_list(F.struct("id", "size", "vector")).alias("rows"))
    passing = near.join(packed, "tile").select("group", F.lit(1).alias("passing"), (F.col("group") == F.col("group_b")).alias("same"), "rows")
    own = rows.groupBy("group").agg(F.collect_list(F.struct("id", "size", "vector")).alias("rows")).select(
        "group", F.lit(0).alias("passing"), F.lit(False).alias("same"), "rows")
    dealt = own.unionByName(passing).repartition("group").sortWithinPartitions("group", "passing")
    shared = spark.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            for i in range(batch.num_rows):
                cells = batch.column(3).slice(i, 1).flatten()
                other = _Rows(cells.field("id").to_numpy(zero_copy_only=False), cells.field("size").to_numpy(zero_copy_only=False),
                              matrix(cells.field("vector"), np.float64, width), shared.value)
                if not batch.column(1)[i].as_py():
                    group = other
                    continue
                for a, b, links in _compare(group, other, batch.column(2)[i].as_py(), threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(links)], names=["a", "b", "links"])

    found = settled(dealt.mapInArrow(run, "a bigint, b bigint, links bigint"))
    links = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    joined = components(found.where("links = 0").select("a", "b")).select(F.col("node").alias("rep"), "component")
    known = (classes.join(links, F.col("id") == F.col("rep"), "left").drop("rep")
             .join(joined, F.col("id") == F.col("rep"), "left")
             .select("vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")))
    members = valid.join(known, "vector").select(F.col("id").alias("_id"), "n_links", "component_id")
    return (named.select("id").join(members, F.col("id") == F.col("_id"), "left")
            .select(F.col("id").cast(kind).alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").cast(kind).alias("component_id"),
                    F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept")))
