"""State of fixed size that tasks gather from the whole input and that is then merged slice by slice."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 17
# Tasks whose slices meet in one task at most.
FAN_IN = 64
SCHEMA = "task bigint, slice bigint, state binary"

_NAMES = ["task", "slice", "state"]


def slices(task: int, state: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the parts of ``state`` (bytes) that are not all zero."""
    for at in range(0, len(state), SLICE_BYTES):
        part = state[at: at + SLICE_BYTES]
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([task]), pa.array([at // SLICE_BYTES]), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                names=_NAMES)


def merged(parts: DataFrame, tasks: int, combine: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """One row per slice. ``combine`` must not depend on order; each task holds the slices it merges only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for task, place, state in zip(*(c.to_pylist() for c in batch.columns)):
                new = np.frombuffer(zlib.decompress(state), np.uint8)
                key = (task // FAN_IN, place)
                held[key] = combine(held[key], new) if key in held else new
        for (task, place), state in held.items():
            yield from pa.Table.from_arrays(
                [pa.array([task]), pa.array([place]), pa.array([zlib.compress(state.tobytes(), 1)], pa.binary())],
                names=_NAMES).to_batches()

    while True:
        parts = parts.selectExpr("*", f"task div {FAN_IN} AS _group").repartition("_group", "slice")
        parts = parts.drop("_group").mapInArrow(run, SCHEMA)
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            return parts


def collected(parts: DataFrame, size: int) -> np.ndarray:
    """The whole state of ``size`` bytes on the driver, slice by slice."""
    state = np.zeros(size, np.uint8)
    for row in parts.select("slice", "state").toLocalIterator():
        part = np.frombuffer(zlib.decompress(row.state), np.uint8)
        state[row.slice * SLICE_BYTES: row.slice * SLICE_BYTES + len(part)] = part
    return state
