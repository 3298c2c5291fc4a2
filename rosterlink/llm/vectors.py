"""Arrays of numbers as NumPy matrices, and the vectors that count as valid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    return F.coalesce(vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def matrix(column: pa.Array, kind: type, width: int | None = None) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros on the right."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), kind)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = values
    return out
