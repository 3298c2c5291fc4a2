"""Words and code points of whole Arrow text columns as NumPy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; A-Z count as
a-z. Words are known by a 64-bit hash: a polynomial over random byte values,
mixed. Two given words collide with a chance of about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text hashed at once; a longer word or code-point run makes a larger block.
BLOCK_BYTES = 1 << 20
# Bytes of text that one chunk of rows holds at most, unless a single row is longer.
CHUNK_BYTES = 1 << 21

_BASE = 0x9E3779B97F4A7C15 | 3  # odd, so that it has an inverse modulo 2^64
_U = np.uint64


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> _U(30)
    values *= _U(0xBF58476D1CE4E5B9)
    values ^= values >> _U(27)
    values *= _U(0x94D049BB133111EB)
    values ^= values >> _U(31)
    return values


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up, self.down


_POWERS = _Powers()
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_VALUES = _BYTE_VALUES[_LOWER]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LETTER_VALUES = mix(np.arange(1000, 1000 + 65536, dtype=np.uint64))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each ``values[start:end]``; equal spans have equal hashes wherever they stand."""
    up, down = _POWERS.upto(len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together, or one longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def _word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = word
    here = np.append(word, False)
    return np.flatnonzero(here & (edge | ~before)), np.flatnonzero(before & (edge | ~here))


# A sign for each kind of byte: lower case and beyond ASCII, upper case, digit, else the byte.
_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[97:123] = _SHAPES[128:] = 97
_SHAPES[65:91] = 65
_SHAPES[48:58] = 48


def _shape_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    kinds = _SHAPES[data]
    kept = np.ones(len(data), bool)
    kept[1:] = kinds[1:] != kinds[:-1]
    kept[starts] = True
    before = np.concatenate([[0], np.cumsum(kept)])
    return span_hashes(_BYTE_VALUES[kinds[kept]], before[starts], before[ends])


def word_hashes(data: np.ndarray, offsets: np.ndarray, shapes: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row, in order, and the offsets of the rows in them.

    With ``shapes``, of the words' shapes instead: a run of bytes of one kind
    counts as one sign, so ``Word,`` is ``Aa,``.
    """
    starts, ends = _word_spans(data, offsets)
    hashes = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        upto = max(int(np.searchsorted(ends, starts[done] + BLOCK_BYTES, "right")), done + 1)
        low, high = starts[done], ends[upto - 1]
        own = data[low:high], starts[done:upto] - low, ends[done:upto] - low
        hashes[done:upto] = _shape_hashes(*own) if shapes else span_hashes(_LOWER_VALUES[own[0]], *own[1:])
        done = upto
    return hashes, np.searchsorted(starts, offsets)


def sequence_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbours (``len - size + 1`` of them)."""
    count = max(len(hashes) - size + 1, 0)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = mix(out * _U(_BASE) + hashes[k: k + count])
    return out


def code_values(codes: np.ndarray) -> np.ndarray:
    """The hash value of each code point."""
    values = _LETTER_VALUES[np.minimum(codes, 65535)]
    far = codes > 65535
    if far.any():
        values[far] = mix(codes[far].astype(np.uint64) + _U(1000))
    return values


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all ``range(start, start + length)``, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
