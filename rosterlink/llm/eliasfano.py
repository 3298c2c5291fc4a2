"""Elias-Fano coded monotone sequences in parts, with vectorised access and search.

A part of ``n`` values keeps the low ``width`` bits of each value packed, and
the high bits in unary: a one for each value, a zero at each end of a bucket.
The place of every eighth zero and of every eighth one is kept as well. All
parts of a sequence lie one after another in the same arrays, so a query takes
any mix of parts at once and the arrays can be memory-mapped.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ONE, _SIX = _U(1), _U(6)
# Other bits between two kept places beyond which these are not walked over.
_RUN = 64
#: Arrays of a part, in this order, with their types.
ARRAYS = {"low": np.uint64, "high": np.uint64, "zeros": np.uint32, "ones": np.uint32}


def encode(values: np.ndarray) -> tuple[int, dict[str, np.ndarray]]:
    """Width and arrays of a part of ascending values."""
    values = values.astype(np.uint64)
    count, top = len(values), int(values[-1]) if len(values) else 0
    width = max(0, (top // max(count, 1)).bit_length() - 1)
    high = (values >> _U(width)).astype(np.int64)
    buckets = int(high[-1]) + 1 if count else 1
    bits = np.zeros((count + buckets + 63) // 64 * 64 + 192, bool)
    bits[high + np.arange(count)] = True
    # Behind the last bucket there are zeros only.
    low = np.zeros((count * width + 63) // 64 + 2, np.uint64)
    if width:
        kept = values & _U((1 << width) - 1)
        at = np.arange(count, dtype=np.uint64) * _U(width)
        word, shift = (at >> _SIX).astype(np.int64), at & _U(63)
        np.bitwise_or.at(low, word, kept << shift)
        over = np.flatnonzero(shift + _U(width) > _U(64))
        np.bitwise_or.at(low, word[over] + 1, kept[over] >> (_U(64) - shift[over]))
    return width, {
        "low": low,
        "high": np.packbits(bits, bitorder="little").view(np.uint64),
        "zeros": np.searchsorted(high, np.arange(0, buckets + 8, 8), "right").astype(np.uint32),
        "ones": high[::8].astype(np.uint32) if count else np.zeros(1, np.uint32),
    }


def _lowest(words: np.ndarray) -> np.ndarray:
    """Place of the lowest one of each word, 64 if none."""
    return np.bitwise_count((words & (~words + _ONE)) - _ONE).astype(np.int64)


class EliasFano:
    """All parts of a sequence; ``starts`` are the offsets of the parts' values."""

    def __init__(self, arrays: dict[str, np.ndarray], widths: np.ndarray, offsets: dict[str, np.ndarray], starts: np.ndarray) -> None:
        self.arrays, self.widths, self.offsets, self.starts = arrays, widths.astype(np.uint64), offsets, starts

    def _window(self, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        """64 bits of the unary array from ``at`` on."""
        high = self.arrays["high"]
        word, shift = self.offsets["high"][part] + (at >> 6), (at & 63).astype(np.uint64)
        return high[word] >> shift | (high[word + 1] << (_U(63) - shift)) << _ONE

    def _select(self, part: np.ndarray, place: np.ndarray, of_ones: bool) -> np.ndarray:
        """Position in the unary array of the ``place``-th one or zero."""
        name = "ones" if of_ones else "zeros"
        block = place >> 3
        at = self.arrays[name][self.offsets[name][part] + block].astype(np.int64) + (block << 3)
        left = place & 7
        self._nearer(part, place, at, left, *(("ones", "zeros") if of_ones else ("zeros", "ones")))
        todo = np.flatnonzero(left)
        at[todo] += 1
        while len(todo):
            words = self._window(part[todo], at[todo])
            words = words if of_ones else ~words
            here = np.bitwise_count(words).astype(np.int64)
            inside = here >= left[todo]
            rest = todo[~inside]
            left[rest] -= here[~inside]
            at[rest] += 64
            found, words = todo[inside], words[inside]
            more = left[found] - 1
            while True:
                drop = np.flatnonzero(more > 0)
                if not len(drop):
                    break
                words[drop] &= words[drop] - _ONE
                more[drop] -= 1
            at[found] += _lowest(words)
            todo = rest
        return at

    def _nearer(self, part: np.ndarray, place: np.ndarray, at: np.ndarray, left: np.ndarray, own: str, other: str) -> None:
        """Where a long run of the other bits lies between two kept places, start at the last kept one of these before the goal."""
        kept, others = self.arrays[own], self.arrays[other]
        block = self.offsets[own][part] + (place >> 3)
        known = block + 1 < self.offsets[own][part + 1]
        far = np.flatnonzero(known & (left > 0))
        far = far[kept[block[far] + 1] - kept[block[far]] > _RUN]
        if not len(far):
            return
        base, goal = self.offsets[other][part[far]], place[far]
        lower = kept[block[far]].astype(np.int64) >> 3
        start = lower.copy()
        upper = np.minimum((kept[block[far] + 1].astype(np.int64) >> 3) + 1, self.offsets[other][part[far] + 1] - base)
        todo = np.flatnonzero(lower < upper)
        while len(todo):
            middle = (lower[todo] + upper[todo]) >> 1
            before = others[base[todo] + middle] <= goal[todo]
            lower[todo[before]] = middle[before] + 1
            upper[todo[~before]] = middle[~before]
            todo = todo[lower[todo] < upper[todo]]
        found = np.flatnonzero(lower > start)
        last, rows = lower[found] - 1, far[found]
        passed = others[base[found] + last].astype(np.int64)
        position = passed + (last << 3)
        later = position > at[rows]
        at[rows[later]] = position[later]
        left[rows[later]] = goal[found[later]] - passed[later] + 1

    def _low(self, part: np.ndarray, place: np.ndarray) -> np.ndarray:
        width = self.widths[part]
        at = place.astype(np.uint64) * width
        word, shift = self.offsets["low"][part] + (at >> _SIX).astype(np.int64), at & _U(63)
        low = self.arrays["low"]
        both = low[word] >> shift | (low[word + 1] << (_U(63) - shift)) << _ONE
        return both & ((_ONE << width) - _ONE)

    def get(self, part: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Value at a place of a part."""
        high = (self._select(part, place, True) - place).astype(np.uint64)
        return high << self.widths[part] | self._low(part, place)

    def neighbours(self, part: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at a place of a part and at the next one."""
        at = self._select(part, place, True)
        step = _lowest(self._window(part, at + 1))
        following = at + 1 + step
        far = np.flatnonzero(step == 64)
        following[far] = self._select(part[far], place[far] + 1, True)
        width = self.widths[part]
        return ((at - place).astype(np.uint64) << width | self._low(part, place),
                (following - place - 1).astype(np.uint64) << width | self._low(part, place + 1))

    def find(self, part: np.ndarray, value: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of ``value`` in ``[first, end)`` of a part, -1 if it is not there."""
        out = np.full(len(value), -1, np.int64)
        high = (value >> self.widths[part]).astype(np.int64)
        buckets = (np.diff(self.offsets["zeros"])[part] - 1) * 8
        todo = np.flatnonzero((first < end) & (high < buckets))
        low = value & ((_ONE << self.widths[part]) - _ONE)
        begin = np.zeros(len(value), np.int64)
        later = todo[high[todo] > 0]
        begin[later] = self._select(part[later], high[later] - 1, False) + 1
        # A one is a value of the bucket, a zero its end; a bucket of 64 values or more ends at a zero to be found.
        stop = begin.copy()
        run = _lowest(~self._window(part[todo], begin[todo]))
        stop[todo] += run
        far = todo[run == 64]
        stop[far] = self._select(part[far], high[far], False)
        lower, upper = np.maximum(begin - high, first), np.minimum(stop - high, end)
        todo = todo[lower[todo] < upper[todo]]
        # Values of one bucket ascend in their low bits, so it is halved.
        while len(todo):
            middle = (lower[todo] + upper[todo]) >> 1
            seen, wanted = self._low(part[todo], middle), low[todo]
            same, less = seen == wanted, seen < wanted
            out[todo[same]] = middle[same]
            lower[todo[less]] = middle[less] + 1
            upper[todo[~less]] = middle[~less]
            todo = todo[~same]
            todo = todo[lower[todo] < upper[todo]]
        return out
