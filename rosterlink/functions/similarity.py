"""Name similarity scores, 0 to 100, as Columns.

The scores run as Arrow pandas UDFs; each batch is scored with NumPy over all
pairs at once.  The building block is the length of the longest common
subsequence (LCS), found with the bit-parallel recurrence of Hyyrö (2004); for
the partial ratios, with all windows of a pair at once, by semi-local combing
(Tiskin 2008).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .text import as_column

# How the combined score weighs its parts.
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
FAR_PARTIAL_WEIGHT = 0.6
PARTIAL_FROM = 1.5
FAR_FROM = 8.0

_WORD = 64


# --- longest common subsequence -------------------------------------------------


def _codes(texts: Sequence[str], width: int, filler: int) -> np.ndarray:
    out = np.full((len(texts), width), filler, dtype=np.uint32)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out[np.arange(width) < lengths[:, None]] = joined
    return out


def _lcs_one(pattern: str, text: str) -> int:
    """LCS of one pair of any length, on Python integers."""
    where: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    row = full
    for ch in text:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(pattern) - row.bit_count()


def lcs(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """LCS length of each pair."""
    out = np.zeros(len(left), dtype=np.int64)
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left, right)]
    short = [i for i, (a, _) in enumerate(pairs) if 0 < len(a) <= _WORD]
    for i, (a, b) in enumerate(pairs):
        if len(a) > _WORD:
            out[i] = _lcs_one(a, b)
    # Similar lengths together, so that little padding is scanned.
    short.sort(key=lambda i: len(pairs[i][1]))
    for start in range(0, len(short), 4096):
        rows = short[start : start + 4096]
        patterns = [pairs[i][0] for i in rows]
        texts = [pairs[i][1] for i in rows]
        out[rows] = _lcs_words(patterns, texts)
    return out


def _lcs_words(patterns: list[str], texts: list[str]) -> np.ndarray:
    width = -(-max(map(len, patterns)) // 8) * 8
    a = _codes(patterns, width, 0xFFFFFFFF)
    b = _codes(texts, max(map(len, texts)), 0xFFFFFFFE)
    row = np.full(len(patterns), np.iinfo(np.uint64).max, dtype=np.uint64)
    packed = np.zeros((len(patterns), _WORD // 8), dtype=np.uint8)
    for j in range(b.shape[1]):
        packed[:, : width // 8] = np.packbits(a == b[:, j, None], axis=1, bitorder="little")
        mask = packed.view(np.uint64)[:, 0]
        row = (row + (row & mask)) | (row & ~mask)
    return _WORD - np.bitwise_count(row).astype(np.int64)


def _combed(needles: np.ndarray, hays: np.ndarray) -> np.ndarray:
    """Where the strand that leaves each hay column at the bottom has come in, for padded rows of codes.

    Strands run through the grid of needle and hay characters; two that meet
    cross where the characters are equal or they have crossed before. Then the
    LCS of the needle and ``hay[i:j]`` is ``j - i`` less the strands that leave
    before ``j`` and came in from above at ``i`` or later. Cells of one
    anti-diagonal do not depend on each other.
    """
    n, m = needles.shape[1], hays.shape[1]
    backwards = needles[:, ::-1]
    across = np.repeat(np.arange(n, dtype=np.int32)[None], len(needles), 0)
    down = np.repeat(np.arange(n, n + m, dtype=np.int32)[None], len(needles), 0)
    for d in range(n + m - 1):
        first, last = min(d, n - 1), max(0, d - m + 1)
        rows, columns = slice(n - 1 - first, n - last), slice(d - first, d - last + 1)
        h, v = across[:, rows], down[:, columns]
        turn = (backwards[:, rows] == hays[:, columns]) | (h > v)
        across[:, rows], down[:, columns] = np.where(turn, v, h), np.where(turn, h, v)
    return down - n


# Cells of text, or pairs of columns, held at once.
_CELLS = 1 << 22


def _best_windows(needles: Sequence[str], hays: Sequence[str]) -> np.ndarray:
    """Best ratio of each needle to a window of its hay that is as long, or shorter at either end."""
    out = np.zeros(len(needles))
    order = sorted(range(len(needles)), key=lambda i: (len(hays[i]), len(needles[i])))
    start = 0
    while start < len(order):
        # Similar lengths together, so that little padding is combed.
        most = max(1, _CELLS // len(hays[order[start]]) ** 2)
        rows = order[start: start + min(most, 4096)]
        start += len(rows)
        n, m = _lengths([needles[i] for i in rows]), _lengths([hays[i] for i in rows])
        entered = _combed(_codes([needles[i] for i in rows], int(n.max()), 0xFFFFFFFF),
                          _codes([hays[i] for i in rows], int(m.max()), 0xFFFFFFFE))
        best = np.zeros(len(rows))
        for end in range(1, int(m.max()) + 1):
            begin = np.maximum(end - n, 0)
            common = end - begin - (entered[:, :end] >= begin[:, None]).sum(1)
            best = np.maximum(best, np.where(end <= m, _similarity(common, n, end - begin), 0.0))
        for size in range(1, int(n.max())):
            begin = np.maximum(m - size, 0)
            inside = np.arange(entered.shape[1]) < m[:, None]
            common = size - ((entered >= begin[:, None]) & inside).sum(1)
            best = np.maximum(best, np.where(size < n, _similarity(common, n, np.full(len(rows), size)), 0.0))
        out[rows] = best
    return out


def _lengths(texts: Sequence[str]) -> np.ndarray:
    return np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))


def _similarity(common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    total = left + right
    distance = total - 2 * common
    return np.where(total > 0, (1.0 - distance / np.maximum(total, 1)) * 100.0, 100.0)


# --- scores on lists of pairs ----------------------------------------------------


def ratio_scores(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """``100 * (1 - indel distance / total length)``."""
    return _similarity(lcs(left, right), _lengths(left), _lengths(right))


def token_sort_scores(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """``ratio`` of the texts with their tokens sorted."""
    return ratio_scores([" ".join(sorted(a.split())) for a in left], [" ".join(sorted(b.split())) for b in right])


def token_set_scores(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Best ratio among shared tokens, and shared tokens plus each side's own."""
    out = np.zeros(len(left))
    rows, only_left, only_right, shared_length = [], [], [], []
    for i, (a, b) in enumerate(zip(left, right)):
        ta, tb = set(a.split()), set(b.split())
        if not ta or not tb:
            continue
        shared = ta & tb
        if shared and (ta <= tb or tb <= ta):
            out[i] = 100.0
            continue
        rows.append(i)
        only_left.append(" ".join(sorted(ta - tb)))
        only_right.append(" ".join(sorted(tb - ta)))
        shared_length.append(len(" ".join(shared)))
    if not rows:
        return out
    la, lb, ls = _lengths(only_left), _lengths(only_right), np.array(shared_length)
    joint = (ls > 0).astype(np.int64)
    with_left, with_right = ls + joint + la, ls + joint + lb
    distance = la + lb - 2 * lcs(only_left, only_right)
    best = 100.0 - 100.0 * distance / (with_left + with_right)
    for own, whole in ((la, with_left), (lb, with_right)):
        alone = 100.0 - 100.0 * (joint + own) / (ls + whole)
        best = np.where(ls > 0, np.maximum(best, alone), best)
    out[rows] = best
    return out


def token_scores(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """The better of token sort and token set."""
    return np.maximum(token_sort_scores(left, right), token_set_scores(left, right))


def partial_scores(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Best ratio of the shorter text against any window of the longer one.

    A window is at most as long as the shorter text; windows cut off by either
    end of the longer text count too.
    """
    out = np.zeros(len(left))
    needles: list[str] = []
    hays: list[str] = []
    owners: list[int] = []
    for i, (a, b) in enumerate(zip(left, right)):
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        if not short:
            out[i] = 0.0 if long else 100.0
        elif short in long:
            out[i] = 100.0
        else:
            for needle, hay in ((short, long),) if len(a) != len(b) else ((a, b), (b, a)):
                needles.append(needle)
                hays.append(hay)
                owners.append(i)
    if owners:
        np.maximum.at(out, owners, _best_windows(needles, hays))
    return out


def partial_token_scores(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """100 with a shared token, else the partial ratio of the sorted tokens."""
    out = np.zeros(len(left))
    owners, lefts, rights = [], [], []
    for i, (a, b) in enumerate(zip(left, right)):
        ta, tb = a.split(), b.split()
        sa, sb = set(ta), set(tb)
        if sa & sb:
            out[i] = 100.0
            continue
        forms = {(" ".join(sorted(ta)), " ".join(sorted(tb))), (" ".join(sorted(sa)), " ".join(sorted(sb)))}
        for one, two in forms:
            owners.append(i)
            lefts.append(one)
            rights.append(two)
    if owners:
        np.maximum.at(out, owners, partial_scores(lefts, rights))
    return out


def weighted_scores(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Combined score: plain, token and partial ratios, weighted by length ratio."""
    la, lb = _lengths(left), _lengths(right)
    filled = (la > 0) & (lb > 0)
    spread = np.maximum(la, lb) / np.maximum(np.minimum(la, lb), 1)
    out = np.where(filled, ratio_scores(left, right), 0.0)

    def improve(rows: np.ndarray, score: Callable, weight: np.ndarray | float) -> None:
        if rows.any():
            picked = np.flatnonzero(rows)
            scores = score([left[i] for i in picked], [right[i] for i in picked])
            weights = weight[picked] if isinstance(weight, np.ndarray) else weight
            out[picked] = np.maximum(out[picked], scores * weights)

    improve(filled & (spread < PARTIAL_FROM), token_scores, TOKEN_WEIGHT)
    partial = np.where(spread <= FAR_FROM, PARTIAL_WEIGHT, FAR_PARTIAL_WEIGHT)
    improve(filled & (spread >= PARTIAL_FROM), partial_scores, partial)
    improve(filled & (spread >= PARTIAL_FROM), partial_token_scores, TOKEN_WEIGHT * partial)
    return out


# --- Columns -----------------------------------------------------------------------


def _score_column(scores: Callable[[Sequence[str], Sequence[str]], np.ndarray], doc: str) -> Callable:
    def over_batch(left: pd.Series, right: pd.Series) -> pd.Series:
        known = (left.notna() & right.notna()).to_numpy()
        out = np.zeros(len(left))
        if known.any():
            out[known] = scores(left[known].tolist(), right[known].tolist())
        return pd.Series(out)

    def column(left: Column | str, right: Column | str) -> Column:
        return F.pandas_udf(over_batch, DoubleType())(as_column(left), as_column(right))

    column.__doc__ = doc
    return column


ratio = _score_column(ratio_scores, "Plain indel similarity; null counts as no similarity.")
token_sort_ratio = _score_column(token_sort_scores, "Indel similarity of the sorted tokens.")
token_set_ratio = _score_column(token_set_scores, "Indel similarity of the token sets.")
token_ratio = _score_column(token_scores, "The better of token_sort_ratio and token_set_ratio.")
partial_ratio = _score_column(partial_scores, "Best similarity of the shorter text with a window of the longer.")
partial_token_ratio = _score_column(partial_token_scores, "Partial ratio over tokens.")
weighted_ratio = _score_column(weighted_scores, "The combined score used to match names.")
