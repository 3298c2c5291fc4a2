"""Spelling variants of words by pivotal grams (Deng, Li, Feng 2014).

All bigrams of all words are ordered by how many words hold them, rarest
first. The *prefix* of a word is its three rarest bigrams, together with
further places of the last of them; its *pivots* are the two disjoint ones of
the three that are rarest together, chosen by dynamic programming. One edit
spoils one pivot at most, so of two words one edit apart the one whose prefix
ends earlier in the order has a pivot that stands in the other's prefix.

Pivots are indexed, prefixes look them up. The *position limit* of one edit is
that everything on one side of the pivot is untouched: the bigram has the same
place counted from the start, or the same counted from the end, with equal
letters up to there. The letters on the other side are one edit apart; as that
is so exactly when they are equal but for one letter left out of one or both,
every choice of that letter is a key of its own. So hot bigrams, and words that
all begin alike, make no large groups: at most one word for each letter of the
alphabet meets in a key. Keys are hashes; pairs that meet are verified on the
words themselves.

Odd rows: a null, empty or letterless text has no words; a null ``doc_id``
counts as empty text; repeated rows count as often as they stand there. No
words give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import settled
from .words import chunks, mix, ragged, span_hashes, text_buffers

#: Kinds of bigrams that are told apart when ordered: a table of fixed size.
GRAM_KINDS = 1 << 16
#: Bytes of text counted at once, unless one text is longer.
CHUNK_BYTES = 8 << 20

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII = np.zeros(256, bool)
_ASCII[97:123] = True
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
# The lead byte of U+00C0 to U+00FF, which are two bytes long.
_LEAD = 0xC3


# --- words of texts -------------------------------------------------------------------

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)
# Runs longer than this get their checksum one by one.
_SHORT = 64


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> np.ndarray:
    """crc32 of each span, carried on from ``states`` (the crc32 of what stands before)."""
    out = states.copy()
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] <= _SHORT]
    for i in np.flatnonzero(lengths > _SHORT):
        out[i] = zlib.crc32(data[starts[i]: ends[i]].tobytes(), int(states[i]))
    if len(order):
        state, at, size = ~out[order], starts[order], lengths[order]
        for step in range(int(size[0])):
            live = int(np.searchsorted(-size, -step, "left"))
            state[:live] = _CRC[(state[:live] ^ data[at[:live] + step]) & 255] ^ (state[:live] >> np.uint32(8))
        out[order] = ~state
    return out


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest runs of letters, within rows."""
    letter = _ASCII[data] | (data == _LEAD)
    letter[1:] |= data[:-1] == _LEAD
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, here = np.concatenate([[False], letter]), np.append(letter, False)
    return np.flatnonzero(here & (edge | ~before)), np.flatnonzero(before & (edge | ~here))


def _counter(shortest: int, spoil: int | None):
    def counts(data: np.ndarray, offsets: np.ndarray, ids: list[str]) -> pa.RecordBatch:
        data = _LOWER[data]
        starts, ends = _runs(data, offsets)
        leads = np.concatenate([[0], np.cumsum(data == _LEAD)])
        size = ends - starts - (leads[ends] - leads[starts])
        fits = size >= shortest
        starts, ends, size = starts[fits], ends[fits], size[fits]
        spoiled: Counter[str] = Counter()
        if spoil is not None:
            states = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
            rows = np.searchsorted(offsets, starts, "right") - 1
            sums = _checksums(data, starts, ends, states[rows])
            hit = sums % spoil == 0
            for start, end, check, length in zip(starts[hit], ends[hit], sums[hit], size[hit]):
                word, gone = data[start:end].tobytes().decode(), int(check) % int(length)
                if length > shortest:
                    spoiled[word[:gone] + word[gone + 1:]] += 1
            starts, ends = starts[~hit], ends[~hit]
        hashes, done = np.empty(len(starts), np.uint64), 0
        while done < len(starts):
            upto = max(int(np.searchsorted(ends, starts[done] + (1 << 20), "right")), done + 1)
            low, high = starts[done], ends[upto - 1]
            hashes[done:upto] = span_hashes(_VALUES[data[low:high]], starts[done:upto] - low, ends[done:upto] - low)
            done = upto
        _, at, times = np.unique(hashes, return_index=True, return_counts=True)
        lengths = ends[at] - starts[at]
        places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        text = data[ragged(starts[at], lengths)]
        plain = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(places.tobytes()), pa.py_buffer(text.tobytes())).cast(pa.string())
        words = pa.concat_arrays([plain, pa.array(list(spoiled), pa.string())])
        n = np.concatenate([times, np.fromiter(spoiled.values(), np.int64, len(spoiled))])
        return pa.RecordBatch.from_arrays([words, pa.array(n.astype(np.int64))], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            ids = batch.column(0).to_pylist()
            for low, high in chunks(offsets, CHUNK_BYTES):
                own = offsets[low: high + 1]
                yield counts(data[own[0]: own[-1]], own - own[0], ids[low:high])

    return run


def word_counts(docs: DataFrame, shortest: int = 7, least: int = 2, spoil: int | None = None) -> DataFrame:
    """``word, n``: runs of A-Z, a-z and U+00C0 to U+00FF with A-Z as a-z, their length and count bounded below.

    With ``spoil`` d, a run loses one letter where d divides the crc32 h of
    ``doc_id:run``: the one at h modulo its length. That plants misspellings
    that depend on the data alone.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    found = texts.mapInArrow(_counter(shortest, spoil), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- pivots and prefixes --------------------------------------------------------------


class _Words:
    """The letters of a batch of words, their bigrams in order, and hashes of any part."""

    def __init__(self, column: pa.Array, ranks: np.ndarray):
        joined = "".join(column.to_pylist())
        self.letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        self.grams = np.zeros(len(self.letters), np.int64)
        self.grams[:-1] = self.letters[:-1] << 21 | self.letters[1:]
        self.order = ranks[kind(self.grams)] << 42 | self.grams
        values = mix((self.letters + 1000).astype(np.uint64))
        self.up = np.ones(len(values) + 1, np.uint64)
        self.up[1:] = _ODD
        self.down = np.full(len(values) + 1, _INVERSE, np.uint64)
        self.down[0] = 1
        self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[:-1], dtype=np.uint64)])

    def part(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self.sums[high] - self.sums[low]) * self.down[low])

    def without(self, low: np.ndarray, high: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """Hash of the part ``low:high`` but for the letter at ``gone``."""
        rest = (self.sums[gone] - self.sums[low]) + (self.sums[high] - self.sums[gone + 1]) * _INVERSE
        return mix(rest * self.down[low])


_ODD = _U(0x9E3779B97F4A7C15)
_MORE = _U(0xBF58476D1CE4E5B9)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def kind(grams: np.ndarray) -> np.ndarray:
    return (mix(grams.astype(np.uint64)) & _U(GRAM_KINDS - 1)).astype(np.int64)


def _kind_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranks, totals = np.zeros(GRAM_KINDS, np.int64), np.zeros(GRAM_KINDS, np.int64)
    for batch in batches:
        if batch.num_rows:
            own = _Words(batch.column(0), ranks)
            inside = np.ones(len(own.letters), bool)
            inside[own.end - 1] = False
            totals += np.bincount(kind(own.grams[inside]), minlength=GRAM_KINDS)
    held = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(totals[held])], names=["kind", "n"])


def gram_ranks(words: DataFrame) -> np.ndarray:
    """The place of each kind of bigram in the order, rarest first; a table of ``GRAM_KINDS`` entries."""
    counted = words.select("word").mapInArrow(_kind_counts, "kind bigint, n bigint").groupBy("kind").agg(F.sum("n").alias("n"))
    totals = np.zeros(GRAM_KINDS, np.int64)
    for row in counted.collect():
        totals[row.kind] = row.n
    ranks = np.empty(GRAM_KINDS, np.int64)
    ranks[np.argsort(totals, kind="stable")] = np.arange(GRAM_KINDS)
    return ranks


#: Bigrams in a prefix: one edit spoils two that overlap, and a third is left.
PREFIX = 3
#: Places of one bigram that a prefix holds. A pivot is one of the first three in its word, and one edit
#: can make two more before it.
PLACES = 5


def _chosen(own: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of pivots and their words, places of prefixes and theirs, and the order of each word's last prefix gram."""
    sizes = own.end - own.start - 1
    place = ragged(own.start, sizes)
    word = np.repeat(np.arange(len(sizes)), sizes)
    by = np.lexsort((place, own.order[place], word))
    place, word = place[by], word[by]
    first = np.cumsum(sizes) - sizes
    last = own.order[place[first + PREFIX - 1]]
    # Dynamic programming over the three in the order they stand in the word: the least sum of two that do not overlap.
    three = np.sort(np.stack([place[first + k] for k in range(PREFIX)], 1), 1)
    cost = (own.order[three] >> 42) + 1
    one, two = np.full(len(sizes), -1), np.full(len(sizes), -1)
    least = np.full(len(sizes), np.iinfo(np.int64).max)
    for j in range(1, PREFIX):
        before = np.full(len(sizes), np.iinfo(np.int64).max // 2)
        arg = np.zeros(len(sizes), np.int64)
        for i in range(j):
            better = (three[:, j] - three[:, i] >= 2) & (cost[:, i] < before)
            before, arg = np.where(better, cost[:, i], before), np.where(better, i, arg)
        better = before + cost[:, j] < least
        least = np.where(better, before + cost[:, j], least)
        one = np.where(better, three[np.arange(len(sizes)), arg], one)
        two = np.where(better, three[:, j], two)
    pivots = np.concatenate([one, two])
    # Prefix: all up to the last gram, of each gram the first places.
    kept = own.order[place] <= last[word]
    place, word = place[kept], word[kept]
    same = np.zeros(len(place), bool)
    same[1:] = (word[1:] == word[:-1]) & (own.order[place[1:]] == own.order[place[:-1]])
    begins = np.flatnonzero(~same)
    nth = np.arange(len(place)) - begins[np.cumsum(~same) - 1]
    return pivots, np.tile(np.arange(len(sizes)), 2), place[nth < PLACES], word[nth < PLACES], last


def _keys(own: _Words, place: np.ndarray, word: np.ndarray, pivots: bool) -> tuple[np.ndarray, np.ndarray]:
    """Key and word of every way in which one side of a bigram is untouched and the other is one letter apart.

    A replaced letter is left out at the same place on both sides of the join;
    an inserted one is left out of the word that has it, and the other stands
    whole. Within a run of one letter it does not matter which one goes.
    """
    first = np.ones(len(own.letters), bool)
    first[1:] = own.letters[1:] != own.letters[:-1]
    out = []
    for side in (0, 1):
        if side == 0:
            fixed_low, fixed_high, low, high = own.start[word], place + 2, place + 2, own.end[word]
        else:
            fixed_low, fixed_high, low, high = place, own.end[word], own.start[word], place
        fixed = mix(own.part(fixed_low, fixed_high) + (fixed_high - fixed_low).astype(np.uint64) * _U(2) + _U(side)) * _ODD
        at = np.repeat(np.arange(len(place)), high - low)
        gone = ragged(low, high - low)
        rest = fixed[at] + own.without(low[at], high[at], gone)
        # Counted from the untouched side, so that equal places have equal numbers.
        number = (gone - low[at] if side == 0 else high[at] - gone).astype(np.uint64)
        once = first[gone] | (gone == low[at])
        whole = fixed + own.part(low, high)  # as ``without`` hashes what is left
        shorter, longer = (_U(1), _U(2)) if pivots else (_U(2), _U(1))
        for key, of in ((mix(rest + (number + _U(3)) * _MORE), at), (mix(rest[once] + longer * _MORE), at[once]),
                        (mix(whole + shorter * _MORE), np.arange(len(place)))):
            out.append((key.view(np.int64), word[of]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _emitter(ranks: np.ndarray, pivots: bool):
    # Words at once; a long word has as many keys as letters.
    most_letters = 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            letters = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            for low, high in chunks(np.concatenate([[0], letters]), most_letters):
                own = _Words(batch.column(1)[low:high], ranks)
                ids = batch.column(0)[low:high].to_numpy()
                pivot, pivot_word, place, word, last = _chosen(own)
                key, at = _keys(own, pivot, pivot_word, True) if pivots else _keys(own, place, word, False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids[at]), pa.array((last[at] >> 42).astype(np.int32))], names=["key", "id", "last"])

    return run


_KEYS = "key bigint, id bigint, last int"


def near_words(words: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of ids (each pair once) of distinct words that one inserted, deleted or replaced letter turns into each other.

    ``words`` have ``id`` (unique), ``word`` (distinct) and ``n``; all three
    come along for either side. Words with fewer than ``PREFIX`` bigrams, or
    null, take no part.
    """
    ranks = gram_ranks(words)
    known = words.select("id", "word").where(F.char_length("word") > PREFIX)
    index = known.mapInArrow(_emitter(ranks, True), _KEYS)
    probes = known.mapInArrow(_emitter(ranks, False), _KEYS).toDF("key", "other", "other_last")
    met = index.join(probes, "key").where((F.col("id") != F.col("other")) & (F.col("last") <= F.col("other_last")))
    pairs = met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    for side in ("a", "b"):
        named = words.select(F.col("id").alias(side), F.col("word").alias(f"word_{side}"), F.col("n").alias(f"n_{side}"))
        pairs = pairs.join(named, side)
    return pairs.where(F.levenshtein("word_a", "word_b", 1) == 1)


def variant_groups(counts: DataFrame, times: int = 10) -> DataFrame:
    """The usual form of every word: ``word, form, root, n, n_near, form_n``.

    ``counts`` have ``word`` (distinct) and ``n``. The form is the near word of
    largest ``n``, the least of equal ones, if it stands ``times`` as often as
    the word. The root is where following the forms ends.
    """
    words = settled(counts.select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    pairs = near_words(words)
    both = F.array(*[F.struct(F.col(x).alias("id"), F.struct((-F.col(f"n_{y}")).alias("less"), F.col(f"word_{y}").alias("word"), F.col(y).alias("id")).alias("near"))
                     for x, y in (("a", "b"), ("b", "a"))])
    near = pairs.select(F.explode(both).alias("row")).select("row.*").groupBy("id").agg(
        F.count("*").alias("n_near"), F.min("near").alias("near"))
    chosen = F.when(-F.col("near.less") >= F.col("n") * times, F.col("near"))
    judged = settled(words.join(near, "id", "left").withColumn("form", chosen).select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form.word").alias("form"),
        F.col("form.id").alias("up"), (-F.col("form.less")).alias("form_n")))
    # A form is that much more frequent, so the ways are short and have no rings; each round doubles the steps.
    ways = judged.where(F.col("up").isNotNull()).select("id", "up")
    while True:
        further = ways.select(F.col("id").alias("up"), F.col("up").alias("_up"))
        ways = settled(ways.join(further, "up", "left").select("id", F.coalesce("_up", "up").alias("up"), F.col("_up").isNotNull().alias("moved")))
        if ways.where("moved").isEmpty():
            break
        ways = ways.select("id", "up")
    roots = ways.select("id", "up").join(words.select(F.col("id").alias("up"), F.col("word").alias("root")), "up").select("id", "root")
    return judged.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
