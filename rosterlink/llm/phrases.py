"""Phrase collocations by SON partitioning (Savasere, Omiecinski, Navathe 1995).

Texts are dealt into *shards* of one language, written once as a list of
distinct words and a row of word numbers. Then

1. every shard is mined completely at a support lowered in proportion to its
   share of the words: a phrase with ``min_count`` occurrences overall reaches
   ``ceil(min_count * share)`` in some shard;
2. the phrases frequent in some shard are united. What stands below the support
   of the other shards is bounded, so of those united the ones that cannot
   reach ``min_count`` even with that are dropped at once;
3. every shard counts the candidates, by their words and exactly, and the
   counts are summed by parts of the phrases.

Steps 1 and 2 know phrases by a hash key, which can only let too many through.
Keys are dealt into ranges whose number grows with the input, so each task
holds a bounded part of them. A shard with a support of 1 has listed all its
phrases and is sent back only those of its own that are candidates; fewer than
``min_count`` shards of a language can have a higher one, and only these are
sent the candidates of their language.

A shard lists nearly as many phrases as it has words, so what is shuffled is
packed: keys as the steps between them, phrases in order, where neighbours
begin alike.

Then the scores: every cut of a candidate into two parts is compared with what
the parts' own counts make likely. All arithmetic is exact decimal (counts
below 10^15).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import settled
from .words import mix, ragged, span_hashes, text_buffers

#: Bytes of text in a shard, unless one text is longer.
SHARD_BYTES = 6 << 20
#: Bytes of text that a task holds of all languages before it closes the largest shard.
HELD_BYTES = 16 << 20
#: Words of input for each range of keys; more ranges would leave few keys of a shard in each.
RANGE_WORDS = 1 << 21
#: Bits of a key besides its range: two to four places for each word of the input.
_KEY_BITS = 22

_U = np.uint64
_SPACES, _BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_SPACES)] = 1
_KIND[list(_BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_BLOCK = 1 << 20


# --- shards ---------------------------------------------------------------------------


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and whether a piece begins with it."""
    kind = _KIND[data]
    word = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word])
    here = np.append(word, False)
    starts, ends = np.flatnonzero(here & (edge | ~before)), np.flatnonzero(before & (edge | ~here))
    breaks = np.searchsorted(np.flatnonzero(kind == 2), starts) + np.searchsorted(offsets, starts, "right")
    first = np.ones(len(starts), bool)
    first[1:] = breaks[1:] != breaks[:-1]
    return starts, ends, first


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out, done = np.empty(len(starts), np.uint64), 0
    while done < len(starts):
        upto = max(int(np.searchsorted(ends, starts[done] + _BLOCK, "right")), done + 1)
        low, high = starts[done], ends[upto - 1]
        out[done:upto] = span_hashes(_VALUES[data[low:high]], starts[done:upto] - low, ends[done:upto] - low)
        done = upto
    return out


#: Numbers below take one byte, those below the second limit two, others five.
_ONE, _TWO = 192, 192 + (63 << 8)


def _packed(values: np.ndarray) -> bytes:
    """Numbers modulo 2^32; their first, second and further bytes are packed one after another."""
    values = values.astype(np.int64) & 0xFFFFFFFF
    far = values >= _TWO
    two = values[(values >= _ONE) & ~far] - _ONE
    first = np.where(far, 255, np.where(values < _ONE, values, _ONE + (values - _ONE >> 8)))
    streams = [first, two & 255, *(values[far] >> 8 * k & 255 for k in range(4))]
    out = []
    for stream in streams:
        packer = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_RLE)
        out += packer.compress(stream.astype(np.uint8).tobytes()), packer.flush()
    return b"".join(out)


def _unpacked(blob: bytes) -> np.ndarray:
    streams = []
    for _ in range(6):
        packer = zlib.decompressobj(-15)
        streams.append(np.frombuffer(packer.decompress(blob) + packer.flush(), np.uint8).astype(np.int64))
        blob = packer.unused_data
    values = streams[0]
    far = values == 255
    two = (values >= _ONE) & ~far
    values[two] = (values[two] - _ONE << 8) + streams[1] + _ONE
    values[far] = sum(stream << 8 * k for k, stream in enumerate(streams[2:]))
    return values


def _key_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _keys_of(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 3, 4), np.uint8)
    wide[:, :3] = np.frombuffer(blob, np.uint8).reshape(-1, 3)
    return wide.view("<u4").ravel()


def _steps(keys: np.ndarray) -> bytes:
    """Keys in ascending runs, packed as the steps from one to the next."""
    return _packed(np.diff(keys.astype(np.int64), prepend=0))


def _stepped(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob)) & 0xFFFFFFFF


SHARDS = "shard bigint, lang string, n_words bigint, words binary, lengths binary, numbers binary"
_SHARDS = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary()), ("numbers", pa.binary())])


def _strings(text: bytes, ends: np.ndarray) -> pa.LargeStringArray:
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(text))


def _shard(texts: list[pa.Array]) -> tuple[int, bytes, bytes, bytes]:
    """Number of words; the distinct words, the length of each, and the word numbers from 1, with 0 before each piece."""
    data, offsets = text_buffers(pa.chunked_array(texts, pa.large_string()))
    data = _LOWER[data]
    starts, ends, first = _words(data, offsets)
    _, at, numbers, times = np.unique(_hashes(data, starts, ends), return_index=True, return_inverse=True, return_counts=True)
    # Frequent words get small numbers, which pack well, as do equally frequent ones in order.
    spelt = _strings(data[ragged(starts[at], ends[at] - starts[at])].tobytes(), np.cumsum(ends[at] - starts[at]))
    order = pc.sort_indices(pa.table({"times": times, "word": spelt}), [("times", "descending"), ("word", "ascending")]).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at, numbers = at[order], place[numbers]
    lengths = ends[at] - starts[at]
    words = data[ragged(starts[at], lengths)]
    row = np.insert(numbers.astype(np.int32) + 1, np.flatnonzero(first), 0)
    return len(starts), zlib.compress(words.tobytes(), 1), _packed(lengths), _packed(row)


def _sharder(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        sizes: dict[str, int] = {}
        task, made = TaskContext.get().partitionId(), 0

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal made
            sizes.pop(lang)
            made += 1
            row = [(task << 32) + made, lang, *_shard(held.pop(lang))]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SHARDS)], schema=_SHARDS)

        for batch in batches:
            langs, texts = batch.column(0), batch.column(1).cast(pa.large_string())
            for lang in langs.unique().to_pylist():
                own = texts.filter(pc.equal(langs, lang))
                upto = np.cumsum(pc.fill_null(pc.binary_length(own), 0).to_numpy(zero_copy_only=False))
                row = 0
                while row < len(own):
                    # As many texts as the open shard takes, and one at least.
                    before = upto[row - 1] if row else 0
                    end = int(np.searchsorted(upto, before + shard_bytes - sizes.get(lang, 0))) + 1
                    held.setdefault(lang, []).append(own[row:end])
                    sizes[lang] = sizes.get(lang, 0) + int(upto[min(end, len(own)) - 1] - before)
                    if sizes[lang] >= shard_bytes:
                        yield closed(lang)
                    row = end
            while sum(sizes.values()) > HELD_BYTES:
                yield closed(max(sizes, key=sizes.get))
        for lang in list(held):
            yield closed(lang)

    return run


# --- phrases of a shard ---------------------------------------------------------------


class _Shard:
    """Words of a shard and the places at which phrases of some size start."""

    def __init__(self, words: bytes, lengths: bytes, numbers: bytes):
        row = _unpacked(numbers) - 1
        self.numbers = row[row >= 0]
        self.piece = np.cumsum(row < 0)[row >= 0]
        self.name(zlib.decompress(words), np.cumsum(_unpacked(lengths), dtype=np.int64))

    def name(self, text: bytes, ends: np.ndarray) -> None:
        self.text, self.ends = text, ends
        starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        hashes = _hashes(np.frombuffer(self.text, np.uint8), starts, self.ends)
        self.hashes = hashes[self.numbers]

    def spell(self) -> None:
        """Words that are no valid UTF-8 become what they are shown as."""
        words = _strings(self.text, self.ends)
        try:
            words.validate(full=True)
        except pa.ArrowInvalid:
            shown = [w.decode("utf-8", "replace").encode() for w in words.cast(pa.large_binary()).to_pylist()]
            self.name(b"".join(shown), np.cumsum([len(w) for w in shown], dtype=np.int64))

    def places(self, size: int) -> np.ndarray:
        count = max(len(self.numbers) - size + 1, 0)
        return np.flatnonzero(self.piece[:count] == self.piece[size - 1: size - 1 + count])

    def keys(self, places: np.ndarray, size: int) -> np.ndarray:
        out = np.full(len(places), size, np.uint64)
        for k in range(size):
            out = mix(out * _U(0x9E3779B97F4A7C15) + self.hashes[places + k])
        return out

    def phrases(self, places: np.ndarray, size: int) -> pa.LargeStringArray:
        words = _strings(self.text, self.ends)
        return _joined([words.take(pa.array(self.numbers[places + k])) for k in range(size)], " ")


def _joined(columns: list[pa.LargeStringArray], between: str) -> pa.LargeStringArray:
    return pc.binary_join_element_wise(*columns, pa.scalar(between, pa.large_string()))


MINED = "lang string, `range` int, shard bigint, support bigint, keys binary, repeated binary, counts binary"
_MINED = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("shard", pa.int64()), ("support", pa.int64()),
                    ("keys", pa.binary()), ("repeated", pa.binary()), ("counts", pa.binary())])


def _miner(longest: int, bits: int):
    def mine(shard: int, lang: str, support: int, own: _Shard) -> Iterator[tuple]:
        keys, counts, alive = [], [], None
        for size in range(1, longest + 1):
            places = own.places(size)
            if alive is not None:
                # Both phrases one word shorter are frequent here as well.
                places = places[alive[places] & alive[places + 1]]
            hashes = own.keys(places, size) >> _U(64 - bits - _KEY_BITS)
            if support > 1:
                distinct, inverse, times = np.unique(hashes, return_inverse=True, return_counts=True)
                alive = np.zeros(len(own.numbers) + 1, bool)
                alive[places[times[inverse] >= support]] = True
                distinct, times = distinct[times >= support], times[times >= support]
            else:
                distinct, times = np.unique(hashes, return_counts=True)
            keys.append(distinct)
            counts.append(times)
        merged, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(merged)).astype(np.int64)
        ranges = merged >> _U(_KEY_BITS)
        edges = np.searchsorted(ranges, np.arange((1 << bits) + 1, dtype=np.uint64))
        low = merged & _U((1 << _KEY_BITS) - 1)
        for r in range(1 << bits):
            if edges[r] == edges[r + 1]:
                continue
            mine_keys, times = low[edges[r]: edges[r + 1]], total[edges[r]: edges[r + 1]]
            # Most phrases stand once in a shard: their counts are not written.
            often = times > 1
            yield (lang, r, shard, support, _key_bytes(np.concatenate([mine_keys[often], mine_keys[~often]])),
                   int(often.sum()).to_bytes(8, "little"), _packed(times[often]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _Shard(row["words"], row["lengths"], row["numbers"])
                rows = list(zip(*mine(row["shard"], row["lang"], row["support"], own)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _MINED)], schema=_MINED)

    return run


def _with_steps(miner):
    """The miner's rows with their keys packed, as they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in miner(batches):
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["keys"] = pa.array([_steps(_keys_of(k)) for k in batch.column("keys").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=_MINED)

    return run


UNITED = "lang string, shard bigint, `range` int, keys binary"
_UNITED = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("range", pa.int32()), ("keys", pa.binary())])
#: Stands for all shards of a language that have a support above 1.
_EVERY = -1


def _uniter(least: int):
    def unite(table: pa.Table) -> pa.Table:
        """Of the phrases of one range and language, those that may be frequent: for the shards that listed them all, and once more."""
        keys = [_stepped(k) for k in table["keys"].to_pylist()]
        counts = []
        for own, repeated, times in zip(keys, table["repeated"].to_pylist(), table["counts"].to_pylist()):
            count = np.ones(len(own), np.int64)
            count[: int.from_bytes(repeated, "little")] = _unpacked(times)
            counts.append(count)
        support = np.array(table["support"].to_pylist(), np.int64)
        merged, at = np.unique(np.concatenate(keys), return_inverse=True)
        listed = np.zeros(len(merged), np.int64)
        # A shard that does not name a phrase holds it less often than its support.
        hidden = np.full(len(merged), table["hidden"][0].as_py(), np.int64)
        np.add.at(listed, at, np.concatenate(counts))
        np.subtract.at(hidden, at, np.repeat(support - 1, [len(k) for k in keys]))
        fits = listed + hidden >= least
        lang, part = table["lang"][0].as_py(), table["range"][0].as_py()
        rows = [(lang, _EVERY, part, _steps(merged[fits]))] if table["hidden"][0].as_py() else []
        ends = np.cumsum([len(k) for k in keys])
        for shard, low, own, end in zip(table["shard"].to_pylist(), support, keys, ends):
            chosen = own[fits[at[end - len(own): end]]]
            if low == 1 and len(chosen):
                rows.append((lang, shard, part, _steps(np.sort(chosen))))
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _UNITED)], schema=_UNITED)

    return unite


PARTS = "lang string, part int, phrases binary, counts binary"
_PARTS = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("phrases", pa.binary()), ("counts", pa.binary())])


def _counter(longest: int, bits: int):
    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        """Exact counts in one shard of the phrases whose keys it was sent, those of a part in order and packed."""
        if not left.num_rows or not right.num_rows:
            return _PARTS.empty_table()
        wanted = np.sort(np.concatenate([
            _stepped(k).astype(np.uint64) + (_U(r) << _U(_KEY_BITS))
            for r, k in zip(right["range"].to_pylist(), right["keys"].to_pylist())]))
        own = _Shard(left["words"][0].as_py(), left["lengths"][0].as_py(), left["numbers"][0].as_py())
        counted, found = [], []
        for size in range(1, longest + 1):
            places = own.places(size)
            keys = own.keys(places, size) >> _U(64 - bits - _KEY_BITS)
            if not len(wanted):
                continue
            at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
            places = places[wanted[at] == keys]
            if not len(places):
                continue
            # Word numbers tell phrases apart without a doubt.
            code = np.zeros(len(places), np.int64)
            for k in range(size):
                _, code = np.unique(code * (len(own.ends) + 1) + own.numbers[places + k], return_inverse=True)
            _, first, times = np.unique(code, return_index=True, return_counts=True)
            counted.append((size, places[first], times))
        own.spell()
        for size, places, times in counted:
            # A part holds all that begins with the same two words: many neighbours, and no word makes one part large.
            parts = own.keys(places, min(size, 2)) >> _U(64 - max(bits - 1, 1))
            found.append(pa.table({"part": parts.astype(np.int32), "phrase": own.phrases(places, size), "n": times}))
        if not found:
            return _PARTS.empty_table()
        table = pa.concat_tables(found).sort_by([("part", "ascending"), ("phrase", "ascending")]).combine_chunks()
        data, ends = text_buffers(_joined([table["phrase"], pa.scalar("", pa.large_string())], "\n"))
        parts, starts = np.unique(table["part"].to_numpy(), return_index=True)
        edges, times = np.append(starts, table.num_rows), table["n"].to_numpy()
        return pa.table([
            pa.array([left["lang"][0].as_py()] * len(parts), pa.string()), pa.array(parts, pa.int32()),
            pa.array([zlib.compress(data[ends[a]: ends[b]], 1) for a, b in zip(edges, edges[1:])], pa.binary()),
            pa.array([_packed(times[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())], schema=_PARTS)

    return count


FOUND = "lang string, phrase string, size int, n bigint"
_FOUND = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])


def _summer(least: int):
    def total(table: pa.Table) -> pa.Table:
        """The phrases of one part that are frequent in all shards together."""
        phrases = []
        for blob in table["phrases"].to_pylist():
            lines = zlib.decompress(blob)
            phrases.append(_strings(lines, np.flatnonzero(np.frombuffer(lines, np.uint8) == 10) + 1))
        times = np.concatenate([_unpacked(c) for c in table["counts"].to_pylist()])
        summed = pa.table({"line": pa.chunked_array(phrases), "n": times}).group_by("line", use_threads=False).aggregate([("n", "sum")])
        summed = summed.filter(pc.greater_equal(summed["n_sum"], least))
        phrase = pc.utf8_rtrim(summed["line"], "\n")
        size = pc.add(pc.count_substring(phrase, " "), 1)
        lang = pa.array([table["lang"][0].as_py()] * len(phrase), pa.string())
        return pa.table([lang, phrase.cast(pa.string()), size.cast(pa.int32()), summed["n_sum"]], schema=_FOUND)

    return total


# --- operators ------------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, min_count: int = 10, longest: int = 3, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """All words and phrases of up to ``longest`` words with ``min_count`` occurrences in their language.

    ``docs`` have ``text`` and ``lang``. A-Z count as a-z; marks ``.,;:!?`` and
    line ends cut a text into pieces, blanks and tabs a piece into words.
    Output: ``lang, phrase, size, n``, and ``lang, n``, the number of words of
    each language. A null ``lang`` is ``und``, a null or empty text has no words.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    shards = settled(texts.mapInArrow(_sharder(shard_bytes), SHARDS))
    words = settled(shards.groupBy("lang").agg(F.sum("n_words").alias("n")))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Keys grow with the input, so that strangers meet in one as seldom as before.
    bits = min(max(int(total) // RANGE_WORDS, 1).bit_length(), 30)
    share = F.col("n_words").cast("decimal(19,0)") * min_count
    support = F.greatest(F.ceil(share / F.greatest(F.col("n"), F.lit(1))).cast("long"), F.lit(1))
    weighed = shards.join(words, "lang").withColumn("support", support)
    hidden = settled(weighed.groupBy("lang").agg(F.sum(F.col("support") - 1).alias("hidden")))
    mined = weighed.select("shard", "lang", "support", "words", "lengths", "numbers").mapInArrow(
        _with_steps(_miner(longest, bits)), MINED)
    # Written, so that what was shuffled for it can go before the shards are shuffled.
    united = settled(mined.join(hidden, "lang").groupBy("lang", "range").applyInArrow(_uniter(min_count), UNITED))
    high = settled(weighed.where("support > 1").groupBy("lang").agg(F.collect_list("shard").alias("high")))
    to = F.when(F.col("shard") == _EVERY, F.coalesce("high", F.array().cast("array<bigint>"))).otherwise(F.array("shard"))
    sent = united.join(high, "lang", "left").select(F.explode(to).alias("shard"), "range", "keys")
    found = shards.select("shard", "lang", "words", "lengths", "numbers").groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(
        _counter(longest, bits), PARTS)
    return settled(found.groupBy("lang", "part").applyInArrow(_summer(min_count), FOUND)), words


def collocations(docs: DataFrame, min_count: int = 10, longest: int = 3, covered_percent: int = 50, most: int | None = 2000,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Phrases of two words or more that stand together oftener than their parts make likely.

    With ``a`` occurrences of the phrase and ``l`` and ``r`` of the two parts
    of a cut, the cut scores ``floor(1000000 * a * a / (l * r))``; the cut with
    the lowest score counts, the first of equal ones. A phrase goes when a
    longer candidate that holds it has ``covered_percent`` of its occurrences.
    Output: ``lang, rank`` (from 1), ``phrase, a, l, r, n, score``, for each
    language the first ``most`` by score, then ``a`` (high first), then phrase
    by bytes. No documents, or no frequent phrase, give no rows.
    """
    counts, words = frequent_phrases(docs, min_count, longest, shard_bytes)
    phrases = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    cut = phrases.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cut = cut.withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    # The right part is made after the first join, so that less is shuffled for it.
    sides = cut.join(known.withColumnsRenamed({"part": "left", "times": "l"}), ["lang", "left"]).select(
        "lang", "phrase", "a", "cut", "l", F.expr("substring(phrase, length(left) + 2)").alias("right"))
    sides = sides.join(known.withColumnsRenamed({"part": "right", "times": "r"}), ["lang", "right"])
    whole = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    above, below = whole["a"] * whole["a"] * F.lit(1_000_000).cast("decimal(7,0)"), whole["l"] * whole["r"]
    sides = sides.withColumn("above", above.cast("decimal(38,0)")).withColumn("below", below.cast("decimal(38,0)"))
    scored = sides.withColumn("score", F.expr("above div below"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("low")).select("lang", "phrase", "low.*")

    # Every shorter run of words within a candidate, with the candidate's count.
    inner = phrases.where("size > 2").select("lang", "size", "words", F.col("n").alias("longer"),
                                             F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    inner = inner.withColumn("first", F.explode(F.expr("sequence(1, size - part + 1)")))
    inner = inner.select("lang", F.expr("array_join(slice(words, first, part), ' ')").alias("phrase"), "longer")
    longer = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered_percent))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    ranked = ranked if most is None else ranked.where(F.col("rank") <= most)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
