"""Language of texts by interpolated Kneser-Ney character models.

Texts are lower-cased; each run of characters that are not letters is one
space. Every language has a model of n-grams up to a fixed order. The highest
order uses counts, lower ones the number of different characters seen before.
The models lie in sorted hash arrays over all languages: per order one array
of n-grams with a log probability for each language, and one of contexts with
the weights of backing off. A text gets the language of least cross-entropy
for each character, the first in sorted order if equal.

A text is rejected when its cross-entropy is above the limit of its language,
calibrated on rows kept aside in training: their mean, plus ``MARGIN`` times
both the excess that a share ``KEEP`` of them stays within and the same for
the excess times the root of the length, over the root of the text's length. Texts that are null or have no letter are ``und`` with score 0 and
rejected.

Training reads ``most_rows`` rows of a language at most, chosen by hash. Texts
longer than a piece are read piece by piece, each with the last characters of
the one before as its context, so the size of a piece changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import text_buffers

ORDER, MOST_ROWS = 4, 5_000
KEEP, MARGIN = 0.999, 2.5
UNKNOWN = "und"
# Characters handled at once.
_PIECE = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LETTER = regex.compile(r"\p{L}")
_LETTERS: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        match = regex.compile(r"\p{L}").match
        _LETTERS.append(np.array([not 0xD800 <= c < 0xE000 and match(chr(c)) is not None for c in range(65536)]))
    letters = _LETTERS[0][np.minimum(codes, 65535)]
    far = codes > 65535
    if far.any():
        values, place = np.unique(codes[far], return_inverse=True)
        letters[far] = np.array([regex.match(r"\p{L}", chr(v)) is not None for v in values.tolist()])[place]
    return letters


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each with ``ORDER - 1`` starts (code 1) before it, and offsets of the texts."""
    joined = "\x00".join(t.replace("\x00", " ") for t in texts).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    letters = _is_letter(codes)
    ends = codes == 0
    after_letter = np.concatenate([[False], letters[:-1]])
    kept = (letters | after_letter) & ~ends
    owner = np.cumsum(ends)[kept]
    codes = np.where(letters, codes, np.uint32(32))[kept]
    lengths = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    pad = ORDER - 1
    offsets = np.concatenate([[0], np.cumsum(lengths + pad)])
    out = np.ones(offsets[-1], np.uint32)
    out[np.arange(len(codes)) + pad * (owner + 1)] = codes
    return out, offsets


def joined_characters(
    pieces: list[str], owners: list[int], before: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, offsets and the places of real characters; a piece goes on where its owner's piece before it ended."""
    codes, offsets = characters(pieces)
    real, pad = np.flatnonzero(codes != 1), ORDER - 1
    if before is not None:
        codes[:pad] = before
    for i in range(1, len(pieces)):
        if owners[i] == owners[i - 1]:
            codes[offsets[i]: offsets[i] + pad] = codes[offsets[i] - pad: offsets[i]]
    return codes, offsets, real


def _cut(text: str) -> Iterator[str]:
    """Pieces of a text; all but the first begin with a letter, so that no run of others is split."""
    at = 0
    # Letters at an end look ahead when lower-cased, so that is done before.
    text = text if len(text) <= _PIECE else text.lower()
    while at < len(text) or not at:
        found = _LETTER.search(text, at + _PIECE) if at + _PIECE < len(text) else None
        end = found.start() if found else len(text)
        # The first of a run of other characters stands for all.
        yield text[at: min(end, at + _PIECE + 1)]
        at = max(end, 1)


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` codes that end at each place; the first places lack some."""
    out = np.zeros(len(codes), np.uint64)
    for back in range(size - 1, -1, -1):
        out *= _BASE
        out[back:] += codes[: len(codes) - back].astype(np.uint64) + np.uint64(7)
    return out


@dataclass
class Models:
    """All languages' models; row ``k`` of the lists belongs to n-grams of ``k`` characters."""

    languages: list[str]
    grams: list[np.ndarray]
    chances: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    nothing: np.ndarray
    limits: np.ndarray | None = None

    def log_chances(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Log2 probability of the character at each place, a column for each language."""
        out = np.zeros((len(places), len(self.languages)), np.float32)
        open_rows = np.arange(len(places))
        for size in range(len(self.grams) - 1, 0, -1):
            values = gram_hashes(codes, size)[places[open_rows]]
            rows, found = _lookup(self.grams[size], values)
            out[open_rows[found]] += self.chances[size][rows[found]]
            open_rows = open_rows[~found]
            if not len(open_rows):
                return out
            if size > 1:
                values = gram_hashes(codes, size - 1)[places[open_rows] - 1]
            else:
                values = np.zeros(len(open_rows), np.uint64)
            rows, found = _lookup(self.contexts[size], values)
            out[open_rows[found]] += self.weights[size][rows[found]]
        out[open_rows] += self.nothing
        return out

    def entropies(
        self, pieces: list[str], owners: list[int], before: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits for each piece and language, the number of characters, and the context that is left behind."""
        codes, offsets, real = joined_characters(pieces, owners, before)
        sums, counts = np.zeros((len(pieces), len(self.languages))), np.diff(offsets) - (ORDER - 1)
        owner = np.searchsorted(offsets, real, "right") - 1
        logs = self.log_chances(codes, real)
        for k in range(len(self.languages)):
            sums[:, k] = np.bincount(owner, -logs[:, k], len(pieces))
        return sums, counts, codes[len(codes) - (ORDER - 1):]


def _lookup(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    rows = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return rows, keys[rows] == values


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models from each language's n-grams (a row of codes each) and their counts."""
    languages = sorted(counts)
    number = len(languages)
    letters = np.unique(np.concatenate([g[:, -1] for g, _ in counts.values()])) if counts else np.zeros(0)
    nothing = np.full(number, -np.log2(len(letters) + 2), np.float32)
    grams, chances = [np.zeros(0, np.uint64)], [np.zeros((0, number))]
    contexts, weights = [np.zeros(0, np.uint64)], [np.zeros((0, number), np.float32)]
    lower = None
    if not languages:
        return Models(languages, grams, chances, contexts, weights, nothing)
    for size in range(1, ORDER + 1):
        tables = [_order_counts(*counts[name], size) for name in languages]
        keys = np.unique(np.concatenate([_row_hashes(t[0]) for t in tables]))
        heads = np.unique(np.concatenate([_row_hashes(t[0][:, :-1]) for t in tables]))
        shown = np.zeros((len(keys), number))
        backing = np.ones((len(heads), number))
        example = np.zeros((len(keys), size), np.uint32)
        for k, (rows, seen) in enumerate(tables):
            once, twice = int((seen == 1).sum()), int((seen == 2).sum())
            discount = once / (once + 2 * twice) if once else 0.5
            at, head = np.searchsorted(keys, _row_hashes(rows)), np.searchsorted(heads, _row_hashes(rows[:, :-1]))
            totals, kinds = np.bincount(head, seen, len(heads)), np.bincount(head, minlength=len(heads))
            shown[at, k] = (seen - discount) / totals[head]
            backing[:, k] = np.where(totals > 0, discount * kinds / np.maximum(totals, 1), 1.0)
            example[at] = rows
        head = np.searchsorted(heads, _row_hashes(example[:, :-1]))
        if lower is None:
            before = np.broadcast_to(2.0 ** nothing.astype(np.float64), shown.shape)
        else:
            before = lower[np.searchsorted(grams[size - 1], _row_hashes(example[:, 1:]))]
        lower = shown + backing[head] * before
        grams.append(keys)
        chances.append(np.log2(lower).astype(np.float32))
        contexts.append(heads)
        weights.append(np.log2(backing).astype(np.float32))
    return Models(languages, grams, chances, contexts, weights, nothing)


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        out = out * _BASE + (rows[:, k].astype(np.uint64) + np.uint64(7))
    return out


def _order_counts(grams: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of ``size`` with their counts, or for lower orders the kinds of characters before them."""
    if size == ORDER:
        return grams, counts.astype(np.float64)
    longer = grams[np.unique(_row_hashes(grams[:, ORDER - size - 1:]), return_index=True)[1], ORDER - size - 1:]
    shorter = longer[:, 1:]
    _, first, kinds = np.unique(_row_hashes(shorter), return_index=True, return_counts=True)
    return shorter[first], kinds.astype(np.float64)


def _text_lists(column: pa.Array) -> Iterator[tuple[int, int, list[str], list[int]]]:
    """Ranges of rows with their texts in pieces, and the row of each piece."""
    data, offsets = text_buffers(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + _PIECE, "right")) - 1)
        high = min(high, rows)
        pieces, owners = [], []
        for i in range(low, high):
            text = data[offsets[i]: offsets[i + 1]].tobytes().decode("utf-8", "replace")
            for piece in _cut(text):
                pieces.append(piece)
                owners.append(i - low)
        yield low, high, pieces, owners
        low = high


def _row_entropies(models: Models, count: int, pieces: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    sums, sizes = np.zeros((count, len(models.languages))), np.zeros(count, np.int64)
    step, left = 1 if len(pieces) > count else len(pieces), None
    for at in range(0, len(pieces), max(step, 1)):
        before = left if at and owners[at] == owners[at - 1] else None
        part, size, left = models.entropies(pieces[at: at + step], owners[at: at + step], before)
        np.add.at(sums, owners[at: at + step], part)
        np.add.at(sizes, owners[at: at + step], size)
    return sums, sizes


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", most_rows: int = MOST_ROWS) -> Models:
    """Models of all languages of the rows, with calibrated limits."""
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(most_rows)) / F.count("*")).alias("share"))
    # One row for each language, of which the models hold a column each; joined by shuffle, a language would be one task.
    rows = rows.withColumn("draw", F.xxhash64("text")).join(F.broadcast(sizes), "lang")
    rows = rows.where(F.pmod("draw", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    aside = F.pmod(F.shiftright("draw", 32), F.lit(10)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for name in sorted(set(langs)):
                texts = batch.column(0).take(pa.array(np.flatnonzero(langs == name)))
                for _, _, pieces, owners in _text_lists(texts):
                    codes, _, real = joined_characters(pieces, owners)
                    values = gram_hashes(codes, ORDER)
                    _, first, seen = np.unique(values[real], return_index=True, return_counts=True)
                    ends = real[first]
                    grams = np.stack([codes[ends - back] for back in range(ORDER - 1, -1, -1)], axis=1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(seen), pa.string()), pa.array([g.tobytes() for g in grams], pa.binary()),
                        pa.array(seen)], names=["lang", "gram", "seen"])

    counted = rows.where(~aside).select("text", "lang").mapInArrow(count, "lang string, gram binary, seen bigint")
    # Bounded by ``most_rows`` texts for each language.
    found = counted.groupBy("lang", "gram").agg(F.sum("seen").alias("seen")).toArrow()
    counts = {}
    langs, grams, seen = (found.column(k) for k in range(3))
    names = np.array(langs.to_pylist(), object)
    codes = np.frombuffer(b"".join(grams.to_pylist()), np.uint32).reshape(-1, ORDER)
    for name in sorted(set(names)):
        own = np.flatnonzero(names == name)
        order = np.argsort(_row_hashes(codes[own]))
        counts[name] = (codes[own][order], seen.to_numpy()[own][order])
    models = build(counts)
    models.limits = _calibrated(rows.where(aside), models)
    return models


def _calibrated(aside: DataFrame, models: Models) -> np.ndarray:
    """For each language, the limit of very long texts and what is added over the root of the length."""
    limits = np.full((len(models.languages), 2), np.inf)
    judged = judge(aside.select("text", "lang"), models, "lang", "text")
    known = judged.where(F.col("lang") == F.col("lang_pred"))
    means = known.groupBy("lang").agg((F.sum(F.col("bits") * F.col("n_chars")) / F.sum("n_chars")).alias("mean"))
    over = F.col("bits") - F.col("mean")
    found = known.join(means, "lang").groupBy("lang").agg(
        F.first("mean"), F.percentile(over, KEEP), F.percentile(over * F.sqrt("n_chars"), KEEP))
    for name, mean, long, short in found.collect():
        limits[models.languages.index(name)] = mean + max(long, 0.0) * MARGIN, max(short, 0.0) * MARGIN
    return limits


def _verdicts(held: Models, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of rows with place of the language, score, bits, characters, and whether rejected."""
    for low, high, pieces, owners in _text_lists(column):
        sums, sizes = _row_entropies(held, high - low, pieces, owners)
        known = (sizes > 0) & bool(held.languages)
        bits = np.divide(sums, sizes[:, None], where=sizes[:, None] > 0, out=np.zeros_like(sums))
        best = np.where(known, bits.argmin(axis=1) if held.languages else 0, len(held.languages))
        least = bits.min(axis=1) if held.languages else np.zeros(len(best))
        # Nearby characters are not independent, so evidence is held back for long texts.
        evidence = np.exp2(-(bits - least[:, None]) * np.minimum(sizes, 60)[:, None])
        score = np.where(known, 1 / np.maximum(evidence.sum(axis=1), 1), 0.0)
        rejected = ~known
        if held.limits is not None and held.languages:
            limit, more = held.limits[np.minimum(best, len(held.languages) - 1)].T
            rejected = rejected | (least > limit + more / np.sqrt(np.maximum(sizes, 1)))
        yield low, high, best, score, least, sizes, rejected


def judge(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``lang_pred``, ``score`` (0 to 1), ``bits`` for each character, ``n_chars`` and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        names = np.array([*held.languages, UNKNOWN], object)
        for batch in batches:
            for low, high, best, score, least, sizes, rejected in _verdicts(held, batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(names[best], pa.string()), pa.array(score),
                    pa.array(least), pa.array(sizes), pa.array(rejected)],
                    names=["id", "lang_pred", "score", "bits", "n_chars", "rejected"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"id {kind}, lang_pred string, score double, bits double, n_chars bigint, rejected boolean"
    ).withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, as they are; nothing is shuffled."""
    shared, at = docs.sparkSession.sparkContext.broadcast(models), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [~v[-1] for v in _verdicts(shared.value, batch.column(at))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
