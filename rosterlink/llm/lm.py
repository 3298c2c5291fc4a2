"""Language-model scores from an n-gram trie of Elias-Fano coded levels.

Words are counted in a first pass over the texts. Their hashes ascend, and the
place of a word is its number. A second pass counts triples of word numbers; the pairs
are their beginnings, as a text's end is followed by a mark, so pairs need no pass of
their own. Triples go by ranges of their first two words to parts of like mass: a
frequent first word is split among several parts. One task then codes the pairs and
triples of a part and looks nothing up outside it:

* Pairs: for each first word a pointer to its first successor (pointers are monotone), and the
  successors made monotone by adding the last value of the group before.
* Triples: the same, with the pairs of the part as parents. So the third word is searched
  only among the successors of its context, relative to where these begin.

Nodes hold what discounting left of their own share, and pairs what is left for
words not among their successors, as log probabilities quantised to 16 bits;
what is spent of each first word stays exact. A score adds them up: absolute discounting, interpolated
with the next shorter context, and add-one for single words. N-grams seen less than
``min_counts`` times have no node; their mass stays with the shorter context, so
probabilities of a context sum to one.

The parts are Parquet rows in the shared folder. Where that is a mounted one,
each part is laid out there once, in plain arrays that all workers memory-map.
From a store that only Spark reads, ``SparkContext.addFile`` brings the parts to each
executor, which lays them out on its own disk; there the model must fit that
disk. Look-ups take the distinct n-grams of many texts in the order of the trie, a block at a time, and
give back the pages of each block, so a worker holds no more than a block touches.

A text is its words (A-Z lower-cased) and one end, which is a token. Null and
empty texts are one end. Without training rows every token is unknown. Rows that share
an id are scored each on their own; null ids stay.
"""

from __future__ import annotations

import contextlib
import mmap
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import settled
from . import eliasfano
from .words import chunks, text_buffers, word_hashes

# Least counts of words, pairs and triples that have a node.
MIN_COUNTS = (1, 1, 1)
DISCOUNT = 0.75
# Steps of a quantised log10 probability.
STEPS = 4096
# Tokens a task gathers before it counts them.
_PENDING = 2_000_000
# Training tokens whose triples one part holds, about.
PART_TOKENS = 1 << 20
# Bytes of text scored at once, and n-grams looked up at once.
_SCORED_BYTES = 1 << 22
_BLOCK = 1 << 15
_U = np.uint64
END = _U(0x5851F42D4C957F2D)

_SEQUENCES = ("heads", "nodes", "thirds_heads", "thirds")
_PLAIN = {"counts": np.uint64, "spent": np.float64, "chances": np.uint16, "backs": np.uint16, "thirds_chances": np.uint16}
_FIELDS = [f"{s}_{a}" for s in _SEQUENCES for a in eliasfano.ARRAYS] + list(_PLAIN)
_KINDS = {f"{s}_{a}": t for s in _SEQUENCES for a, t in eliasfano.ARRAYS.items()} | _PLAIN
# ``low`` is the first word that is a parent in a part; the masses are those spent by its first and last parent.
_FACTS = {"part": "bigint", "size": "bigint", "total": "bigint", "low": "bigint", "parents": "bigint",
          "first_spent": "double", "last_spent": "double"} | {f"{s}_width": "bigint" for s in _SEQUENCES}
_PART_SCHEMA = ", ".join([f"{n} {t}" for n, t in _FACTS.items()] + [f"{f} binary" for f in _FIELDS])


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype(np.uint16)


def _shares(values: np.ndarray) -> np.ndarray:
    """The probabilities that quantised values stand for."""
    return 10.0 ** (values.astype(np.float64) / -STEPS)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of each text, ends included, and the offsets of the texts."""
    hashes, rows = word_hashes(data, offsets)
    out = np.full(len(hashes) + len(rows) - 1, END)
    out[np.arange(len(hashes)) + np.repeat(np.arange(len(rows) - 1), np.diff(rows))] = hashes
    return out, rows + np.arange(len(rows))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts in 64 bits."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[starts], np.add.reduceat(counts[order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)


def _ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the rank of each value among them."""
    distinct, ranks = np.unique(values, return_inverse=True)
    return distinct, ranks.astype(np.uint64)


def part_of_pair(edges: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The part of each pair; ``edges`` are the ascending pairs at which parts after the first one begin."""
    part = np.searchsorted(edges[:, 0], first, "left")
    # Parts that begin within the successors of one word.
    todo = np.flatnonzero(part < np.searchsorted(edges[:, 0], first, "right"))
    while len(todo):
        at = part[todo]
        todo = todo[(edges[at, 0] == first[todo]) & (edges[at, 1] <= second[todo])]
        part[todo] += 1
        todo = todo[part[todo] < len(edges)]
    return part


class Level:
    """The words, or the pairs and triples, from parts in order."""

    def __init__(self, files: Files) -> None:
        name, folder = files.name, files.folder or SparkFiles.getRootDirectory()
        done = os.path.join(folder, f"{name}.npz")
        try:
            if not files.folder and not os.path.exists(done):
                self._lay_out(list(files.files), folder, name)
        except FileNotFoundError:
            # Another worker of this executor was faster, and took the files away.
            if not os.path.exists(done):
                raise
        with np.load(done) as saved:
            facts = dict(saved)
        self.sizes, self.totals, self.low = facts["size"], facts["total"], facts["low"]
        self.parents = facts["parents"]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.offsets = {f: np.concatenate([[0], np.cumsum(facts["lengths"][k])]) for k, f in enumerate(_FIELDS)}
        self.maps, self.arrays = [], {}
        for field in _FIELDS:
            if not self.offsets[field][-1]:
                self.arrays[field] = np.zeros(0, _KINDS[field])
                continue
            with open(os.path.join(folder, f"{name}.{field}"), "rb") as file:
                self.maps.append(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
            self.arrays[field] = np.frombuffer(self.maps[-1], _KINDS[field])
        self.heads, self.nodes, self.thirds_heads, self.thirds = (
            eliasfano.EliasFano({a: self.arrays[f"{s}_{a}"] for a in eliasfano.ARRAYS}, facts[f"{s}_width"],
                                {a: self.offsets[f"{s}_{a}"] for a in eliasfano.ARRAYS}, self.starts)
            for s in _SEQUENCES)
        # First and last words of the parts, whose successors may lie in several of them, and what all these spend.
        some, many = self.parents > 0, self.parents > 1
        words = np.concatenate([self.low[some], (self.low + self.parents - 1)[many]])
        self.edge_words, ranks = np.unique(words, return_inverse=True)
        self.edge_spent = np.bincount(ranks, np.concatenate([facts["first_spent"][some], facts["last_spent"][many]]), len(self.edge_words))

    @staticmethod
    def _lay_out(files: list[str], folder: str, name: str) -> None:
        """Write the arrays of all parts as plain files, first by their numbers; the last file is the sign of success."""
        rows = sorted(((r, f, i) for f in files for i, r in enumerate(pq.read_table(SparkFiles.get(f), columns=["part"])["part"].to_pylist())))
        tag, lengths = uuid.uuid4().hex, np.zeros((len(_FIELDS), len(rows)), np.int64)
        facts = {f: pq.read_table(SparkFiles.get(f), columns=list(_FACTS)).to_pylist() for f in files}
        for k, field in enumerate(_FIELDS):
            path = os.path.join(folder, f"{name}.{field}")
            # Row order of the parts is file order within each file, so one column of one file is held at a time.
            held: dict[str, list[bytes]] = {}
            with open(f"{path}.{tag}", "wb") as out:
                for at, (_, file, row) in enumerate(rows):
                    if file not in held:
                        held = {file: pq.read_table(SparkFiles.get(file), columns=[field])[field].to_pylist()}
                    blob = held[file][row] or b""
                    lengths[k, at] = len(blob) // np.dtype(_KINDS[field]).itemsize
                    out.write(blob)
            os.replace(f"{path}.{tag}", path)
        _save_facts(os.path.join(folder, name), [facts[f][i] for _, f, i in rows], lengths)
        # The executor's own copies of the part files are not needed any more.
        for file in files:
            with contextlib.suppress(FileNotFoundError):
                os.remove(SparkFiles.get(file))

    def in_blocks(self, count: int, answer: Callable[[slice], None]) -> None:
        """Answer a block at a time and give back the pages that it touched."""
        for low in range(0, count, _BLOCK):
            answer(slice(low, min(low + _BLOCK, count)))
            for pages in self.maps:
                pages.madvise(mmap.MADV_DONTNEED)

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of words with ascending hashes, -1 and 0 for unknown ones."""
        numbers, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.uint64)

        def answer(at: slice) -> None:
            part = word_part(hashes[at], len(self.sizes))
            found = self.nodes.find(part, hashes[at], np.zeros(len(part), np.int64), self.sizes[part])
            own = np.where(found >= 0, found + self.starts[part], -1)
            numbers[at] = own
            counts[at][own >= 0] = self.arrays["counts"][own[own >= 0]]

        if len(self.sizes):
            self.in_blocks(len(hashes), answer)
        return numbers, counts

    @staticmethod
    def _search(heads: eliasfano.EliasFano, nodes: eliasfano.EliasFano, part: np.ndarray, parent: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Place in its part of the node ``name`` under ``parent``, -1 where there is none; parents ascend."""
        if not len(part):
            return np.zeros(0, np.int64)
        new = np.append(True, (part[1:] != part[:-1]) | (parent[1:] != parent[:-1]))
        own, group = part[new], np.cumsum(new) - 1
        first, end = (v.astype(np.int64) for v in heads.neighbours(own, parent[new]))
        base = np.zeros(len(own), np.uint64)
        behind = np.flatnonzero((first > 0) & (first < end))
        base[behind] = nodes.get(own[behind], first[behind] - 1)
        return nodes.find(part, base[group] + name.astype(np.uint64), first[group], end[group])

    def spent(self, edges: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The mass that the successors of ascending words take of the words' counts."""
        out = np.zeros(len(word))

        def answer(at: slice) -> None:
            part = part_of_pair(edges, word[at], np.zeros_like(word[at]))
            own = word[at] - self.low[part]
            here = np.flatnonzero((own >= 0) & (own < self.parents[part]))
            out[at][here] = self.arrays["spent"][self.offsets["spent"][part[here]] + own[here]]

        self.in_blocks(len(word), answer)
        place = np.flatnonzero(np.isin(word, self.edge_words))
        out[place] = self.edge_spent[np.searchsorted(self.edge_words, word[place])]
        return out

    def pairs(self, edges: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
        """Part, place (-1: no node) and share of ascending pairs, and what they leave to shorter contexts."""
        parts, places = np.zeros(len(first), np.int64), np.full(len(first), -1, np.int64)
        share, back = np.zeros(len(first)), np.ones(len(first))

        def answer(at: slice) -> None:
            parts[at] = part = part_of_pair(edges, first[at], second[at])
            own = first[at] - self.low[part]
            here = np.flatnonzero((own >= 0) & (own < self.parents[part]))
            places[at][here] = self._search(self.heads, self.nodes, part[here], own[here], second[at][here])
            here = np.flatnonzero(places[at] >= 0)
            part, place = part[here], places[at][here]
            share[at][here] = _shares(self.arrays["chances"][self.offsets["chances"][part] + place])
            back[at][here] = _shares(self.arrays["backs"][self.offsets["backs"][part] + place])

        self.in_blocks(len(first), answer)
        return parts, places, share, back

    def triples(self, part: np.ndarray, parent: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Share of each third word behind a pair, in the order of the pairs; 0 where there is no node."""
        share = np.zeros(len(part))

        def answer(at: slice) -> None:
            place = self._search(self.thirds_heads, self.thirds, part[at], parent[at], third[at])
            here = np.flatnonzero(place >= 0)
            share[at][here] = _shares(self.arrays["thirds_chances"][self.offsets["thirds_chances"][part[at][here]] + place[here]])

        self.in_blocks(len(part), answer)
        return share


def word_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)


def _save_facts(base: str, rows: list, lengths: np.ndarray) -> None:
    """Write what is known of the parts, in their order; ``lengths`` are items of each field and part."""
    tag = uuid.uuid4().hex
    with open(f"{base}.npz.{tag}", "wb") as out:
        np.savez(out, lengths=lengths, **{n: np.array([r[n] for r in rows], np.float64 if t == "double" else np.int64) for n, t in _FACTS.items()})
    os.replace(f"{base}.npz.{tag}", f"{base}.npz")


@dataclass(frozen=True)
class Files:
    """A level as the files its parts are in, or as arrays in a mounted folder."""

    name: str
    files: tuple[str, ...]
    folder: str | None = None


_LEVELS: dict[str, Level] = {}


def _levels(shipped: list[Files]) -> list[Level]:
    """The levels, opened once in each worker."""
    for name in set(_LEVELS) - {f.name for f in shipped}:
        del _LEVELS[name]
    for f in shipped:
        if f.name not in _LEVELS:
            _LEVELS[f.name] = Level(f)
    return [_LEVELS[f.name] for f in shipped]


def _shipped(parts: DataFrame) -> Files:
    paths = parts.inputFiles()
    if paths and all(urlsplit(p).scheme == "file" for p in paths):
        return _laid_out(parts, os.path.dirname(os.path.dirname(unquote(urlsplit(paths[0]).path))))
    for path in paths:
        parts.sparkSession.sparkContext.addFile(path)
    return Files(uuid.uuid4().hex, tuple(os.path.basename(p) for p in paths))


def _laid_out(parts: DataFrame, folder: str) -> Files:
    """Each task writes the arrays of its parts to their places in the level's files; the driver sees sizes only."""
    files = Files(uuid.uuid4().hex, (), folder)
    base = os.path.join(folder, files.name)
    facts = parts.select(*_FACTS, *[F.coalesce(F.length(f), F.lit(0)).cast("long").alias(f) for f in _FIELDS]).collect()
    facts.sort(key=lambda r: r.part)
    lengths = np.array([[r[f] for r in facts] for f in _FIELDS], np.int64).reshape(len(_FIELDS), -1)
    starts = np.cumsum(lengths, axis=1) - lengths
    places = {r.part: starts[:, k].tolist() for k, r in enumerate(facts)}
    for field, size in zip(_FIELDS, lengths.sum(axis=1).tolist()):
        with open(f"{base}.{field}", "wb") as out:
            out.truncate(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for k, field in enumerate(_FIELDS):
                with open(f"{base}.{field}", "r+b") as out:
                    for part, blob in zip(own, batch.column(k + 1)):
                        if blob.is_valid:
                            out.seek(places[part][k])
                            out.write(blob.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int64())], names=["written"])

    parts.select("part", *_FIELDS).mapInArrow(run, "written bigint").agg(F.sum("written")).collect()
    _save_facts(base, facts, lengths // np.array([[np.dtype(_KINDS[f]).itemsize] for f in _FIELDS]))
    return files


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and text offsets of some millions of tokens at a time."""
    held, starts, count = [], [], 0

    def whole() -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(held), np.append(np.concatenate(starts), count)

    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for low, high in chunks(offsets):
            hashes, rows = tokens(data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low])
            held.append(hashes)
            starts.append(rows[:-1] + count)
            count += len(hashes)
            if count > _PENDING:
                yield whole()
                held, starts, count = [], [], 0
    if count:
        yield whole()


def _cuts(parts: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    at = np.flatnonzero(np.diff(parts)) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(parts)])) if len(parts) else []


def _rows(part: int, blobs: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64())] + [pa.array([b.tobytes()], pa.binary()) for b in blobs], names=["part", *names])


def _by_part(rows: DataFrame, parts: int, shipped: list[Files], code: Callable) -> DataFrame:
    """Rows of each part brought together and coded; one part is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _levels(shipped)
        part, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != part:
                    if part is not None:
                        yield code(levels, part, held)
                    part, held = row[0], []
                held.append(row[1:])
        if part is not None:
            yield code(levels, part, held)

    return settled(rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, _PART_SCHEMA))


def _part_row(facts: dict[str, float], sequences: dict[str, np.ndarray], plain: dict[str, np.ndarray]) -> pa.RecordBatch:
    blobs = {}
    for name, values in sequences.items():
        width, arrays = eliasfano.encode(values)
        facts = facts | {f"{name}_width": width}
        blobs |= {f"{name}_{a}": v.tobytes() for a, v in arrays.items()}
    blobs |= {p: v.astype(_PLAIN[p]).tobytes() for p, v in plain.items()}
    columns = [pa.array([facts.get(n, 0)], pa.float64() if t == "double" else pa.int64()) for n, t in _FACTS.items()]
    return pa.RecordBatch.from_arrays(columns + [pa.array([blobs.get(f, b"")], pa.binary()) for f in _FIELDS], names=[*_FACTS, *_FIELDS])


def _counted_words(texts: DataFrame, parts: int, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, _ in _gathered(batches):
            keys, seen = np.unique(hashes, return_counts=True)
            own = word_part(keys, parts)
            for a, b in _cuts(own):
                yield _rows(int(own[a]), [keys[a:b], seen[a:b].astype(np.uint32)], ["keys", "counts"])

    def code(levels: list[Level], part: int, rows: list[tuple]) -> pa.RecordBatch:
        keys, seen = summed(np.concatenate([np.frombuffer(r[0], np.uint64) for r in rows]),
                            np.concatenate([np.frombuffer(r[1], np.uint32) for r in rows]))
        keep = seen >= least
        return _part_row({"part": part, "size": int(keep.sum()), "total": int(seen.sum())}, {"nodes": keys[keep]}, {"counts": seen[keep]})

    return _by_part(texts.mapInArrow(run, "part bigint, keys binary, counts binary"), parts, [], code)


def _edges(texts: DataFrame, words: Files, parts: int) -> np.ndarray:
    """Pairs at which parts of like mass begin: successors are taken to be as frequent as the words are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, = _levels([words])
        sums = np.concatenate([[0], np.cumsum(level.totals)]).astype(np.float64)

        def word_at(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The word at each share of all tokens, and what share of its own mass lies before."""
            number, rest = np.zeros(len(share), np.int64), np.zeros(len(share))
            part = np.clip(np.searchsorted(sums, share * sums[-1], "right") - 1, 0, len(level.sizes) - 1)
            for own in np.unique(part):
                at = np.flatnonzero(part == own)
                counts = np.cumsum(level.arrays["counts"][level.starts[own]: level.starts[own + 1]].astype(np.float64))
                if not len(counts):
                    number[at] = level.starts[own]
                    continue
                mass = np.clip((share[at] * sums[-1] - sums[own]) / max(level.totals[own], 1), 0, 1) * counts[-1]
                place = np.minimum(np.searchsorted(counts, mass, "right"), len(counts) - 1)
                before = np.append(0, counts)[place]
                number[at] = place + level.starts[own]
                rest[at] = np.clip((mass - before) / (counts[place] - before), 0, 1)
            return number, rest

        for batch in batches:
            k = batch.column(0).to_numpy()
            first, rest = word_at(k / parts)
            second, _ = word_at(rest)
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second)], names=["first", "second"])

    rows = texts.sparkSession.range(1, parts).mapInArrow(run, "first bigint, second bigint").collect()
    return np.array(sorted((r.first, r.second) for r in rows), np.int64).reshape(-1, 2)


def _counted_triples(texts: DataFrame, parts: int, words: Files, known: int, edges: np.ndarray, least: tuple[int, int]) -> DataFrame:
    """Pairs and triples of each part, coded. ``known`` stands for unknown words and ``known + 1`` for none."""
    narrow = np.uint32 if known + 1 < 1 << 32 else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, = _levels([words])
        for hashes, rows in _gathered(batches):
            distinct, word = _ranks(hashes)
            number, _ = level.words(distinct)
            number = np.append(np.where(number < 0, known, number), known + 1)
            # Tokens with one before in their own text; the last of a text has none behind.
            inside = np.ones(len(hashes), bool)
            inside[rows[:-1]] = False
            last = np.zeros(len(hashes), bool)
            last[rows[1:] - 1] = True
            after = np.flatnonzero(inside & (number[np.append(_U(0), word[:-1]).astype(np.int64)] != known))
            if not len(after):
                continue
            following = np.where(last[after], _U(len(distinct)), np.append(word, _U(0))[after + 1])
            # Words keep their order as ranks, so triples are counted in the order of their numbers.
            pairs, pair = _ranks(word[after - 1] << _U(32) | word[after])
            keys, seen = np.unique(pair << _U(32) | following, return_counts=True)
            sizes = np.bincount((keys >> _U(32)).astype(np.int64), minlength=len(pairs))
            first, second = number[(pairs >> _U(32)).astype(np.int64)], number[(pairs & _U(0xFFFFFFFF)).astype(np.int64)]
            thirds = number[(keys & _U(0xFFFFFFFF)).astype(np.int64)]
            ends = np.cumsum(sizes)
            own = part_of_pair(edges, first, second)
            # Unknown words stand anywhere in the order of hashes, so their pairs may lie between others.
            for a, b in _cuts(own):
                c, d = (ends[a - 1] if a else 0), ends[b - 1]
                heads = np.flatnonzero(np.append(True, first[a + 1: b] != first[a: b - 1]))
                yield _rows(int(own[a]), [
                    first[a:b][heads], np.diff(np.append(heads, b - a)).astype(np.uint32), second[a:b].astype(narrow),
                    sizes[a:b].astype(np.uint32), thirds[c:d].astype(narrow), seen[c:d].astype(np.uint32)],
                    ["firsts", "first_sizes", "seconds", "second_sizes", "thirds", "counts"])

    def code(levels: list[Level], part: int, rows: list[tuple]) -> pa.RecordBatch:
        def column(k: int, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(r[k], kind) for r in rows])

        firsts, first = _ranks(np.repeat(column(0, np.int64), column(1, np.uint32)))
        seconds, second = _ranks(column(2, narrow))
        pairs, pair = _ranks(first << _U(32) | second)
        thirds, third = _ranks(column(4, narrow))
        keys, seen = summed(np.repeat(pair, column(3, np.uint32)) << _U(32) | third, column(5, np.uint32))
        rows.clear()
        del pair, third, first, second
        parent, name = (keys >> _U(32)).astype(np.int64), thirds[(keys & _U(0xFFFFFFFF)).astype(np.int64)].astype(np.int64)
        mass = np.add.reduceat(seen, np.searchsorted(parent, np.arange(len(pairs))))
        first = firsts[(pairs >> _U(32)).astype(np.int64)]
        second = seconds[(pairs & _U(0xFFFFFFFF)).astype(np.int64)].astype(np.int64)

        low, high = int(first[0]), int(first[-1])
        totals = levels[0].arrays["counts"][low: high + 1].astype(np.float64)
        keep = (mass >= least[0]) & (second < known)
        # Triples behind pairs with a node, by the pair's place among these.
        inner = keep[parent] & (seen >= least[1]) & (name < known)
        place = (np.cumsum(keep) - 1)[parent[inner]]
        mass, first, second = mass[keep].astype(np.float64), first[keep], second[keep]
        seen, name = seen[inner] - DISCOUNT, name[inner]
        spent = np.bincount(first - low, mass - DISCOUNT, high - low + 1)
        left = 1 - np.bincount(place, seen, len(mass)) / mass
        facts = {"part": part, "size": len(first), "low": low, "parents": high - low + 1, "first_spent": float(spent[0]), "last_spent": float(spent[-1])}
        return _part_row(facts, _successors("heads", "nodes", high - low + 1, first - low, second)
                         | _successors("thirds_heads", "thirds", len(first), place, name), {
            "spent": spent, "chances": quantised(np.log10((mass - DISCOUNT) / totals[first - low])),
            "backs": quantised(np.log10(np.maximum(left, 1e-16))), "thirds_chances": quantised(np.log10(seen / mass[place]))})

    rows = texts.mapInArrow(run, "part bigint, firsts binary, first_sizes binary, seconds binary, second_sizes binary, thirds binary, counts binary")
    return _by_part(rows, parts, [words], code)


def _successors(heads: str, nodes: str, parents: int, parent: np.ndarray, name: np.ndarray) -> dict[str, np.ndarray]:
    """Pointers of all parents, and names ordered by parent with the last value of the group before added."""
    pointers = np.searchsorted(parent, np.arange(parents + 1))
    sizes = np.diff(pointers)
    sizes, ends = sizes[sizes > 0], pointers[1:][sizes > 0] - 1
    base = np.repeat(np.concatenate([[0], np.cumsum(name[ends])[:-1]]), sizes) if len(ends) else np.zeros(0)
    return {heads: pointers, nodes: base.astype(np.uint64) + name.astype(np.uint64)}


@dataclass
class Model:
    """A trained model: its levels as shipped files, where its parts begin, and what add-one needs."""

    levels: list[Files]
    edges: np.ndarray
    words: int
    train_tokens: int


def train(texts: DataFrame, text_col: str = "text", min_counts: tuple[int, int, int] = MIN_COUNTS, part_tokens: int = PART_TOKENS) -> Model:
    """Count words, pairs and triples of all texts and code them as a trie; ``part_tokens`` bounds what a task holds."""
    texts = texts.select(F.col(text_col).cast("string").alias("text"))
    parts = max(4, texts.rdd.getNumPartitions())
    coded = _with_missing(_counted_words(texts, parts, min_counts[0]), parts)
    facts = coded.agg(F.sum("size"), F.sum("total")).first()
    words, total = int(facts[0] or 0), int(facts[1] or 0)
    model = Model([_shipped(coded)], np.zeros((0, 2), np.int64), words, total)
    if not total:
        return model
    parts = -(-total // part_tokens)
    model.edges = edges = _edges(texts, model.levels[0], parts)
    model.levels.append(_shipped(_with_missing(_counted_triples(texts, parts, model.levels[0], words, edges, min_counts[1:]), parts)))
    return model


def _with_missing(coded: DataFrame, parts: int) -> DataFrame:
    """With empty rows for parts that have none, so that parts are known by their number."""
    there = {r.part for r in coded.select("part").collect()}
    missing = [(k,) for k in range(parts) if k not in there]
    if not missing:
        return coded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                yield _part_row({"part": part}, {s: nothing for s in _SEQUENCES}, {})

    rows = coded.sparkSession.createDataFrame(missing, "part bigint").mapInArrow(run, _PART_SCHEMA)
    return settled(coded.unionByName(rows))


def token_scores(levels: list[Level], model: Model, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Add-one log10 probability, whether known, and the model's log10 probability of each token."""
    divisor = model.train_tokens + model.words + 1.0
    if not model.train_tokens:
        base = np.full(len(hashes), np.log10(1 / divisor))
        return base, np.zeros(len(hashes), bool), base
    distinct, word = _ranks(hashes)
    number, counts = levels[0].words(distinct)
    counts = counts.astype(np.float64)
    there = number >= 0
    known, single = there[word], (counts + 1) / divisor
    chance = single[word]
    base = np.log10(chance)
    left = np.ones(len(distinct))
    left[there] = 1 - levels[1].spent(model.edges, number[there]) / counts[there]
    # Shorter contexts first; each longer one adds its own share to what it leaves.
    inside = np.ones(len(hashes), bool)
    inside[rows[:-1]] = False
    after = np.flatnonzero(inside)
    after = after[known[after - 1]]
    chance[after] *= left[word[after - 1]]
    both = after[known[after]]
    pairs, pair = _ranks(word[both - 1] << _U(32) | word[both])
    part, place, share, back = levels[1].pairs(
        model.edges, number[(pairs >> _U(32)).astype(np.int64)], number[(pairs & _U(0xFFFFFFFF)).astype(np.int64)])
    pair = pair.astype(np.int64)
    chance[both] += share[pair]
    node = np.full(len(hashes), -1, np.int64)
    node[both] = np.where(place[pair] >= 0, pair, -1)
    third = after[node[after - 1] >= 0]
    chance[third] *= back[node[third - 1]]
    third = third[known[third]]
    triples, triple = _ranks(node[third - 1].astype(np.uint64) << _U(32) | word[third])
    parent = (triples >> _U(32)).astype(np.int64)
    shares = levels[1].triples(part[parent], place[parent], number[(triples & _U(0xFFFFFFFF)).astype(np.int64)])
    chance[third] += shares[triple.astype(np.int64)]
    return base, known, np.log10(chance)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _levels(model.levels)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for low, high in chunks(offsets, _SCORED_BYTES):
                hashes, rows = tokens(data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low])
                base, known, scores = token_scores(levels, model, hashes, rows)
                count = high - low
                sums = [np.add.reduceat(v, rows[:-1]) for v in (base, scores)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, count), pa.array(np.diff(rows)), pa.array(np.add.reduceat(known.astype(np.int64), rows[:-1])),
                    pa.array(np.full(count, model.train_tokens)), pa.array(sums[0]), pa.array(sums[1])],
                    names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    fields = f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return narrow.mapInArrow(run, fields).withColumnRenamed("id", id_col)
