"""Byte-level BPE by prefix dynamic programming.

Every byte prefix of a piece has exactly one token that can stand last in its
encoding. The table ``last`` keeps that token for each prefix; the encoding is
read backwards from the end. A token may follow another one if merging the two
by rank would leave the border between them alone, which depends on the two
tokens only. So bytes can be appended exactly, and after an edit only the
prefixes near it change.

``encode`` splits texts with the usual pattern (contractions, runs of letters,
digits, other signs, each with a space before, and white space), found with
NumPy for whole chunks, and encodes each distinct piece of a chunk once.
Special tokens are ordinary text. Null texts are empty, texts without bytes
give no ids; equal rows give equal ids; other columns are left out of the
result, so their names cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks, code_values, ragged, span_hashes, text_buffers

# Distinct pieces a worker remembers, in each of two generations.
REMEMBERED = 200_000
_CHUNK_BYTES = 1 << 20
# Longer pieces are encoded one by one, and not remembered.
_TOGETHER = 64

# Classes of code points: 0 white space, 1 letters, 2 digits, 3 the rest.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASSES = regex.compile(r"(?P<s>\s)|(?P<l>\p{L})|(?P<n>\p{N})")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number in each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Vocabulary:
    """Tokens by rank with the two parts each was merged from.

    The parts of a token are found by encoding its bytes with lower ranks
    only; tokens without parts (single bytes, or never reached by merging)
    are their own part.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.parts: dict[int, tuple[int, int]] = {}
        self._known: dict[int, bool] = {}
        self._reached: set[int] = set()
        for rank in sorted(self.tokens):
            self._take_apart(rank)
        self._flatten()
        size = max(self.tokens, default=-1) + 1
        self.lengths = np.array([len(self.tokens.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.blob = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), np.uint8)

    def _flatten(self) -> None:
        """The tree of all token bytes: (node, byte) to node, as a table and as sorted arrays."""
        tree: dict[int, int] = {}
        ends = {0: -1}
        for rank in self._reached:
            node = 0
            for byte in self.tokens[rank]:
                node = tree.setdefault(node << 8 | byte, len(tree) + 1)
            ends[node] = rank
        self._tree, self._ends = tree, [ends.get(node, -1) for node in range(len(tree) + 1)]
        self._edges = np.array(sorted(tree), np.int64)
        self._targets = np.array([tree[e] for e in self._edges.tolist()], np.int64)
        self._token_at = np.array(self._ends, np.int64)
        self._seen, self._seen_fit = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def _take_apart(self, rank: int) -> None:
        token = self.tokens[rank]
        if len(token) == 1:
            self._reached.add(rank)
            return
        for cut in range(1, len(token)):
            left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
            if (left is not None and right is not None and left < rank and right < rank
                    and left in self._reached and right in self._reached and self._border(left, right, rank)):
                self.parts[rank] = (left, right)
                self._reached.add(rank)
                return

    def _border(self, left: int, right: int, before: int) -> bool:
        """Whether the border between two tokens outlives every merge ranked below ``before``.

        Undo the latest merge of either side, again and again; had the tokens
        beside the border merged earlier than that, the border would be gone.
        """
        tokens, ranks, parts = self.tokens, self.ranks, self.parts
        while True:
            merged = ranks.get(tokens[left] + tokens[right])
            if merged is not None and merged < before and merged in self._reached:
                return False
            # Of two merges equal in rank, the left one is done first.
            if left in parts and (right not in parts or left > right):
                before, left = left, parts[left][1]
            elif right in parts:
                before, right = right + 1, parts[right][0]
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left``."""
        return self._border(left, right, 1 << 62)

    def extend(self, data: bytes, first: int, last: list[int], done: int) -> None:
        """Fill ``last`` behind its first ``done`` prefixes, from starts at ``first`` on.

        From each start all tokens are followed through a tree of their bytes;
        one that may follow the last token before it is the last of its prefix.
        """
        tree, ends, known, border, size = self._tree, self._ends, self._known, self._border, len(data)
        for start in range(first, size):
            left, node, end = last[start], 0, start
            while end < size:
                node = tree.get(node << 8 | data[end])
                if node is None:
                    break
                end += 1
                token = ends[node]
                if token >= 0 and end > done and last[end] < 0:
                    if start:
                        key = left << 24 | token
                        fit = known.get(key)
                        if fit is None:
                            if len(known) >= 200_000:
                                known.clear()
                            fit = known[key] = border(left, token, 1 << 62)
                        if not fit:
                            continue
                    last[end] = token

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else PrefixEncoding(self, piece).ids()

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece: the same programme for all pieces at once, start by start."""
        found: list[bytes | None] = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[i] = _packed([whole])
            elif len(piece) > _TOGETHER:
                found[i] = _packed(self.encode(piece))
            else:
                rest.append(i)
        if rest:
            rest.sort(key=lambda i: -len(pieces[i]))
            for i, ids in zip(rest, self._together([pieces[i] for i in rest])):
                found[i] = ids
        return found

    def _together(self, pieces: list[bytes]) -> list[bytes]:
        """``encode_many`` for short pieces, longest first."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        bytes_at = np.cumsum(lengths) - lengths
        last_at = bytes_at + np.arange(len(pieces))
        last = np.full(len(data) + len(pieces), -1, np.int64)
        longer = [int(np.searchsorted(-lengths, -k, "left")) for k in range(int(lengths[0]) + 1)]
        for start in range(int(lengths[0])):
            left = last[last_at[: longer[start]] + start]
            word, end = np.arange(longer[start]), start
            node = np.zeros(len(word), np.int64)
            while end < lengths[0] and len(word):
                few = int(np.searchsorted(word, longer[end]))
                word, node = word[:few], node[:few]
                key = node << 8 | data[bytes_at[word] + end]
                place = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
                on = self._edges[place] == key
                word, node = word[on], self._targets[place[on]]
                end += 1
                token = self._token_at[node]
                new = np.flatnonzero((token >= 0) & (last[last_at[word] + end] < 0))
                if start:
                    new = new[self._fit_all(left[word[new]], token[new])]
                last[last_at[word[new]] + end] = token[new]
        left, word, step = lengths.copy(), np.arange(len(pieces)), int(lengths[0])
        table = np.zeros((len(pieces), step), "<u4")
        counts = np.zeros(len(pieces), np.int64)
        while len(word):
            step -= 1
            token = last[last_at[word] + left[word]]
            table[word, step] = token
            counts[word] += 1
            left[word] -= self.lengths[token]
            word = word[left[word] > 0]
        width = table.shape[1]
        # Every piece was filled from the right end of its row.
        return [row[width - n:].tobytes() for row, n in zip(table, counts.tolist())]

    def _fit_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``fits`` for arrays, through a table of fixed size."""
        keys = left << 24 | right
        slots = (keys * 0x9E3779B1 >> 11) & (len(self._seen) - 1)
        fit = self._seen_fit[slots]
        unknown = np.flatnonzero(self._seen[slots] != keys)
        if len(unknown):
            values, place = np.unique(keys[unknown], return_inverse=True)
            answers = np.array([self.fits(k >> 24, k & 0xFFFFFF) for k in values.tolist()], bool)
            fit[unknown] = answers[place]
            slots = (values * 0x9E3779B1 >> 11) & (len(self._seen) - 1)
            # One pair for each slot, or key and answer could come from two pairs.
            slots, one = np.unique(slots, return_index=True)
            self._seen[slots], self._seen_fit[slots] = values[one], answers[one]
        return fit


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class PrefixEncoding:
    """The last tokens of all prefixes of some bytes, kept for appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        done = len(self.data)
        self.data += more
        self.last.extend([-1] * len(more))
        self.vocabulary.extend(self.data, max(0, done + 1 - self.vocabulary.longest), self.last, done)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of ``[start, end)``; returns how many prefixes were encoded anew.

        Behind the edit, once as many neighbouring prefixes as the longest
        token has bytes end as before, all later ones do too.
        """
        old, longest, shift = self.last, self.vocabulary.longest, len(new) - (end - start)
        data = self.data[:start] + new + self.data[end:]
        self.data, self.last = data[:start], old[: start + 1]
        upto = start
        while upto < len(data):
            upto = min(len(data), max(start + len(new), upto) + 2 * longest)
            self.append(data[len(self.data): upto])
            behind = upto - longest
            if behind > start + len(new) and self.last[behind + 1:] == old[behind + 1 - shift: upto + 1 - shift]:
                self.data, self.last = data, self.last + old[upto + 1 - shift:]
                break
        return upto - start

    def ids(self) -> list[int]:
        at, found = len(self.data), []
        while at:
            found.append(self.last[at])
            at -= len(self.vocabulary.tokens[found[-1]])
        return found[::-1]


def _class_table() -> np.ndarray:
    table = np.full(65536, _OTHER, np.uint8)
    for code in range(65536):
        match = None if 0xD800 <= code < 0xE000 else _CLASSES.match(chr(code))
        if match:
            table[code] = "sln".index(match.lastgroup)
    return table


_TABLE: list[np.ndarray] = []


def code_classes(codes: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_class_table())
    classes = _TABLE[0][np.minimum(codes, 65535)]
    far = codes > 65535
    if far.any():
        values, place = np.unique(codes[far], return_inverse=True)
        kinds = [_CLASSES.match(chr(v)) for v in values.tolist()]
        classes[far] = np.array(["sln".index(m.lastgroup) if m else _OTHER for m in kinds], np.uint8)[place]
    return classes


def piece_starts(codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions where a piece starts; ``rows`` are the offsets of the texts in ``codes``."""
    size = len(codes)
    if not size:
        return np.zeros(0, np.int64)
    classes = code_classes(codes)
    edge = np.zeros(size + 1, bool)
    edge[rows] = True
    edge[size] = True
    change = np.ones(size + 1, bool)
    change[1:size] = classes[1:] != classes[:-1]
    run = change | edge
    start = run.copy()
    # White space before something else: its last character stands apart, and a plain space joins what follows.
    follows = np.flatnonzero(run[1:size] & ~edge[1:size] & (classes[:-1] == _SPACE)) + 1
    start[follows - 1] = True
    start[follows[codes[follows - 1] == 0x20]] = False
    # An apostrophe alone before letters: contractions.
    quote = np.flatnonzero((codes == 0x27) & start[:size] & run[:size])
    quote = quote[quote + 1 < size]
    quote = quote[(classes[quote + 1] == _LETTER) & ~edge[quote + 1]]
    first = codes[quote + 1]
    third = np.where((quote + 2 < size) & ~edge[np.minimum(quote + 2, size)], codes[np.minimum(quote + 2, size - 1)], 0)
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = np.zeros(len(quote), bool)
    for pair in ("re", "ve", "ll"):
        long |= (first == ord(pair[0])) & (third == ord(pair[1]))
    for found, length in ((quote[short], 2), (quote[long], 3)):
        start[found + 1] = False
        start[found + length] = True
    return np.flatnonzero(start[:size])


class _Encoder:
    """Encodes chunks of texts; remembers recent pieces in two generations."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.young: dict[int, bytes] = {}
        self.old: dict[int, bytes] = {}

    def pieces(self, values: list[int], starts: list[int], ends: list[int], text: str) -> list[bytes]:
        """Packed ids of distinct pieces of ``text``, known by their hashes."""
        young, old = self.young, self.old
        packed = [young.get(v) or old.get(v) for v in values]
        new = [i for i, p in enumerate(packed) if p is None]
        for i, ids in zip(new, self.vocabulary.encode_many([text[starts[i]: ends[i]].encode() for i in new])):
            packed[i] = ids
        if len(young) >= REMEMBERED:
            self.old, self.young = young, {}
        self.young.update((v, p) for v, p in zip(values, packed) if len(p) <= _TOGETHER)
        return packed

    def chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` and the offsets of the texts in them."""
        joined = "".join(texts)
        rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = piece_starts(codes, rows)
        ends = np.append(starts[1:], len(codes))
        values = span_hashes(code_values(codes), starts, ends)
        values, first, place = np.unique(values, return_index=True, return_inverse=True)
        packed = self.pieces(values.tolist(), starts[first].tolist(), ends[first].tolist(), joined)
        lengths = np.array([len(p) // 4 for p in packed], np.int64)
        flat = np.frombuffer(b"".join(packed), "<u4")
        each = lengths[place]
        ids = flat[ragged((np.cumsum(lengths) - lengths)[place], each)]
        upto = np.concatenate([[0], np.cumsum(each)])
        return ids, upto[np.searchsorted(starts, rows)]

    def exact(self, text: str) -> np.ndarray:
        """As ``chunk`` for one text, without the hashes of pieces."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = piece_starts(codes, np.array([0, len(codes)])).tolist()
        pieces = [text[a:b].encode() for a, b in zip(starts, [*starts[1:], len(text)])]
        return np.frombuffer(b"".join(self.vocabulary.encode_many(pieces)), "<u4")


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """The bytes of the tokens, one after another."""
    return vocabulary.blob[ragged(vocabulary.starts[ids], vocabulary.lengths[ids])]


_VOCABULARIES: dict[int, Vocabulary] = {}


def _vocabulary(ranks) -> Vocabulary:
    """Built once in each worker."""
    key = hash(frozenset(ranks.value.items()))
    if key not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[key] = Vocabulary(ranks.value)
    return _VOCABULARIES[key]


def encode(
    docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", decoded: bool = False,
) -> DataFrame:
    """One row per text: the id column, ``n_tokens`` and ``ids``, its ids as little-endian 32-bit integers.

    With ``decoded``, also the bytes that the ids stand for, from the same task.
    Each chunk is decoded again and compared with its bytes, so a collision of
    piece hashes is found and such texts are encoded piece by piece.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    names = ["id", "n_tokens", "ids", *["decoded"] * decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        encoder = _Encoder(vocabulary)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for low, high in chunks(offsets, _CHUNK_BYTES):
                raw = data[offsets[low]: offsets[high]].tobytes()
                cuts = (offsets[low: high + 1] - offsets[low]).tolist()
                parts = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
                texts = [p.decode("utf-8", "replace") for p in parts]
                ids, rows = encoder.chunk(texts)
                rows = rows.tolist()
                packed = [ids[a:b].tobytes() for a, b in zip(rows, rows[1:])]
                if decode_ids(vocabulary, ids).tobytes() != raw:
                    packed = [encoder.exact(t).tobytes() for t in texts]
                columns = [batch.column(0).slice(low, high - low), pa.array([len(p) // 4 for p in packed], pa.int64()),
                           pa.array(packed, pa.binary())]
                if decoded:
                    back = [decode_ids(vocabulary, np.frombuffer(p, "<u4")).tobytes() for p in packed]
                    columns.append(pa.array(back, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    fields = f"id {kind}, n_tokens bigint, ids binary" + ", decoded binary" * decoded
    return narrow.mapInArrow(run, fields).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """Replace ``ids_col`` by ``decoded``, the bytes of its tokens; null ids give no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    kept = [c for c in encoded.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            packed = batch.column(len(kept)).to_pylist()
            texts = [decode_ids(vocabulary, np.frombuffer(p or b"", "<u4")).tobytes() for p in packed]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(kept))), pa.array(texts, pa.binary())], names=[*kept, "decoded"])

    fields = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept)
    return encoded.select(*[F.col(f"`{c}`") for c in kept], ids_col).mapInArrow(
        run, f"{fields}, decoded binary" if fields else "decoded binary")
