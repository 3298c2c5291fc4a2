"""Delimited text files over many tasks, quoted line breaks included.

Spark's text source cuts a file into blocks at line ends; tasks pack the lines
of a block into chunks. Whether a chunk begins inside a quoted field depends
on all chunks before it, so every chunk is scanned for both beginnings. One
small row for each chunk then tells, file by file, which beginning was the
true one, where the first record of the chunk starts, and which chunk gets the
lines before it. Encoding and separator are settled in the same step.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import settled
from .decode import ENCODINGS, NULL_TEXTS, SEPARATORS

# Lines searched for the header below a preamble.
PREAMBLE_LINES = 10
CHUNK_BYTES = 4 << 20

_CHUNK = (
    "file string, block bigint, chunk bigint, body binary, header binary, separator int, wide boolean, utf8 boolean, cp1252 boolean, "
    "ends_outside array<boolean>, ends_inside array<boolean>, leads array<bigint>"
)
_PLACE = ["file", "block", "chunk"]
_CLOSE = re.compile(rb'(?:[^"]|"")*+"')
_LINE_END = re.compile(rb"\r\n?|\n")
_BLANK_LINES = re.compile(rb"(?:[ \t]*(?:\r\n?|\n))*")


def _opening(separator: str) -> re.Pattern:
    """A quote where a field starts: only there does it quote."""
    pattern = re.escape(separator) if len(separator) == 1 else separator
    return re.compile(rb'(?:\A|[\r\n]|%s)"' % pattern.encode())


def quote_scan(text: bytes, inside: bool, opening: re.Pattern) -> tuple[bool, int]:
    """Whether ``text``, begun inside a quoted field or not, ends inside one, and the end of its first whole line.

    A line is whole where its line break is not quoted; without one, -1.
    """
    at, first = 0, -1
    while True:
        if inside:
            close = _CLOSE.match(text, at)
            if close is None:
                return True, first
            at = close.end()
        # A quote right after a closed field is text: it follows no separator.
        found = opening.search(text, at)
        until = found.end() - 1 if found else len(text)
        if first < 0:
            end = _LINE_END.search(text, at, until)
            first = end.end() if end else -1
        if found is None:
            return False, first
        at, inside = found.end(), True


def _read_csv(text: str, separator: str, rows: int | None = None) -> pd.DataFrame:
    return pd.read_csv(
        io.StringIO(text), sep=separator, dtype=str, na_values=sorted(NULL_TEXTS), keep_default_na=False, nrows=rows)


def _is_wide(text: bytes, separator: str) -> bool:
    """Whether the first row has more fields than the header, so that pandas takes the first ones as an index."""
    try:
        return not isinstance(_read_csv(text.decode("latin-1"), separator).index, pd.RangeIndex)
    except ValueError:
        return False


def _decodes(text: bytes, encoding: str) -> bool:
    try:
        text.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _chunk(file: str, block: int, number: int, text: bytes, mark: str | None, separators: tuple[str, ...]) -> dict:
    row = {"file": file, "block": block, "chunk": number, "header": None, "separator": None, "wide": None,
           "utf8": _decodes(text, "utf-8"), "cp1252": _decodes(text, "cp1252")}
    openings = [_opening(s) for s in separators]
    if block == 0 and number == 0:
        text = text.removeprefix(b"\xef\xbb\xbf")
        shown = next((e for e in ENCODINGS if _decodes(text, e)), ENCODINGS[-1])
        starts = [0, *(end.end() for end in islice(_LINE_END.finditer(text), PREAMBLE_LINES))]
        early = [text[a:b].decode(shown) for a, b in zip(starts, starts[1:])]
        skip = next((a for a, line in zip(starts, early) if mark and mark in line), None)
        text = text[_BLANK_LINES.match(text).end() if skip is None else skip:]
        # Of equally frequent separators the first counts.
        line = text[:_LINE_END.search(text).end()] if text else b""
        row["separator"] = max(range(len(separators)), key=lambda i: line.count(separators[i].encode()))
        end = quote_scan(text, False, openings[row["separator"]])[1]
        row["header"], text = (text[:end], text[end:]) if end >= 0 else (text, b"")
        first_row = text[:quote_scan(text, False, openings[row["separator"]])[1]]
        row["wide"] = _is_wide(row["header"] + first_row, separators[row["separator"]])
    inside = [quote_scan(text, True, o) for o in openings]
    row["body"], row["leads"] = text, [lead for _, lead in inside]
    row["ends_outside"], row["ends_inside"] = [quote_scan(text, False, o)[0] for o in openings], [end for end, _ in inside]
    return row


def text_chunks(lines: DataFrame, mark: str | None, separators: tuple[str, ...], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Lines (``value``, ``file``, ``block``) as Spark reads them, packed into chunks that know both beginnings."""
    schema = pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("body", pa.binary()), ("header", pa.binary()),
        ("separator", pa.int32()), ("wide", pa.bool_()), ("utf8", pa.bool_()), ("cp1252", pa.bool_()), ("ends_outside", pa.list_(pa.bool_())),
        ("ends_inside", pa.list_(pa.bool_())), ("leads", pa.list_(pa.int64())),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, held, size = None, 0, [], 0

        def packed() -> pa.RecordBatch:
            row = _chunk(*place, number, b"\n".join(held) + b"\n", mark, separators)
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("value").to_pylist()
            files = batch.column("file").dictionary_encode()
            names, which = files.dictionary.to_pylist(), files.indices.to_numpy()
            blocks = batch.column("block").to_numpy()
            turns = np.flatnonzero((which[1:] != which[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for start, stop in zip([0, *turns], [*turns, len(values)]):
                here = (names[which[start]], int(blocks[start]))
                if here != place:
                    if held:
                        yield packed()
                    place, number, held, size = here, 0, [], 0
                for value in values[start:stop]:
                    held.append(value)
                    size += len(value) + 1
                    if size >= chunk_bytes:
                        yield packed()
                        number, held, size = number + 1, [], 0
        if held:
            yield packed()

    return lines.mapInArrow(pack, _CHUNK)


def _settle_file(separators: tuple[str, ...]):
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        """The chunks of one file, without their texts, in order."""
        rows = rows.sort_values(["block", "chunk"]).reset_index(drop=True)
        first = rows.iloc[0]
        encoding = "utf-8" if rows["utf8"].all() else "cp1252" if rows["cp1252"].all() else "latin-1"
        which, problem, columns = int(first["separator"] or 0), None, []
        header = (first["header"] or b"").decode(encoding)
        try:
            columns = [str(c) for c in _read_csv(header, separators[which], 0).columns]
        except ValueError as error:
            problem = str(error)
        state, holder = False, (0, 0)
        cuts, blocks, chunks = [], [], []
        for place, outside, inside, leads in zip(
            zip(rows["block"], rows["chunk"]), rows["ends_outside"], rows["ends_inside"], rows["leads"]
        ):
            blocks.append(holder[0])
            chunks.append(holder[1])
            # -1: the whole chunk goes on with the record that an earlier one began.
            cuts.append(int(leads[which]) if state else 0)
            if not state or leads[which] >= 0:
                holder = place
            state = bool((inside if state else outside)[which])
        if state and problem is None:
            problem = "a quoted field has no end"
        count = len(rows)
        return pd.DataFrame({
            "file": rows["file"], "block": rows["block"], "chunk": rows["chunk"], "cut": cuts, "to_block": blocks,
            "to_chunk": chunks, "encoding": [encoding] * count, "sep": [separators[which]] * count,
            "head": [header] * count, "wide": [bool(first["wide"])] * count, "columns": [columns if i == 0 else None for i in range(count)],
            "problem": [problem] * count,
        })

    return settle


def placed_chunks(chunks: DataFrame, separators: tuple[str, ...]) -> DataFrame:
    """For each chunk where its first record starts, who gets the bytes before it, and what its file is written in."""
    facts = chunks.drop("body")
    return settled(facts.groupBy("file").applyInPandas(
        _settle_file(separators),
        "file string, block bigint, chunk bigint, cut bigint, to_block bigint, to_chunk bigint, encoding string, sep string, "
        "head string, wide boolean, columns array<string>, problem string",
    ))


def whole_records(chunks: DataFrame, places: DataFrame) -> DataFrame:
    """Chunks as ``text`` that begins and ends with whole records."""
    joined = chunks.select(*_PLACE, "body").join(places.drop("columns", "problem"), _PLACE)
    length = F.when(F.col("cut") < 0, F.length("body")).otherwise(F.col("cut")).cast("int")
    moved = joined.where(F.col("cut") != 0).select(
        "file", F.col("to_block"), F.col("to_chunk"),
        F.struct("block", "chunk", F.substring("body", F.lit(1), length).alias("part")).alias("piece"),
    )
    tails = moved.groupBy("file", F.col("to_block").alias("block"), F.col("to_chunk").alias("chunk")).agg(
        F.aggregate(F.array_sort(F.collect_list("piece")), F.lit(b""), lambda done, x: F.concat(done, x["part"])).alias("tail"))
    own = joined.where(F.col("cut") >= 0).withColumn(
        "body", F.substring("body", F.col("cut").cast("int") + 1, F.length("body")))
    return own.join(tails, _PLACE, "left").select(
        *_PLACE, F.concat("body", F.coalesce("tail", F.lit(b""))).alias("body"), "encoding", "sep", "head", "wide")


def chunk_rows(file: str, body: bytes, encoding: str, sep: str, head: str, wide: bool) -> pd.DataFrame:
    """The rows of a chunk; all chunks of a file must have as many fields as its first row lets them."""
    rows = _read_csv(head + body.decode(encoding), sep)
    if len(rows) and wide == isinstance(rows.index, pd.RangeIndex):
        raise ValueError(f"{file!r}: rows differ in their number of fields")
    return rows
