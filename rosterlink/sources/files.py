"""People-list files as DataFrames.

Text files of any size are cut by Spark's text source and read by many tasks
(see ``split``); workbooks, whose sheets are bounded by their format, are read
by Spark's ``binaryFile`` source, one in a task.  Headers fix the schema and
show missing columns before any row is made.  All columns are strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.normalize import (
    CONGRESS_COLUMNS,
    CONNECTION_COLUMNS,
    SOURCE_ROW,
    normalize_congress,
    normalize_connections,
    normalize_registrants,
    quoted,
)
from ..store import settled
from .decode import SEPARATORS, workbook_chunks
from .split import CHUNK_BYTES, chunk_rows, placed_chunks, text_chunks, whole_records

CONGRESS_SHEET = "Résumé"


_WORKBOOK = r"(?i).*\.xlsx?"


@dataclass
class Files:
    """Files of a path or glob: their ``path``, and ``file`` as Spark's metadata names it."""

    found: DataFrame
    path: str
    pattern: str | None
    only: str | None = None

    def read(self, kind: str, **options: str) -> DataFrame:
        """The files by one of Spark's sources; left-out files are pruned by their metadata."""
        reader = self.found.sparkSession.read.format(kind).options(**options)
        if self.pattern is not None:
            reader = reader.option("pathGlobFilter", self.pattern)
        df = reader.load(self.path)
        return df if self.only is None else df.where(F.col("_metadata.file_path") == self.only)


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> Files:
    """Files of a path or glob, without their contents; none is an error. Spark passes over files of no bytes."""
    files = Files(spark.range(0).toDF("path"), path, pattern)
    try:
        files.found = files.read("binaryFile").select("path", F.col("_metadata.file_path").alias("file"))
        empty = files.found.isEmpty()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        empty = True
    if empty:
        raise FileNotFoundError(f"No file found: {path!r}" + (f" with pattern {pattern!r}" if pattern else ""))
    return files


def first_file(files: Files) -> Files:
    """Only the file whose path sorts first."""
    first = files.found.agg(F.min_by("file", "path")).first()[0]
    return replace(files, found=files.found.where(F.col("file") == first), only=first)


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores added until no column is called so."""
    taken, found = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        found.append(name)
        taken.add(name.lower())
    return found


def _workbook_headers(books: DataFrame, sheet_name: str | None) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                columns, problem = [], None
                try:
                    for chunk in workbook_chunks(content, sheet_name, rows=1):
                        columns = [str(c) for c in chunk.columns]
                except ValueError as error:  # unreadable file or no such sheet
                    problem = str(error)
                yield pd.DataFrame({"file": [file], "columns": [columns], "problem": [problem]})

    return books.mapInPandas(read, "file string, columns array<string>, problem string")


def _union_columns(headers: DataFrame) -> list[str]:
    """Columns of all files in order of first appearance; one row per column reaches the driver."""
    places = headers.select("path", F.posexplode("columns").alias("place", "column"))
    firsts = places.groupBy("column").agg(F.min(F.struct("path", "place")).alias("first"))
    return [row["column"] for row in firsts.orderBy("first").collect()]


def _by_position(rows: DataFrame, found: DataFrame, place: list[str]) -> DataFrame:
    """Rows numbered by file path, chunk and line; no row moves by range, as chunks tell how many they hold."""
    file, block, chunk, line = place
    counts = settled(rows.groupBy(file, block, chunk).agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy(file).agg(F.sum("n").alias("n")).join(found.select(F.col("file").alias(file), "path"), file)
    # One row for each file here, one for each chunk of a file below.
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(file, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(file).orderBy(block, chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("n", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, file)
    base = offsets.select(file, block, chunk, (F.col("start") + F.col("n")).alias("_base"))
    return rows.join(base.withColumnRenamed("_base", line + "_base"), [file, block, chunk]).withColumn(
        line, F.col(line) + F.col(line + "_base")).drop(line + "_base")


def read_rows(
    files: Files,
    required: tuple[str, ...] = (),
    header_mark: str | None = None,
    sheet_name: str | None = None,
    missing_error: type[Exception] = ValueError,
    sep: str | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """All rows of the files, columns united, with their position as ``source_row``.

    Without ``sep`` the most frequent of ``,``, ``;`` and tab in the header separates.
    Text is read from its place once and kept in the shared folder as chunks of
    ``chunk_bytes``; a quoted field that never ends is an error.
    """
    separators = (sep,) if sep else SEPARATORS
    name = F.col("_metadata.file_name")
    lines = files.read("text", lineSep="\n").where(~name.rlike(f"^{_WORKBOOK}$")).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    chunks = settled(text_chunks(lines, header_mark, separators, chunk_bytes))
    places = placed_chunks(chunks, separators)
    books = files.read("binaryFile").where(name.rlike(f"^{_WORKBOOK}$")).select(
        F.col("_metadata.file_path").alias("file"), "content")
    headers = places.where(F.col("columns").isNotNull()).select("file", "columns", "problem")
    headers = headers.unionByName(_workbook_headers(books, sheet_name))
    # One row for each file; written once, as three questions are asked about it.
    headers = settled(headers.join(files.found.select("file", "path"), "file"))
    broken = headers.where(F.col("problem").isNotNull()).first()
    if broken is not None:
        raise ValueError(f"{broken['path']!r}: {broken['problem']}")
    lacking = F.array_except(F.array(*map(F.lit, required)).cast("array<string>"), "columns")
    short = headers.where(F.size(lacking) > 0).select("path", lacking.alias("missing")).first()
    if short is not None:
        raise missing_error(f"Missing columns: {short['path']!r} is missing required columns: {short['missing']}")
    columns = _union_columns(headers)
    # Spark does not tell columns apart by case, so a later one that differs only there gets an underscore.
    named: list[str] = []
    for column in columns:
        named += free_names(named, column)
    place = free_names([*named, SOURCE_ROW], "_file", "_block", "_chunk", "_line")

    def shaped(rows: pd.DataFrame, file: str, block: int, chunk: int, line: int = 0) -> pd.DataFrame:
        rows = rows.reindex(columns=columns).astype(object)
        rows = rows.where(rows.notna(), None).reset_index(drop=True)
        rows.columns = named
        for key, value in zip(place, (file, block, chunk, range(line, line + len(rows)))):
            rows[key] = value
        return rows

    def read_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = chunk_rows(row.file, row.body, row.encoding, row.sep, row.head, row.wide)
                yield shaped(found, row.file, row.block, row.chunk)

    def read_books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                line = 0
                for rows in workbook_chunks(content, sheet_name):
                    yield shaped(rows, file, 0, 0, line)
                    line += len(rows)

    schema = StructType(
        [StructField(c, StringType()) for c in named] + [StructField(place[0], StringType())]
        + [StructField(c, LongType()) for c in place[1:]]
    )
    rows = whole_records(chunks, places).mapInPandas(read_chunks, schema).unionByName(books.mapInPandas(read_books, schema))
    placed = _by_position(settled(rows), files.found, place)
    return placed.select(*[quoted(c) for c in named if c != SOURCE_ROW], F.col(place[3]).alias(SOURCE_ROW))


def load_linkedin_connections(
    directory: str = ".", filename_pattern: str = "Connections*.csv", spark: SparkSession | None = None,
    sep: str | None = None,
) -> DataFrame:
    """All contact exports of a directory as one normalised, de-duplicated frame."""
    session = spark or SparkSession.active()
    files = list_files(session, directory, filename_pattern)
    raw = read_rows(files, CONNECTION_COLUMNS, header_mark=CONNECTION_COLUMNS[0], sep=sep)
    return normalize_connections(raw)


def load_congress_list(
    filepath: str, sheet_name: str = CONGRESS_SHEET, spark: SparkSession | None = None
) -> DataFrame:
    """The attendee list of a workbook sheet: ``Name, Position, Company``."""
    session = spark or SparkSession.active()
    raw = read_rows(
        list_files(session, filepath), CONGRESS_COLUMNS, sheet_name=sheet_name, missing_error=KeyError
    )
    return normalize_congress(raw)


def load_registrants(filepath: str, spark: SparkSession | None = None, sep: str | None = None) -> DataFrame:
    """The registration list of a file, or of the first file of a glob."""
    session = spark or SparkSession.active()
    return normalize_registrants(read_rows(first_file(list_files(session, filepath)), sep=sep))
