"""One file over many tasks gives what a reader of the whole file gives."""

import csv
import io
import random

import pandas as pd
import pytest

from rosterlink.sources import files, split
from rosterlink.sources.decode import NULL_TEXTS


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cell(draw):
    return "".join(draw.choice(["a", "é", " ", '"', ",", ";", "\n", "\r\n", '""', "x" * 40]) for _ in range(draw.randrange(6)))


def made(draw, sep, end, rows):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=sep, lineterminator=end)
    writer.writerow(["First Name", "Last\nName", "Note"])
    writer.writerows([f"r{i}", cell(draw), cell(draw)] for i in range(rows))
    # Quotes inside unquoted fields are text.
    return out.getvalue() + f'z{sep}5" disk{sep}b"b"{end}' * 3


def whole(text, sep):
    frame = pd.read_csv(io.StringIO(text), sep=sep, dtype=str, na_values=sorted(NULL_TEXTS), keep_default_na=False)
    return [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]


@pytest.mark.parametrize("seed,sep,end,encoding,chunk_bytes", [
    (1, ",", "\n", "utf-8-sig", 150), (2, ";", "\r\n", "cp1252", 4 << 20), (3, "\t", "\n", "latin-1", 100),
])
def test_blocks_equal_the_whole_file(spark, tmp_path, small_blocks, seed, sep, end, encoding, chunk_bytes):
    draw = random.Random(seed)
    texts = [made(draw, sep, end, 120), made(draw, sep, end, 5)]
    if encoding == "latin-1":
        texts[0] += f"last{sep}\x81{sep}é{end}"  # no character of cp1252, and only in the last block
    for name, text in zip(("a b.csv", "é.csv"), texts):
        (tmp_path / name).write_bytes(text.encode(encoding))
    found = files.list_files(spark, str(tmp_path), "*.csv")
    got = files.read_rows(found, chunk_bytes=chunk_bytes).orderBy("source_row").collect()
    assert [tuple(r)[:3] for r in got] == whole(texts[0], sep) + whole(texts[1], sep)
    assert [r.source_row for r in got] == list(range(len(got)))
    blocks = found.read("text", lineSep="\n").selectExpr("_metadata.file_path", "_metadata.file_block_start").distinct()
    assert blocks.count() > 10


def test_long_quoted_field_spans_blocks(spark, tmp_path, small_blocks):
    text = 'A,B\n1,"' + "line\n" * 500 + '"\n2,b\n'
    (tmp_path / "f.csv").write_text(text)
    got = files.read_rows(files.list_files(spark, str(tmp_path / "f.csv")), chunk_bytes=64).orderBy("source_row").collect()
    assert [tuple(r)[:2] for r in got] == [("1", "line\n" * 500), ("2", "b")]


@pytest.mark.parametrize("content,rows", [
    ("A,B\r1,2\r3,4\r", [("1", "2"), ("3", "4")]),
    ("\n  \nA,B\n\n1,2\n\n", [("1", "2")]),
    ("A,B", []),
    ("A,B\n1,2", [("1", "2")]),
])
def test_odd_files(spark, tmp_path, content, rows):
    (tmp_path / "f.csv").write_text(content, newline="")
    got = files.read_rows(files.list_files(spark, str(tmp_path / "f.csv"))).orderBy("source_row").collect()
    assert [tuple(r)[:2] for r in got] == rows


@pytest.mark.parametrize("content,error", [
    ("", FileNotFoundError), ("\n\n", ValueError), ('A,B\n1,"2\n3,4\n', ValueError),
])
def test_faulty_files(spark, tmp_path, content, error):
    (tmp_path / "f.csv").write_text(content)
    with pytest.raises(error):
        files.read_rows(files.list_files(spark, str(tmp_path / "f.csv")))


def test_scan_of_both_beginnings():
    opening = split._opening(",")
    assert split.quote_scan(b'a,"b\n', False, opening) == (True, -1)
    assert split.quote_scan(b'x""y"\nz\n', True, opening) == (False, 6)
    assert split.quote_scan(b'x",5" d,"q\nr"\ns\n', True, opening) == (False, 14)
    assert split.quote_scan(b'5" disk\n', False, opening) == (False, 8)
    assert split.quote_scan(b"no end\n", True, opening) == (True, -1)
