"""String helpers that behave like Python's ``str`` methods, as Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point for which ``str.isspace`` is true.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java character class.
WHITESPACE_CLASS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITESPACE) + "]"


def as_column(value: Column | str) -> Column:
    return F.col(f"`{value}`") if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` and its lambdas name it."""
    return F.transform(F.array(value), body).getItem(0)


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda ch: ch != "")


def strip(value: Column | str) -> Column:
    """Drop Unicode whitespace on both ends."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def is_blank(value: Column | str) -> Column:
    """True for null, empty and whitespace-only text."""
    column = as_column(value)
    return column.isNull() | (strip(column) == "")


def person_name(last: Column | str, first: Column | str) -> Column:
    """``LASTNAME, Firstname``; null as soon as one part is null."""
    return F.concat(strip(F.upper(as_column(last))), F.lit(", "), strip(first))


def tokens(value: Column | str) -> Column:
    """Whitespace-separated tokens, sorted, repeats kept."""
    parts = F.split(as_column(value), WHITESPACE_CLASS + "+", -1)
    return F.array_sort(F.filter(parts, lambda part: part != ""))


def category_or_blank(value: Column | str, category: Column) -> Column:
    return F.when(is_blank(value), F.lit("")).otherwise(category)
