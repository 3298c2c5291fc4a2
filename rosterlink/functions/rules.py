"""Ordered text classifiers as lazy Columns.

A taxonomy has three passes, each ordered by priority: exact names, partial
names (either text contains the other) and patterns.  Every pass becomes
branches of one CASE expression, so a row is classified inside whole-stage
code generation, with no shuffle and no Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import catalogue
from .text import WHITESPACE_CLASS, as_column, category_or_blank, strip

Names = Sequence[tuple[str, Sequence[str]]]

# Joins known names into one literal for the "is part of a known name" test.
_BETWEEN = "\x00"


def word_patterns(words: Names, free: Mapping[str, Sequence[str]] | None = None) -> list[tuple[str, str]]:
    """One Java pattern per category: words between boundaries, or free parts."""
    patterns = []
    for category, alternatives in words:
        parts = [r"\b(?:" + "|".join(alternatives) + r")\b", *(free or {}).get(category, [])]
        text = "|".join(parts).replace(r"[\s\-]", "[" + WHITESPACE_CLASS[1:-1] + r"\-]")
        patterns.append((category, "(?iU)" + text.replace(r"\s", WHITESPACE_CLASS)))
    return patterns


def _shortest(names: Sequence[str]) -> list[str]:
    """Names that contain no other name: enough to test "contains a known name"."""
    return [n for n in names if not any(o != n and o in n for o in names)]


def _overlaps(text: Column, names: Sequence[str]) -> Column:
    contains_one = reduce(or_, [F.contains(text, F.lit(n)) for n in _shortest(names)])
    inside_one = F.contains(F.lit(_BETWEEN.join(names)), text) & ~F.contains(text, F.lit(_BETWEEN))
    return contains_one | inside_one


def column_classifier(function: Callable[[Column | str], Column]) -> Callable[[Column | str], Column]:
    """Mark a ``Column -> Column`` function so that it is not taken for a ``str -> str`` one."""
    function.works_on_columns = True
    return function


def classify_by_rules(
    value: Column | str,
    *,
    known: Names = (),
    patterns: Sequence[tuple[str, str]] = (),
    default: str,
) -> Column:
    """First hit among exact names, overlapping names and patterns.

    ``known`` holds lower-case names, compared with the trimmed lower-case
    text; ``patterns`` holds Java patterns searched in the text as it stands.
    Blank and null text gives ``""``.
    """
    text = as_column(value)
    folded = F.lower(strip(text))
    branches = [(folded.isin(list(names)), category) for category, names in known]
    branches += [(_overlaps(folded, names), category) for category, names in known]
    branches += [(text.rlike(pattern), category) for category, pattern in patterns]
    chain = F
    for condition, category in branches:
        chain = chain.when(condition, F.lit(category))
    category = chain.otherwise(F.lit(default)) if branches else F.lit(default)
    return category_or_blank(text, category)


@column_classifier
def classify_position(title: Column | str) -> Column:
    """Seniority category of a job title."""
    return classify_by_rules(
        title,
        patterns=word_patterns(catalogue.POSITION_WORDS, catalogue.POSITION_FREE),
        default=catalogue.POSITION_DEFAULT,
    )


@column_classifier
def classify_company(company: Column | str) -> Column:
    """Industry category of a company name."""
    return classify_by_rules(
        company,
        known=catalogue.KNOWN_COMPANIES,
        patterns=word_patterns(catalogue.COMPANY_WORDS),
        default=catalogue.COMPANY_DEFAULT,
    )


def python_classifier(function: Callable[[str], str]) -> Callable[[Column | str], Column]:
    """Wrap a plain ``str -> str`` function as a Column classifier.

    Runs over Arrow batches and calls the function once per distinct value of
    a batch.
    """

    def over_batch(values: pd.Series) -> pd.Series:
        return values.map({v: function(v) for v in values.dropna().unique()})

    udf = F.pandas_udf(over_batch, StringType())
    return lambda value: udf(as_column(value))


def apply_classifier(classifier: Callable, value: Column) -> Column:
    """Apply a Column classifier as it is, any other function through Arrow."""
    if getattr(classifier, "works_on_columns", False):
        return classifier(value)
    return python_classifier(classifier)(value)
