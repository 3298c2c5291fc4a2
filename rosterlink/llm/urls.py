"""URL filters: given host and path rules, and rules mined from labelled URLs.

A URL is a set of tokens: host labels, the first path segments, its ending,
query keys. FP-growth finds token combinations that are frequent with a label;
an association rule (tokens to label) stays if its confidence, lift and support
are high enough and no rule with fewer of its tokens is as sure. A URL finds
its rules through an inverted index from each rule's rarest token.

Each URL gives ``MOST_TOKENS`` tokens at most, so of combinations of up to
``MOST_ANTECEDENT`` tokens no more than a fixed number reach the minimum
support, whatever the input: the rules are small enough to be broadcast.

Null URLs and URLs without ``://`` have an empty host and path and no tokens;
no given rule fits them. URLs that no rule fits get the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.004, 0.8, 1.05
MOST_ANTECEDENT = 3
DEFAULT = "allow"

# Host labels from the right, path segments from the left, query keys from the left.
_HOST_LABELS, _SEGMENTS, _KEYS = 4, 3, 4
MOST_TOKENS = _HOST_LABELS + _SEGMENTS + _KEYS + 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    shape = "(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, shape, 1), _UPPER, _LOWER), F.regexp_extract(url, shape, 2)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest given rule that fits, and its verdict; null if none does.

    A rule such as ``("example.org/es/", "block")`` fits its host and all
    subdomains where the path starts with the rule's path.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Of rules equal in length the first given wins.
    for text, outcome in reversed(sorted(rules, key=lambda r: -len(r[0]))):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, outcome).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL; numbers are all one token."""
    host, path = host_and_path(url)
    plain = F.regexp_replace(F.translate(path, _UPPER, _LOWER), "[0-9]+", "#")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.slice(F.filter(F.split(plain, "/"), lambda x: x != ""), 1, _SEGMENTS)
    keys = F.slice(F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != ""), 1, _KEYS)
    ending = F.regexp_extract(plain, r"\.([a-z]+)$", 1)
    parts = [
        F.transform(F.slice(F.reverse(labels), 1, _HOST_LABELS), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(segments, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("key:"), x)),
        F.when(ending != "", F.array(F.concat(F.lit("end:"), ending))).otherwise(F.array().cast("array<string>")),
        F.when(path.endswith("/"), F.array(F.lit("end:/"))).otherwise(F.array().cast("array<string>")),
    ]
    return F.array_distinct(F.concat(*parts))


def mine_rules(
    labelled: DataFrame, url_col: str = "url", label_col: str = "label", min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT,
) -> list[tuple[tuple[str, ...], str, float, float]]:
    """Rules as ``(tokens, label, confidence, support)``, surest first."""
    items = labelled.where(F.col(label_col).isNotNull()).select(
        F.array_append(url_tokens(F.col(url_col)), F.concat(F.lit(_LABEL), F.col(label_col))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    kept = model.associationRules.where(
        F.element_at("consequent", 1).startswith(_LABEL) & (F.size("antecedent") <= MOST_ANTECEDENT)
        & ~F.exists("antecedent", lambda x: x.startswith(_LABEL)) & (F.col("lift") >= min_lift))
    found = [(tuple(sorted(r.antecedent)), r.consequent[0][len(_LABEL):], r.confidence, r.support) for r in kept.collect()]
    found.sort(key=lambda r: (len(r[0]), -r[2], -r[3], r[0], r[1]))
    # A rule is needed only if it is surer than every rule with fewer of its tokens.
    best: dict[tuple[frozenset, str], float] = {}
    rules = []
    for tokens, label, confidence, support in found:
        own = frozenset(tokens)
        smaller = (own - {t} for t in tokens)
        below = max((best.get((s, label), 0.0) for s in smaller), default=0.0)
        best[(own, label)] = max(confidence, below)
        if confidence > below:
            rules.append((tokens, label, confidence, support))
    return sorted(rules, key=lambda r: (-r[2], -r[3], len(r[0]), r[0], r[1]))


class RuleIndex:
    """Rules by their rarest token."""

    def __init__(self, rules: list[tuple[tuple[str, ...], str, float, float]]) -> None:
        uses: dict[str, int] = {}
        for tokens, *_ in rules:
            for token in tokens:
                uses[token] = uses.get(token, 0) + 1
        self.by_token: dict[str, list[tuple[int, frozenset, str]]] = {}
        for place, (tokens, label, *_) in enumerate(rules):
            rarest = min(tokens, key=lambda t: (uses[t], t))
            self.by_token.setdefault(rarest, []).append((place, frozenset(tokens), label))

    def verdict(self, tokens: list[str]) -> str | None:
        """Label of the surest rule whose tokens are all there."""
        own, best = set(tokens), None
        for token in own:
            for place, needed, label in self.by_token.get(token, ()):
                if best is not None and place >= best[0]:
                    break
                if needed <= own:
                    best = (place, label)
                    break
        return best[1] if best else None


def mined_verdict(spark, rules: list[tuple[tuple[str, ...], str, float, float]], tokens: Column, default: str = DEFAULT) -> Column:
    """Verdict of the mined rules for a column of tokens."""
    shared = spark.sparkContext.broadcast(rules)

    @F.pandas_udf("string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = RuleIndex(shared.value)
        for batch in batches:
            yield pd.Series([index.verdict([] if row is None else list(row)) for row in batch], dtype=object)

    return F.coalesce(judge(tokens), F.lit(default))


def judge_urls(
    pages: DataFrame, given: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
    labelled: DataFrame | None = None, default: str = DEFAULT, **thresholds: float,
) -> DataFrame:
    """The id column, ``host``, ``path``, ``rule``, ``verdict`` of every URL.

    The given rules decide first. Others follow the rules mined from
    ``labelled`` (``url``, ``label``), or from the URLs that given rules decide.
    """
    host, path = host_and_path(F.col(url_col))
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), given)
    named = named.withColumn("rule", rule).withColumn("given", verdict)
    if labelled is None:
        labelled = named.select("url", F.col("given").alias("label"))
    rules = mine_rules(labelled, **thresholds)
    mined = mined_verdict(pages.sparkSession, rules, url_tokens(F.col("url")), default)
    return named.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("given", mined).alias("verdict"))
