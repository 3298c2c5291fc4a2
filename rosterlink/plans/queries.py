"""Named queries over the benchmark tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import catalogue, rules
from ..functions import similarity as S
from ..functions.text import person_name, strip
from ..operators import enrich as E
from ..operators import normalize as N
from ..operators.classify import classify_by_catalogue
from ..operators.match import fuzzy_match
from . import people

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.build_contacts(
        N.normalize_connections(people.connections_raw(spark, sf_dir)),
        N.normalize_congress(people.congress_raw(spark, sf_dir)),
    )


def registrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_registrants(people.registrants_raw(spark, sf_dir))


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pair per order: the customer's name and that of a registrant or a shorter form."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    own, other = F.col("o_custkey"), F.col("o_orderkey")
    last, first = people.registrant_parts(own)
    kinds = [
        person_name(last, first),
        person_name(people.last_name(other), people.first_name(own)),
        F.concat(first, F.lit(" "), F.upper(people.last_name(own)), F.lit(",")),
        F.upper(F.substring(people.last_name(own), 1, 6)),
    ]
    right = kinds[-1]
    for i, kind in enumerate(kinds[:-1]):
        right = F.when(other % len(kinds) == i, kind).otherwise(right)
    left = person_name(people.last_name(own), people.first_name(own))
    return orders.select(F.col("o_orderkey").alias("pair"), left.alias("a"), right.alias("b"))


def _score_query(score: Callable[[str, str], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pairs = name_pairs(spark, sf_dir)
        return pairs.select("pair", F.round(score("a", "b"), DIGITS).alias("score"))

    return query


def _match_query(cutoff: float) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        matched = fuzzy_match(registrants(spark, sf_dir), contacts(spark, sf_dir), cutoff)
        return matched.withColumn("Score", F.round("Score", DIGITS))

    return query


def _audience(spark: SparkSession, sf_dir: str, join_on: str = "name", classified: bool = True) -> DataFrame:
    classifiers = (rules.classify_position, rules.classify_company) if classified else (None, None)
    return E.enrich_audience(
        registrants(spark, sf_dir), contacts(spark, sf_dir), 90.0, *classifiers, join_on=join_on
    )


def _filter_query(positions: list[str] | None, companies: list[str] | None) -> Query:
    return lambda spark, sf_dir: E.filter_audience(_audience(spark, sf_dir), positions, companies)


DECISION_MAKERS = ["Directeur", "Manager"]
INSURERS = ["Assurance", "Réassurance"]


def _build_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = people.registrants_raw(spark, sf_dir)
    return raw.select("Email", person_name("Nom", "Prénom").alias("Name"))


def _strip_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = people.registrants_raw(spark, sf_dir)
    return raw.select("Email", strip("Nom").alias("stripped"))


def _classify(column: str, classifier: Callable[[str], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = people.connections_raw(spark, sf_dir)
        return raw.select("source_row", F.col(column), classifier(column).alias("category"))

    return query


def _classify_company_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company classifier with its catalogue as a table that is joined."""
    raw = people.connections_raw(spark, sf_dir).select("source_row", "Company")
    known = [(i, category, name) for i, (category, names) in enumerate(catalogue.KNOWN_COMPANIES) for name in names]
    table = spark.createDataFrame(known, "priority int, category string, name string")
    return classify_by_catalogue(raw, "Company", table, patterns=rules.word_patterns(catalogue.COMPANY_WORDS),
                                 default=catalogue.COMPANY_DEFAULT, name="category")


def _match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.match_counts(registrants(spark, sf_dir), _audience(spark, sf_dir, classified=False))


def _unmatched_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.unmatched_names(registrants(spark, sf_dir), _audience(spark, sf_dir, classified=False))


QUERIES: dict[str, Query] = {
    "build_name": _build_name,
    "strip_unicode": _strip_unicode,
    "registrants_fr": registrants,
    "registrants_en": lambda s, d: N.normalize_registrants(people.registrants_raw(s, d, french=False)),
    "connections_normalize": lambda s, d: N.normalize_connections(people.connections_raw(s, d)),
    "congress_normalize": lambda s, d: N.normalize_congress(people.congress_raw(s, d)),
    "build_contacts": contacts,
    "ratio": _score_query(S.ratio),
    "token_sort_ratio": _score_query(S.token_sort_ratio),
    "token_set_ratio": _score_query(S.token_set_ratio),
    "token_ratio": _score_query(S.token_ratio),
    "partial_ratio": _score_query(S.partial_ratio),
    "partial_token_ratio": _score_query(S.partial_token_ratio),
    "weighted_ratio": _score_query(S.weighted_ratio),
    "fuzzy_match_exact": _match_query(100.0),
    "fuzzy_match_95": _match_query(95.0),
    "fuzzy_match_90": _match_query(90.0),
    "fuzzy_match_80": _match_query(80.0),
    "enrich_by_name": lambda s, d: _audience(s, d, classified=False),
    "enrich_by_position": lambda s, d: _audience(s, d, "position", classified=False),
    "enrich_classified": _audience,
    "classify_position": _classify("Position", rules.classify_position),
    "classify_company": _classify("Company", rules.classify_company),
    "classify_company_joined": _classify_company_joined,
    "match_counts": _match_counts,
    "unmatched_names": _unmatched_names,
    "filter_none": _filter_query(None, None),
    "filter_position": _filter_query(DECISION_MAKERS, None),
    "filter_company": _filter_query(None, INSURERS),
    "filter_audience": _filter_query(DECISION_MAKERS, INSURERS),
}
