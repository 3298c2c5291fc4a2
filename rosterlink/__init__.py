"""Record linkage for event registrants on Spark DataFrames."""

from .functions.rules import classify_by_rules, classify_company, classify_position, column_classifier
from .operators.classify import classify_by_catalogue
from .operators.enrich import (
    enrich_audience,
    filter_audience,
    match_counts,
    match_stats,
    unmatched_names,
    write_audience,
)
from .operators.index import ContactIndex
from .operators.match import fuzzy_match
from .operators.normalize import (
    build_contacts,
    normalize_congress,
    normalize_connections,
    normalize_registrants,
)
from .sources.files import load_congress_list, load_linkedin_connections, load_registrants

__all__ = [
    "ContactIndex",
    "build_contacts",
    "classify_by_catalogue",
    "classify_by_rules",
    "classify_company",
    "classify_position",
    "column_classifier",
    "enrich_audience",
    "filter_audience",
    "fuzzy_match",
    "load_congress_list",
    "load_linkedin_connections",
    "load_registrants",
    "match_counts",
    "match_stats",
    "normalize_congress",
    "normalize_connections",
    "normalize_registrants",
    "unmatched_names",
    "write_audience",
]
