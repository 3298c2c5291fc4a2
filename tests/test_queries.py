import pytest
from sql_check import compare

import __spark_entry__ as entry
from rosterlink.plans.checks import CHECKS
from rosterlink.plans.queries import QUERIES

QUICK = [name for name in CHECKS
         if not name.startswith(("fuzzy", "enrich", "filter", "match_counts", "unmatched"))]


@pytest.mark.parametrize("name", [*QUICK, "fuzzy_match_exact", "filter_audience"])
def test_query_equals_sql(spark, name):
    assert compare(spark, "/root/testdata/sf0.001", name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
