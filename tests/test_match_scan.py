"""The scan by signatures: it stands in for keys where those meet more often than there are pairs, and loses none."""

import random

import pytest
from brute import lcs
from pyspark.sql import functions as F
from test_match_exact import check, people, twisted
from test_match_index import sides

from rosterlink.functions import similarity as S
from rosterlink.operators import grams as G
from rosterlink.operators import match as M
from rosterlink.operators import scan

PARTS = ["BA", "LO", "MIR", "TEN", "DOU", "VAR", "CHEL", "PIN", "GRO", "SAU", "LER", "QUIN", "FA", "BRE", "ZOL", "NEV", "HU", "TRI", "JAC", "MOR"]


def syllables(rng, count):
    return sorted({"".join(rng.choice(PARTS) for _ in range(4)) + ", " + rng.choice(["Jean", "Marie", "Luc", "Anne"]) for _ in range(count)})


@pytest.mark.parametrize("share", [0.95, 0.9, 0.8, 0.68])
def test_similar_texts_and_windows_are_among_the_candidates(spark, share):
    rng = random.Random(int(share * 100))
    known = people(rng, 60) + ["a", "ab", "abc", "é", " a", "  ", "ab " * 30, "abcdefghij" * 7]
    wanted = sorted(set(twisted(rng, rng.choices(known, k=80)) + known) - {""})
    left, right = sides(spark, wanted, known)
    met = {(r["name"], r["contact_name"]): r["most"] for r in scan.scanned_pairs(left, right, share, share).groupBy(
        "name", "contact_name").agg(F.max("most").alias("most")).collect()}
    for a in wanted:
        for b in set(known):
            for one, two in ((a, b), (" ".join(sorted(a.split())), " ".join(sorted(b.split())))):
                total = len(one) + len(two)
                ratio = 2 * lcs(one, two) / total if total else 1.0
                if ratio >= share:
                    assert met.get((a, b), 0) >= 100 * ratio - 1e-6, (a, b)
            if S.PARTIAL_FROM <= max(len(a), len(b)) / min(len(a), len(b)) <= S.FAR_FROM:
                score = max(S.partial_scores([a], [b])[0], S.partial_scores([" ".join(sorted(a.split()))], [" ".join(sorted(b.split()))])[0]
                            if a.split() and b.split() else 0.0)
                if score >= 100 * share:
                    assert met.get((a, b), 0) >= S.PARTIAL_WEIGHT * score - 1e-6, (a, b)


@pytest.mark.parametrize("cutoff", [95, 90, 80])
def test_keys_and_scan_equal_the_full_scan(spark, monkeypatch, cutoff):
    rng = random.Random(cutoff + 1)
    known = people(rng, 60) + syllables(rng, 40)
    wanted = twisted(rng, rng.choices(known, k=60)) + syllables(rng, 20) + ["Jean", "  "]
    check(spark, wanted, known, cutoff)
    monkeypatch.setattr(scan, "BLOCK", 7)
    check(spark, wanted, known, cutoff)
    monkeypatch.setattr(scan, "MOST_SCANNED", -1)
    check(spark, wanted, known, cutoff)


def test_keys_that_name_the_lengths_meet_seldom(spark):
    rng = random.Random(3)
    left, right = sides(spark, syllables(rng, 400), syllables(rng, 400))
    order = G.Order(right.select(G.padded_grams(F.array_join("words", " "))))
    met = G.similar_keys(left, 0.9, order).select("level", "key").join(
        G.similar_keys(right, 0.9, order, mirrored=True).select("level", "key"), ["level", "key"])
    pairs = left.count() * right.count()
    assert met.count() < pairs / 5


def test_names_of_syllables_are_not_joined_by_keys(spark):
    rng = random.Random(4)
    names, _ = sides(spark, syllables(rng, 300), [])
    contacts = spark.createDataFrame([(n, i) for i, n in enumerate(syllables(rng, 300))], "name string, contact_pos bigint")
    for cutoff in (90.0, 80.0):
        plan = M._strict_matches if cutoff >= 90 else M._loose_matches
        found = plan(names.select("name"), contacts, cutoff, M.Fresh())
        assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()
