"""The gram index: few keys for any name, no lost pair, bounds that hold, hot names."""

import random

import pytest
from brute import lcs, scan
from pyspark.sql import functions as F
from test_match_exact import check, frames, people, twisted

from rosterlink.operators import grams as G
from rosterlink.operators import keys as K
from rosterlink.operators import match as M
from rosterlink.operators.index import ContactIndex, Fresh

MANY = ["DE LA CRUZ VANDERMEULEN JEAN PAUL MARIE DU PONT X", "A B C D E F G H I J", "x" * 46, "ab " * 40, " ".join(f"T{i}" for i in range(40)),
        "DUPONT, Jean", "", " ", "é", "a  b", "word " * 200]


def sides(spark, wanted, known):
    registrants, contacts = frames(spark, wanted, known)
    return (K.with_tokens(registrants.select(F.col("Name").alias("name"))),
            K.with_tokens(contacts.select(F.col("Name").alias("name"), "contact_pos")))


@pytest.mark.parametrize("share", [0.95, 0.9, 0.8, 0.7])
def test_a_name_has_a_few_hundred_keys_at_most(spark, share):
    names, _ = sides(spark, MANY, [])
    order = G.Order(names.select(G.padded_grams(F.array_join("words", " "))))
    counts = {r["name"]: r["n"] for r in G.similar_keys(names, share, order).groupBy("name").agg(F.count("*").alias("n")).collect()}
    # Of each text of a name: pairs of its first grams, or the grams themselves.
    assert counts.keys() == set(MANY)
    assert all(n <= 2 * (276 + G.MOST_PAIRED) or n <= 2 * (len(name) + 1) for name, n in counts.items())
    assert all(n <= 300 for name, n in counts.items() if len(name) <= 50)
    tokens = G._all_tokens(names).groupBy("name").count().collect()
    assert max(r["count"] for r in tokens) <= 300


@pytest.mark.parametrize("share", [0.95, 0.9, 0.8, 0.68])
def test_similar_texts_always_meet_and_bounds_hold(spark, share):
    rng = random.Random(int(share * 100))
    known = people(rng, 60) + ["", "a", "ab", "abc", "é", " a", "  ", "ab " * 30, "abcdefghij" * 7]
    wanted = twisted(rng, rng.choices(known, k=80)) + known
    left, right = sides(spark, sorted(set(wanted)), known)
    met = {(r["name"], r["contact_name"]): r["most"] for r in
           G.similar_pairs(left, right, share).groupBy("name", "contact_name").agg(F.max("most").alias("most")).collect()}
    for a in set(wanted):
        for b in set(known):
            for one, two in ((a, b), (" ".join(sorted(a.split())), " ".join(sorted(b.split())))):
                total = len(one) + len(two)
                ratio = 2 * lcs(one, two) / total if total else 1.0
                if ratio >= share:
                    assert (a, b) in met, (a, b)
                    assert met[(a, b)] >= 100 * ratio - 1e-6, (a, b)


def test_hot_surnames_and_hot_first_names(spark):
    """A third of the contacts share a surname, another third a first name."""
    rng = random.Random(9)
    parts = ["BA", "LO", "MIR", "TEN", "DOU", "VAR", "CHEL", "PIN"]
    some = lambda n: "".join(rng.choice(parts) for _ in range(n))
    known = [f"VANDERMEULEN, {some(2).title()}" for _ in range(50)] + [f"{some(3)}, Marie-Claude" for _ in range(50)]
    known += [f"{some(3)}, {some(2).title()}" for _ in range(50)]
    wanted = twisted(rng, rng.choices(known, k=60)) + ["VANDERMEULEN, Marie-Claude", "Marie-Claude", "VANDERMEULEN"]
    check(spark, wanted, known, 90)


def test_scores_that_are_known_spare_candidates(spark):
    rng = random.Random(4)
    known = people(rng, 150)
    # Tokens in another order: covered, 95 for sure.
    wanted = [" ".join(reversed(n.split())) for n in known[:60]]
    left, right = sides(spark, sorted(set(wanted) - set(known)), [])[0], sides(spark, [], known)[1]
    side = M._Sides.__new__(M._Sides)
    side.wanted, side.contacts, side.cutoff, side.share, side.kept = left, right, 75.0, 0.75, Fresh()
    found = M._best(M._covered(side))
    pairs = G.similar_pairs(left, right, 0.75)
    everything, spared = M.worth_scoring(pairs, None), M.worth_scoring(pairs, found)
    assert spared.count() < everything.count() / 2
    plan = spared._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    expected = scan(wanted, known, 75)
    assert {r["name"] for r in found.where("score >= 94.9").collect()} <= expected.keys()


def exchanged_files(plan):
    """Paths of the tables that are scanned below an exchange."""
    found = set()

    def walk(node, below):
        name = node.nodeName()
        if name.startswith(("Exchange", "BroadcastExchange")):
            below = True
        if below and name.startswith("Scan"):
            found.add(node.toString())
        for child in (node.children().apply(i) for i in range(node.children().size())):
            walk(child, below)

    walk(plan, False)
    return found


@pytest.mark.parametrize("cutoff", [95, 90, 80])
def test_index_of_contacts_is_used_again(spark, cutoff):
    rng = random.Random(cutoff)
    known = people(rng, 60) + [None, "", " ", "Jean", "ab " * 30]
    _, contacts = frames(spark, [], known)
    index = ContactIndex(contacts, buckets=4)
    tables = None
    for _ in range(2):
        wanted = twisted(rng, rng.choices(known[:60], k=40)) + [None, "", "Jean"]
        registrants, _ = frames(spark, wanted, [])
        rows = M.best_contacts(registrants, index, cutoff).collect()
        got = {r["name"]: (round(r["score"], 6), r["contact_pos"]) for r in rows}
        assert got == {n: (round(s, 6), p) for n, (s, p) in scan(wanted, known, cutoff).items()}
        tables, before = dict(index._tables), tables
    assert tables == before
    index.drop()


def test_second_match_does_not_exchange_the_indexed_keys(spark):
    rng = random.Random(1)
    known = people(rng, 60)
    _, contacts = frames(spark, [], known)
    index = ContactIndex(contacts, buckets=4)
    registrants, _ = frames(spark, twisted(rng, known), [])
    M.best_contacts(registrants, index, 90).count()
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        side = M._Sides(registrants.where("Name <> ''").selectExpr("Name AS name").distinct(), None, 90.0, index)
        for found in (G.similar_pairs(side.wanted, side.contacts, 0.9, index), G.covered_pairs(side.wanted, side.contacts, 94.8, index)):
            plan = found._jdf.queryExecution().executedPlan()
            moved = exchanged_files(plan)
            assert moved and not any(index.prefix in scan for scan in moved), moved
            assert index.prefix in plan.toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    index.drop()
