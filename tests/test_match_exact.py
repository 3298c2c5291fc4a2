"""The blocked match against a full scan, on names made to be hard."""

import random

import pytest
from brute import scan

from rosterlink.operators.match import best_contacts, fuzzy_match

FIRST = ["Jean", "Marie", "Jean-Paul", "Anne", "Zoé", "Li", "O", "Anne Marie", "Éléonore", "B"]


def typo(rng, name):
    chars = list(name)
    for _ in range(rng.choice([0, 1, 1, 2, 3])):
        at = rng.randrange(len(chars) + 1)
        kind = rng.random()
        if kind < 0.4 and chars:
            chars.pop(min(at, len(chars) - 1))
        elif kind < 0.7:
            chars.insert(at, rng.choice("abXé ,-"))
        elif chars:
            chars[min(at, len(chars) - 1)] = rng.choice("abXé ,")
    return "".join(chars)


def people(rng, count):
    parts = ["DU", "PONT", "MAR", "TIN", "VAN", "DER", "BERG", "LE", "É", "AB", "A", "QUE"]
    out = []
    for _ in range(count):
        last = "".join(rng.choice(parts) for _ in range(rng.choice([1, 1, 2, 2, 3, 3, 4, 6])))
        if rng.random() < 0.25:
            last += " " + rng.choice(parts)
        out.append(f"{last}, {rng.choice(FIRST)}")
    return out


def twisted(rng, names):
    out = []
    for name in names:
        kind = rng.random()
        words = name.split()
        if kind < 0.15:
            rng.shuffle(words)
            name = " ".join(words)
        elif kind < 0.25:
            name = " ".join([*words, rng.choice(["B", "C", "Jr", "Jean"])])
        elif kind < 0.32:
            name = " ".join([*words, rng.choice(words)])
        elif kind < 0.40:
            name = name[rng.randrange(len(name) // 2 + 1):]
        elif kind < 0.45:
            name = "  ".join(words) + " "
        elif kind < 0.50:
            name = " ".join([*words, *words, "x"])
        out.append(typo(rng, name))
    return out


def frames(spark, wanted, known):
    registrants = spark.createDataFrame([(n,) for n in wanted], "Name string")
    contacts = spark.createDataFrame([(n, i) for i, n in enumerate(known)], "Name string, contact_pos bigint")
    return registrants, contacts


def check(spark, wanted, known, cutoff):
    registrants, contacts = frames(spark, wanted, known)
    rows = best_contacts(registrants, contacts, cutoff).collect()
    got = {r["name"]: (round(r["score"], 6), r["contact_pos"]) for r in rows}
    assert len(got) == len(rows)
    expected = {n: (round(s, 6), p) for n, (s, p) in scan(wanted, known, cutoff).items()}
    wrong = {n: (got.get(n), expected.get(n)) for n in got.keys() | expected.keys() if got.get(n) != expected.get(n)}
    assert not wrong, dict(list(wrong.items())[:5])


@pytest.mark.parametrize("cutoff", [95, 90])
def test_strict_cutoffs_equal_full_scan(spark, cutoff):
    rng = random.Random(cutoff)
    known = people(rng, 130)
    wanted = twisted(rng, rng.choices(known, k=120)) + people(rng, 20)
    known += twisted(rng, rng.choices(known, k=80)) + [None, "", " ", "  ", "Jean", ", Jean", "A", known[3]]
    wanted += [None, "", "  ", "Jean", "B"]
    check(spark, wanted, known, cutoff)


@pytest.mark.parametrize("cutoff", [80, 55])
def test_loose_cutoffs_equal_full_scan(spark, cutoff):
    rng = random.Random(cutoff)
    known = people(rng, 45)
    wanted = twisted(rng, rng.choices(known, k=30)) + people(rng, 8)
    known += twisted(rng, rng.choices(known, k=15)) + [None, "", " ", "  ", "Jean", "Q"]
    wanted += [None, "", "  ", "Jean", "ZZZZZ"]
    check(spark, wanted, known, cutoff)


def test_cutoff_zero_matches_every_name(spark):
    registrants, contacts = frames(spark, ["zzz", "DUPONT, Jean", "", None], [None, "QQ", "DUPONT, Jean"])
    rows = {r["Name registrant"]: (r["Name fuzzy matched"], r["Score"], r["Index"])
            for r in fuzzy_match(registrants, contacts, 0).collect()}
    assert rows == {
        "zzz": ("QQ", 0.0, 1), "DUPONT, Jean": ("DUPONT, Jean", 100.0, 2), "": ("QQ", 0.0, 1),
        None: (None, None, None),
    }


def test_long_and_many_token_names(spark):
    rng = random.Random(5)
    known = [" ".join(rng.choice(["DE", "LA", "CRUZ", "VANDERMEULEN", "JEAN", "ÉLÉONORE", "SAINT"]) + str(rng.randrange(3))
                      for _ in range(rng.choice([5, 8, 12]))) for _ in range(40)]
    wanted = twisted(rng, known)
    check(spark, wanted, known + known[3:5], 90)
