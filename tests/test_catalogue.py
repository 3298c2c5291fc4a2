"""A catalogue as a table against the same names as literals, and classifiers called once per value."""

import random

from pyspark.sql import functions as F

from rosterlink.functions import catalogue, rules
from rosterlink.operators import classify
from rosterlink.operators.enrich import add_categories


def companies(spark, count):
    rng = random.Random(2)
    known = [n for _, names in catalogue.KNOWN_COMPANIES for n in names]
    texts = [None, "", "  ", "a", "x", "AXA", " axa  ", "Discord", "école", "a\x00b", "ass", "zzzz", "é", "Bulb"]
    for _ in range(count):
        name = rng.choice(known)
        at = rng.randrange(len(name))
        texts.append(rng.choice([name.upper(), f"le {name} sa", name[at:], name[:at], name[at: at + 2], name.replace(" ", "", 1), "conseil " + name[at:]]))
    return spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "i int, `The Company` string, category string")


def test_table_equals_literals(spark):
    frame = companies(spark, 400)
    rows = [(i, c, n) for i, (c, names) in enumerate(catalogue.KNOWN_COMPANIES) for n in names] + [(0, "Assurance", ""), (0, None, "zzzz"), (0, "Assurance", None)]
    table = spark.createDataFrame(rows, "priority int, category string, name string")
    patterns = rules.word_patterns(catalogue.COMPANY_WORDS)
    joined = classify.classify_by_catalogue(frame, "The Company", table, patterns=patterns, default="Autre", name="category")
    assert joined.columns == ["i", "The Company", "category"]
    got = {r["i"]: r["category"] for r in joined.collect()}
    expected = {r["i"]: r["c"] for r in frame.select("i", rules.classify_company("The Company").alias("c")).collect()}
    assert got == expected


def test_a_large_catalogue_without_all_pairs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(3, 9)))
    names = [f"{word()} {word()} {i}" for i in range(100_000)]
    table = spark.createDataFrame([(i % 7, f"k{i % 7}", n) for i, n in enumerate(names)], "priority int, category string, name string")
    texts = [rng.choice(names) for _ in range(40)] + [rng.choice(names)[2:-1] for _ in range(40)] + [f"x {rng.choice(names)}y" for _ in range(40)]
    frame = spark.createDataFrame([(t,) for t in set(texts)], "text string")
    hits = classify.catalogue_hits(frame, table)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    exact = {}
    for i, n in enumerate(names):
        exact.setdefault(n, f"k{i % 7}")
    expected = {}
    for t in set(texts):
        found = [f"k{i % 7}" for i, n in enumerate(names) if t in n or n in t]
        expected[t] = exact.get(t) or min(found)
    assert {r["text"]: r["category"] for r in hits.collect()} == expected


def test_a_function_is_called_once_per_value(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting(text):
        calls.add(1)
        return text[:1].upper()

    frame = spark.createDataFrame([(i, None if i % 50 == 0 else f"title {i % 20}") for i in range(2000)], "i int, Position string").repartition(8)
    got = add_categories(frame, counting)
    assert {(r["i"], r["Category_position"]) for r in got.collect()} == {(i, "N" if i % 50 == 0 else "T") for i in range(2000)}
    assert calls.value == 21
    assert add_categories(frame.where("1 = 0"), counting).count() == 0
    assert got.where(F.col("Category_position") == "T").count() == 1960
