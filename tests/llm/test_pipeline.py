"""The pipeline's stages, one after another, on a small table."""

import random

import corpus_pipeline
import pytest
from test_texts import plain_sets, roots

from rosterlink.store import settled

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(settled(stage(spark, tables[-1], SMALL)))
    return tables


def test_columns_and_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "source_mix", "byte_bpe"]
    for table in steps[1:-1]:
        assert table.columns == steps[0].columns


def test_decisions_take_effect(steps):
    docs, known, lined, single, mixed, encoded = ([r.asDict() for r in t.collect()] for t in steps)
    assert len(known) >= 0.98 * len(docs) and len(lined) == len(known)
    assert sum(r["n_chars"] for r in lined) < sum(r["n_chars"] for r in known)
    assert all(r["n_chars"] == len(r["text"]) for r in lined)
    ids = [r["doc_id"] for r in single]
    assert len(set(ids)) == len(ids) < len(lined)
    texts = [" ".join(r["text"].lower().split()) for r in single if r["text"].split()]
    assert len(set(texts)) == len(texts)
    assert {r["doc_id"] for r in mixed} <= set(ids) and max(map([r["doc_id"] for r in mixed].count, ids)) <= 3
    assert sorted(r["doc_id"] for r in encoded) == sorted(r["doc_id"] for r in mixed)


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "the of and thing that was here", "en", "a", 30),
            (3, "the of and thing that was here", "en", "a", 30), (4, "12 34", None, "b", 5), (5, "der und die das ist ein Haus", "de", "b", 29)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.where("1 = 0")):
        for _, stage in corpus_pipeline.STAGES:
            table = settled(stage(spark, table, SMALL))
        table.collect()


def plain_least(texts, size=5, percent=80):
    """Ids of the least documents of all groups, from all pairs."""
    sets = plain_sets(texts, size)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i for i, least in roots(links, sets).items() if i == least}


def test_near_copies_with_tails_and_cuts(spark):
    """Tails and cuts around the least similarity: alike at five words and 0.8, many of them not at three words and 0.9."""
    draw, texts = random.Random(3), {}
    for i in range(12):
        words = [f"w{draw.randrange(4000)}" for _ in range(100)]
        tail = [f"t{draw.randrange(4000)}" for _ in range(40)]
        for text in (words, words + tail[: 5 + 3 * i], words[: 97 - 3 * i]):
            texts[len(texts)] = " ".join(text)
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()}
    assert kept == plain_least(texts) and kept != plain_least(texts, 3, 90) and len(kept) > 12
