"""The operators on vectors and URLs against plain versions, with odd rows."""

import math
import random

import numpy as np
import pytest

from rosterlink.llm import neardup, topk, urls
from rosterlink.llm.components import components
from rosterlink.llm.queries import URL_RULES


def odd_vectors(seed=2, width=24, count=400):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    rows = [(centres[i % 12] + draw.normal(size=width) * (0.02 if i % 3 else 0.35)).astype(np.float32).tolist() for i in range(count)]
    rows += [rows[0]] * 40 + [[2 * x for x in rows[1]]] + [[-x for x in rows[2]]]
    nan, inf = float("nan"), float("inf")
    rows += [None, [], [0.0] * width, [nan] * width, [1.0, inf], [1.0, None], [1.0], [2.0, 0.0], [1e30] * width, [1e-30] * width]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, v, i % 4, "x") for i, v in enumerate(odd_vectors())]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, id string").repartition(5)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_near_duplicates(vectors, monkeypatch):
    monkeypatch.setattr(neardup, "TILE_ROWS", 32)
    monkeypatch.setattr(neardup, "GROUP_ROWS", 96)
    rows = {i: np.array(v, float) for i, v in enumerate(odd_vectors()) if usable(v) and any(v)}
    width = max(map(len, rows.values()))
    rows = {i: np.pad(v, (0, width - len(v))) for i, v in rows.items()}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in rows.items()}
    links = {i: [j for j in unit if i != j and unit[i] @ unit[j] >= 0.95] for i in unit}
    label = {i: i for i in range(len(odd_vectors()))}
    changed = True
    while changed:
        changed = False
        for i, others in links.items():
            least = min([label[i], *(label[j] for j in others)])
            changed, label[i] = changed or least != label[i], least
    got = {r.vec_id: r for r in neardup.near_duplicates(vectors).collect()}
    assert len(got) == len(label)
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (len(links.get(i, [])), label[i], label[i] == i), i
    assert sum(r.n_links for r in got.values()) > 1000
    assert neardup.near_duplicates(vectors.where("1 = 0")).count() == 0


def test_early_stop_loses_no_pair():
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(300, 40))
    rows[150:] = rows[:150] + draw.normal(size=(150, 40)) * 0.31
    ids, ones = np.arange(300), np.ones(300, int)
    axes = np.linalg.qr(draw.normal(size=(40, 40)))[0]
    own = neardup._Rows(ids, ones, rows, axes)
    i, j = neardup.linked_pairs(own, own, 0, 300, 0.95)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    assert set(zip(i, j)) == set(zip(*np.nonzero(np.einsum("ik,jk->ij", unit, unit) >= 0.95)))
    kept = neardup.forest(i, j)
    assert len(kept) < 300


def test_components(spark):
    draw = random.Random(4)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (None, 3)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in pairs:
        if a is not None:
            a, b = sorted((root(a), root(b)))
            label[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for n in label}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("shard_rows", [64, 10_000])
def test_top_k(vectors, shard_rows):
    rows = {i: [math.floor(1024 * x) for x in v] for i, v in enumerate(odd_vectors()) if usable(v)}
    hold = lambda s: min(max(s, -(2 ** 63)), 2 ** 63 - 1)
    rows = {i: [hold(x) for x in v] for i, v in rows.items()}
    expected = {}
    for q in (i for i in rows if i % 100 == 0):
        scored = sorted((-hold(sum(a * b for a, b in zip(rows[q], v))), i) for i, v in rows.items() if i != q)
        expected[q] = [(i, -s) for s, i in scored[:10]]
    got = {}
    for r in topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got == expected
    assert topk.top_k(vectors.where("1 = 0"), vectors).count() == 0


def test_index_stops_early_and_is_exact():
    draw = np.random.default_rng(0)
    rows = (draw.normal(size=(4000, 8)) ** 3 * 1000).astype(np.int64)
    index, stopped = topk.ImpactIndex(np.arange(4000), rows), 0
    for q in range(0, 4000, 97):
        ids, scores = index.search(q, rows[q], 10)
        exact = rows @ rows[q]
        order = [i for i in np.lexsort((np.arange(4000), -exact)) if i != q][:10]
        assert ids.tolist() == order and scores.tolist() == exact[order].tolist()
        stopped += index.possible(rows[q], 11)[1] < len(index.dims)
    assert stopped


def test_near_scores_of_large_components_keep_their_order():
    """Scores that floats of 64 bits cannot tell apart."""
    rows = np.array([[2 ** 59 + i] for i in range(60)], np.int64)
    ids, scores = topk.ImpactIndex(np.arange(60), rows).search(-1, np.array([1], np.int64), 5)
    assert ids.tolist() == [59, 58, 57, 56, 55] and scores.tolist() == [2 ** 59 + i for i in ids.tolist()]


def test_near_duplicates_with_other_ids(spark):
    rows = [(-5, [1.0, 0.0]), (-1, [1.0, 0.01]), (3, [0.0, 1.0]), (None, [1.0, 0.0]), (4, [0.0, 1.0])]
    small = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    found = neardup.near_duplicates(small)
    assert found.schema["vec_id"].dataType == found.schema["component_id"].dataType == small.schema["vec_id"].dataType
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()}
    assert got == {-5: (1, -5, True), -1: (1, -5, False), 3: (1, 3, True), 4: (1, 3, False), None: (0, None, True)}
    with pytest.raises(TypeError):
        neardup.near_duplicates(small.selectExpr("'a' AS vec_id", "embedding"))


URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG", "http://example.org/", "https://a.example.org/es/x?y=1#z",
    "http://notexample.org/es/x", "http://example.org/en/12", "x://com/fr/", "http://b.com/de/1", "http://b.com/fr/1?q#f",
    "http://b.net/de/1", "http://b.net/fr/1", "http://b.net/xx://yy/", "http://u@h:80/p/?a", "http://h.com?x=/de/", "http://h.com#/fr/",
    "http://b.com/de", "http://a\nb.com/de/", "://com/de/" + "k/" * 5000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in URL_RULES if (host == r[0].split("/")[0] or host.endswith("." + r[0].split("/")[0]))
            and path.startswith("/" + r[0].split("/", 1)[1])]
    best = max(fits, key=lambda r: len(r[0]), default=(None, None))
    return host, path, *best


def test_urls_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id bigint, url string, host string").repartition(3)
    rows = {r.page_id: r for r in urls.judge_urls(pages, URL_RULES).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), url
        assert rows[i].verdict == verdict if verdict else rows[i].verdict in ("allow", "block")
    assert urls.judge_urls(pages.where("1 = 0"), URL_RULES).count() == 0


def test_urls_mined_rules_against_counting(spark):
    draw = random.Random(6)
    made = [f"http://{draw.choice('abc')}.{draw.choice(['com', 'net'])}/{draw.choice(['de', 'fr', 'es'])}/{draw.choice(['x', 'y'])}{draw.randrange(9)}" for _ in range(600)]
    labelled = [(u, "block" if "/de/" in u and ".com" in u or "/es/" in u else "allow") for u in made]
    frame = spark.createDataFrame(labelled, "url string, label string")
    tokens = [(set(r.t), r.label) for r in frame.select(urls.url_tokens(frame.url).alias("t"), "label").collect()]
    rules = urls.mine_rules(frame, min_support=0.02, min_confidence=0.9)
    assert rules
    for own, label, confidence, support in rules:
        hits = [x == label for t, x in tokens if set(own) <= t]
        assert math.isclose(confidence, sum(hits) / len(hits)) and math.isclose(support, sum(hits) / len(tokens), rel_tol=1e-9)
        assert confidence >= 0.9 and support >= 0.02
    index = urls.RuleIndex(rules)
    for own, _ in tokens:
        first = next((r[1] for r in rules if set(r[0]) <= own), None)
        assert index.verdict(list(own)) == first
    judged = urls.judge_urls(frame.selectExpr("url AS page_id", "url"), [], labelled=frame, min_support=0.02, min_confidence=0.9)
    wrong = sum(dict(labelled)[r.page_id] != r.verdict for r in judged.collect())
    assert wrong <= 6
