"""The operators on texts against plain versions, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import numpy as np
import pytest

from rosterlink.llm import bpe, jaccard, langid, lines, lm, mixing, quality, queries
from rosterlink.llm.queries import RANKS
from rosterlink.llm.words import text_buffers, word_hashes

WORDS = "the of and to in that was rest haver onder lines which thing eau les der und ein".split()
LONG = "a line of more than forty characters that documents repeat"


def odd_texts(seed=1, count=60):
    """Texts with copies, near copies, repeated lines, and rows that are null, empty, blank or long."""
    draw = random.Random(seed)
    made = []
    for i in range(count):
        words = [draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(draw.choice([1, 2, 3, 9, 40, 120]))]
        made.append(" ".join(words) + draw.choice(["", "\n" + LONG, "\n  " + LONG.upper() + "\t", "\r\n\n"]))
    for i in range(0, 20):
        words = made[i].split(" ")
        words[draw.randrange(len(words))] = "changed"
        made += [made[i], " ".join(words)]
    return made + [None, "", " \n\t ", "\n", "word", "WORD", "a b", "A  b", "word " * 20_000, "é" * 3000, "\x00 x\u0085y\u2003z"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 11 == 0 else f"s{i % 3}", "x", i, "n") for i, t in enumerate(odd_texts())]
    # Columns named as the operators name their own.
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, id string, n_lines int, `row` string").repartition(5)


def texts_of(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def words_of(text):
    return (text or "").encode().lower().split()


def empty(docs):
    return docs.where("1 = 0")


def roots(links, nodes):
    label = {n: n for n in nodes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {n: root(n) for n in nodes}


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = odd_texts()
    hashes, rows = word_hashes(*text_buffers(pa.array(texts)))
    known = {}
    for text, a, b in zip(texts, rows, rows[1:]):
        words = words_of(text)
        assert len(words) == b - a
        for word, value in zip(words, hashes[a:b].tolist()):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


@pytest.fixture(scope="module")
def encoding():
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(RANKS)
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_ids_are_those_of_the_library(docs, encoding):
    ranks, library = encoding
    rows = bpe.decode(bpe.encode(docs, ranks, decoded=False), ranks, "ids").collect()
    twice = {r.doc_id: r for r in bpe.encode(docs, ranks, decoded=True).collect()}
    texts = texts_of(docs)
    assert len(rows) == len(twice) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = np.frombuffer(twice[row.doc_id].ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text) and row.n_tokens == len(ids)
        assert row.decoded == twice[row.doc_id].decoded == text.encode()
    assert bpe.encode(empty(docs), ranks).count() == 0


def test_bpe_random_pieces_appends_and_edits(encoding):
    ranks, library = encoding
    vocabulary, draw = bpe.Vocabulary(ranks), random.Random(3)
    encoder = bpe._Encoder(vocabulary)
    signs = "aeinrst'' \n\t.,!12éßñ日\u0085\U0001F600½Ⅳ_"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(50))) for _ in range(3000)] + ["a" * 999, " " * 500 + "x"]
    ids, rows = encoder.chunk(texts)
    for text, a, b in zip(texts, rows, rows[1:]):
        assert ids[a:b].tolist() == library.encode_ordinary(text)
    for _ in range(60):
        data = "".join(draw.choice("aeinrstlu") for _ in range(draw.randrange(1, 300))).encode()
        kept = bpe.PrefixEncoding(vocabulary)
        for at in range(0, len(data), 7):
            kept.append(data[at: at + 7])
        assert kept.last == bpe.PrefixEncoding(vocabulary, data).last
        low = draw.randrange(len(data))
        high, new = draw.randrange(low, len(data) + 1), b"xyz"[: draw.randrange(4)]
        kept.replace(low, high, new)
        assert kept.data == data[:low] + new + data[high:]
        assert kept.last == bpe.PrefixEncoding(vocabulary, kept.data).last


def plain_lines(texts):
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate({c: c + 32 for c in range(65, 91)})
    held = defaultdict(set)
    for i, text in texts.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(i)
    out = {}
    for i, text in texts.items():
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if not (len(held.get(key(x), ())) >= 5 and max(held[key(x)]) != i)]
        out[i] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))
    return out


def test_lines(docs):
    expected = plain_lines(texts_of(docs))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in lines.drop_repeated_lines(docs).collect()}
    assert got == expected and sum(v[1] for v in got.values())
    # Filters so small that every line is suspected give the same.
    tight = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in lines.drop_repeated_lines(docs, most_bits=1 << 16).collect()}
    assert tight == expected
    whole = lines.drop_repeated_lines(docs, whole_rows=True)
    assert whole.columns == docs.columns
    assert {r.doc_id: r.text for r in whole.collect()} == {i: v[2] for i, v in expected.items()}
    assert lines.drop_repeated_lines(empty(docs)).count() == 0


def test_lines_null_ids_and_repeated_rows(spark):
    rows = [(None, LONG)] + [(1, LONG)] * 4 + [(i, LONG) for i in (2, 3, 4)]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 1), (1, 1), (1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 0)]


def plain_sets(texts, size):
    out = {}
    for i, text in texts.items():
        w = words_of(text)
        out[i] = {tuple(w[k: k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_jaccard(docs, size, percent):
    sets = plain_sets(texts_of(docs), size)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    expected = roots(links, sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs, words=size, percent=percent).collect()}
    assert got == {i: (len(sets[i]), expected[i]) for i in sets}
    assert jaccard.similar_documents(empty(docs)).count() == 0


@pytest.mark.parametrize("frequent, combined", [(3, 24), (3, 2), (400, 24)])
def test_jaccard_frequent_tokens(spark, monkeypatch, frequent, combined):
    """Chains of near copies over common passages, so that rounds leave open tokens and combinations or blocks decide."""
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "MOST_COMBINED", combined)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard, "_COLUMNS", 64)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    draw = random.Random(5)
    passages = [[f"p{k}w{i}" for i in range(70)] for k in range(3)]
    texts = {}
    for i in range(150):
        words = list(passages[i % 3]) + [f"q{i % 7}x{j}" for j in range(20)]
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"r{draw.randrange(30)}"
        texts[i] = " ".join(words)
    sets = plain_sets(texts, 3)
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    expected = roots(links, sets)
    got = jaccard.similar_documents(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert 3 < len(set(expected.values())) < 150


def test_jaccard_driver_gets_slices_of_the_filter(docs, monkeypatch):
    """No lists of ids or of their places on the driver."""
    seen, each = [], type(docs).toLocalIterator
    monkeypatch.setattr(type(docs), "toLocalIterator", lambda self, *a: (seen.append(self.columns), each(self, *a))[1])
    groups = jaccard.similar_documents(docs).groupBy("component_id").count().where("count > 1").count()
    assert groups and seen == [["slice", "state"]]


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(n for n in sizes if n is not None) + [n for n in sizes if n is None]
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[n] for n in full)
        share = rest / max(sum(weight[n] for n in names if n not in full), 1e-300)
        more = {n for n in names if n not in full and weight[n] * share > most * sizes[n]}
        if not more:
            return {n: most * sizes[n] if n in full else weight[n] * share for n in names}
        full |= more


def test_mixing(docs):
    texts = texts_of(docs)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    sizes = defaultdict(int)
    for i, text in texts.items():
        sizes[source[i]] += len(words_of(text))
    targets = plain_targets(dict(sizes))
    rows = mixing.mix_sources(docs, bucket_rows=4).collect()
    assert len(rows) == len(texts)
    taken = defaultdict(int)
    for r in rows:
        assert r.size == len(words_of(texts[r.doc_id])) and r.source_size == sizes[r.source]
        assert math.isclose(r.target, targets[r.source], rel_tol=1e-9) and 0 <= r.taken <= 3 * r.size
        assert r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for name, target in targets.items():
        largest = max(r.size for r in rows if r.source == name)
        assert abs(taken[name] - target) <= largest
    again = mixing.mix_sources(docs.repartition(2), bucket_rows=4).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in rows}
    assert mixing.mix_sources(empty(docs)).count() == 0


def test_mixing_caps_and_expectation(spark):
    rows = [(i, "w " * (50 if i < 100 else 1), "a" if i < 100 else "b") for i in range(110)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id int, text string, source string"), weights=(1.0, 1.0)).collect()
    assert {r.target for r in mixed if r.source == "b"} == {30.0}
    assert all(r.copies == 3 for r in mixed if r.source == "b")
    assert abs(sum(r.taken for r in mixed if r.source == "a") - 4980) <= 50
    # Half of equal rows: each should be taken in about half of the draws.
    half = spark.createDataFrame([(i, "w w", s) for s in "ab" for i in range(40)], "doc_id int, text string, source string")
    seen = Counter()
    for seed in range(12):
        for r in mixing.mix_sources(half, weights=(3.0, 1.0), seed=seed, bucket_rows=8).where("source = 'b'").collect():
            seen[r.doc_id] += r.copies
    assert sum(seen.values()) == 12 * 20 and max(seen.values()) <= 11 and min(seen.values()) >= 1


def test_lm_against_a_plain_model(spark, docs):
    texts = texts_of(docs)
    split = {i: [*words_of(t), None] for i, t in texts.items()}
    single, pairs, triples = Counter(), Counter(), Counter()
    for w in split.values():
        single.update(w), pairs.update(zip(w, w[1:])), triples.update(zip(w, w[1:], w[2:]))
    total = sum(single.values())
    after, spent, after2, spent2 = Counter(), Counter(), Counter(), Counter()
    for (x, y), n in pairs.items():
        after[x] += n
        spent[x] += (n - 0.75) * (n >= 2)
    for (x, y, z), n in triples.items():
        after2[x, y] += n
        spent2[x, y] += (n - 0.75) * (n >= 2)

    def chance(h, w):
        if not h:
            return (single[w] + 1) / (total + len(single) + 1)
        if len(h) == 1:
            own = (pairs[h[0], w] - 0.75) / after[h[0]] if pairs[h[0], w] >= 2 else 0
            return own + (1 - spent[h[0]] / after[h[0]]) * chance((), w)
        if pairs[h] < 2:
            return chance(h[1:], w)
        own = (triples[(*h, w)] - 0.75) / after2[h] if triples[(*h, w)] >= 2 else 0
        return own + (1 - spent2[h] / after2[h]) * chance(h[1:], w)

    model = lm.train(docs, min_counts=(1, 2, 2))
    rows = lm.score_texts(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = split[r.doc_id]
        base = sum(math.log10(chance((), x)) for x in w)
        score = sum(math.log10(chance(tuple(w[max(0, k - 2): k]), x)) for k, x in enumerate(w))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), len(w), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and abs(r.score - score) <= 2e-3 * len(w)
    unseen = spark.createDataFrame([(1, "neverseen words"), (2, None)], "doc_id int, text string")
    assert [r.n_known for r in lm.score_texts(unseen, model).orderBy("doc_id").collect()] == [1, 1]
    nothing = lm.train(empty(docs))
    assert {r.n_known for r in lm.score_texts(unseen, nothing).collect()} == {0}
    assert lm.score_texts(empty(docs), model).count() == 0


def test_lm_query_keeps_rare_sequences(spark, docs, tmp_path):
    """The query's scores are those of a plain model in which pairs and triples seen once count like all others."""
    texts = texts_of(docs)
    split = {i: [*words_of(t), None] for i, t in texts.items()}
    single, pairs, triples = Counter(), Counter(), Counter()
    for i, w in split.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            single.update(w), pairs.update(zip(w, w[1:])), triples.update(zip(w, w[1:], w[2:]))
    after, kinds = Counter(), Counter()
    for grams in (pairs, triples):
        for g, n in grams.items():
            after[g[:-1]] += n
            kinds[g[:-1]] += 1

    def chance(h, w):
        if not h:
            return (single[w] + 1) / (sum(single.values()) + len(single) + 1)
        shorter = chance(h[1:], w)
        if not after[h]:
            return shorter
        seen = (pairs if len(h) == 1 else triples)[(*h, w)]
        return (max(seen - 0.75, 0) + 0.75 * kinds[h] * shorter) / after[h]

    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op10_lm(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) and 0 < sum(r.held_out for r in rows) < len(rows)
    for r in rows:
        w = split[r.doc_id]
        score = sum(math.log10(chance(tuple(w[max(0, k - 2): k]), x)) for k, x in enumerate(w))
        assert abs(r.score - score) <= 2e-3 * len(w)


def test_lm_parts_are_not_copied_from_a_mounted_folder(spark, docs, monkeypatch):
    """Nothing goes through the driver's file server; a store that only Spark reads gives the same scores."""
    sent, add = [], type(spark.sparkContext).addFile
    monkeypatch.setattr(type(spark.sparkContext), "addFile", lambda self, path, *a: (sent.append(path), add(self, path, *a)))

    def scores():
        return sorted(tuple(r) for r in lm.score_texts(docs, lm.train(docs, min_counts=(1, 1, 1))).collect())

    mapped = scores()
    assert not sent
    monkeypatch.setattr(lm, "urlsplit", lambda path: urlsplit("viewfs:" + path))
    assert scores() == mapped and sent


def test_language(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = (table.doc_id % 5) == 0
    models = langid.train(table.where(~held))
    judged = langid.judge(table.where(held), models).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.98 * len(judged)
    assert sum(r.rejected for r in judged) <= 0.01 * len(judged)
    assert all(0 <= r.score <= 1 for r in judged)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "日本語の文章です" * 9), (5, "the of and that\x00was"),
                                 (6, "and the thing " * 60_000)], "doc_id int, text string")
    got = {r.doc_id: r for r in langid.judge(odd, models).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(got[i].rejected for i in (1, 2, 3, 4))
    assert got[5].lang_pred == got[6].lang_pred == "en" and not got[6].rejected
    assert {r.doc_id for r in langid.accepted(odd, models).collect()} == {i for i, r in got.items() if not r.rejected}
    # Counts alone decide the chances: those of a context sum to one.
    codes, _ = langid.characters(["th"])
    letters = sorted({int(g[-1]) for g in [codes]} | {c for c in range(97, 123)} | {32})
    assert models.log_chances(codes, np.array([len(codes) - 1])).max() < 0 and letters
    nothing = langid.train(empty(table))
    assert {r.lang_pred for r in langid.judge(odd, nothing).collect()} == {"und"}


def test_language_chances_sum_to_one():
    grams = np.array([[1, 1, 1, 97], [1, 1, 97, 98], [1, 97, 98, 97], [97, 98, 97, 97], [98, 97, 97, 32]], np.uint32)
    models = langid.build({"x": (grams, np.array([5, 3, 2, 2, 1]))})
    for text in ("ab", "a", "zz"):
        total = 0.0
        for letter in (97, 98, 32):
            codes = np.append(langid.characters([text])[0], letter).astype(np.uint32)
            total += 2.0 ** models.log_chances(codes, np.array([len(codes) - 1]))[0, 0]
        # Two of five equal shares of the uniform model are for signs never seen.
        assert 0.5 < total <= 1 + 1e-6


def test_quality(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").selectExpr("doc_id", "quality AS label")
    held = [r.doc_id for r in labels.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    weights = quality.train(table, labels.where(~labels.doc_id.isin(held)))
    judged = quality.score_texts(table.where(table.doc_id.isin(held)), weights).join(labels, "doc_id").collect()
    right = sum((r.score >= 0.7) == bool(r.label) for r in judged)
    assert right >= 0.97 * len(judged) and all(0 <= r.score <= 1 for r in judged)
    again = quality.train(table.repartition(3), labels.where(~labels.doc_id.isin(held)))
    assert np.allclose(weights, again)


def test_quality_odd_rows(spark, docs):
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(100)] + [(None, 1.0), (1, None), (2, 7.0)], "doc_id bigint, label double")
    weights = quality.train(docs, labels)
    rows = quality.score_texts(docs, weights).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = quality.train(docs, labels.where("1 = 0"))
    assert {round(r.score, 6) for r in quality.score_texts(docs, none).collect()} == {0.5}
    assert quality.score_texts(empty(docs), weights).count() == 0
