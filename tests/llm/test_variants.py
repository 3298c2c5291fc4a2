"""Spelling variants against all pairs, with odd rows and odd words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rosterlink.llm import variants

SCHEMA = "doc_id bigint, text string, word string, n int, id string"


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(counts, times=10):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    out = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[w] = (form, n, len(near[w]), counts[form] if form else None)
    rows = set()
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, n_near, form_n))
    return rows


def plain_counts(rows, shortest, least, spoil):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def odd_docs():
    draw = random.Random(7)
    stems = ["wonderful", "anothéring", "STRASSEN", "ÀÿÖöøØþ", "banana" * 3, "aaaaaaa", "abababab", "misspelled", "÷×÷×÷×÷"]
    texts = [" ".join(draw.choice(stems) for _ in range(40)) for _ in range(30)]
    for _ in range(60):
        word = list(draw.choice(stems))
        for _ in range(draw.choice([1, 1, 2])):
            at = draw.randrange(len(word))
            draw.choice([lambda: word.pop(at), lambda: word.insert(at, draw.choice("abé")), lambda: word.__setitem__(at, draw.choice("abÿ"))])()
        texts.append(("".join(word) + " ") * draw.choice([1, 2, 3]))
    texts += [None, "", "1 2 3", "日本語のテキスト", "ab́cdefgh", "x" * 20_000, "x" * 19_999 + "7" + "x" * 20_000 + " " + "x" * 20_001,
              "endofrow", "startofrow", "Ã", "\U0001f600wonderful\U0001f600"]
    rows = [(i, t, "w", 1, "i") for i, t in enumerate(texts)]
    return rows + [(None, "wonderful strassen anothering", "w", 1, "i"), rows[40], rows[40]]


def test_groups_of_texts(spark):
    rows = odd_docs()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for shortest, least, spoil in ((7, 2, 3), (4, 1, None)):
        counts = variants.word_counts(docs, shortest, least, spoil)
        expected = plain_counts(rows, shortest, least, spoil)
        assert {r.word: r.n for r in counts.collect()} == expected
        short = {w: n for w, n in expected.items() if len(w) < 1000}
        groups = variants.variant_groups(counts.where(F.char_length("word") < 1000))
        assert {tuple(r) for r in groups.select("word", "form", "root", "n", "n_near", "form_n").collect()} == plain_groups(short)
    groups = {r.word: r for r in variants.variant_groups(variants.word_counts(docs, 7, 1)).collect()}
    assert groups["x" * 19_999].n_near == 1 and groups["x" * 20_000].n_near == 2


def test_words_of_few_letters_and_words_that_begin_alike(spark):
    draw = random.Random(1)
    words = {"".join(draw.choice("ab") for _ in range(draw.randrange(4, 9))) for _ in range(300)}
    words |= {"commonstart" + "".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(300)}
    counts = {w: draw.choice([2, 3, 30, 400, 5000]) for w in words}
    frame = spark.createDataFrame([(w, n, "i") for w, n in counts.items()], "word string, n bigint, id string")
    groups = variants.variant_groups(frame)
    assert {tuple(r) for r in groups.select("word", "form", "root", "n", "n_near", "form_n").collect()} == plain_groups(counts)
    # Nothing but true pairs meets: joins stay as small as their results.
    expected = sum(one_apart(a, b) for a in words for b in words) // 2
    assert variants.near_words(frame.withColumn("id", F.monotonically_increasing_id())).count() == expected


def test_pivots_are_the_two_rarest_that_do_not_overlap():
    ranks = np.arange(variants.GRAM_KINDS)
    own = variants._Words(pa.array(["abcdefg", "zzzzzz", "banana"]), ranks)
    pivots, word, place, of, _ = variants._chosen(own)
    for w in range(3):
        one, two = pivots[word == w]
        assert two - one >= 2
        first = sorted(((own.order[p], p) for p in range(own.start[w], own.end[w] - 1)))[:3]
        sums = {(p, q): (own.order[p] >> 42) + (own.order[q] >> 42) for _, p in first for _, q in first if q - p >= 2}
        assert sums[(one, two)] == min(sums.values())
        assert {p for _, p in first} <= set(place[of == w])


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None, "", 1, ""), (2, "a b", "", 1, "")], SCHEMA)
    assert variants.variant_groups(variants.word_counts(docs)).count() == 0
    assert variants.variant_groups(variants.word_counts(docs.where("1 = 0"))).count() == 0
