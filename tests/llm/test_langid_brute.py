"""Language models against plain Kneser-Ney, and texts in pieces against whole ones."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterlink.llm import langid

ORDER = langid.ORDER


def plain_characters(text):
    """Lower-cased letters; every run of others behind a letter is a blank."""
    out = []
    for ch in text.lower():
        if ch.isalpha():
            out.append(ch)
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out)


class PlainModel:
    """Interpolated Kneser-Ney by dictionaries, one language."""

    def __init__(self, texts, signs):
        counts = Counter()
        for text in texts:
            padded = "^" * (ORDER - 1) + plain_characters(text)
            counts.update(padded[i - ORDER + 1: i + 1] for i in range(ORDER - 1, len(padded)))
        self.tables, self.signs = {ORDER: counts}, signs
        for size in range(ORDER - 1, 0, -1):
            self.tables[size] = Counter(gram[1:] for gram in self.tables[size + 1])
        self.sums, self.kinds, self.discounts = {}, {}, {}
        for size, table in self.tables.items():
            once, twice = (sum(c == k for c in table.values()) for k in (1, 2))
            self.discounts[size] = once / (once + 2 * twice) if once else 0.5
            self.sums[size], self.kinds[size] = defaultdict(int), defaultdict(int)
            for gram, c in table.items():
                self.sums[size][gram[:-1]] += c
                self.kinds[size][gram[:-1]] += 1

    def chance(self, gram):
        size = len(gram)
        if not size:
            return 1 / (self.signs + 2)
        head, total = gram[:-1], self.sums[size].get(gram[:-1], 0)
        if not total:
            return self.chance(gram[1:])
        seen, cut = self.tables[size].get(gram, 0), self.discounts[size]
        return max(seen - cut, 0) / total + cut * self.kinds[size][head] / total * self.chance(gram[1:])

    def bits(self, text):
        padded = "^" * (ORDER - 1) + plain_characters(text)
        return [-math.log2(self.chance(padded[i - ORDER + 1: i + 1])) for i in range(ORDER - 1, len(padded))]


TEXTS = {
    "de": ["Der Hund und die Katze sind im Haus.", "das ist ein Haus, und der Hund bellt 12 mal", "Die Straße ist lang", "ein Tag im Mai"],
    "en": ["the dog and the cat are in the house", "This is a house; the dog barks!", "a day in May", "the the the"],
}


def test_chances_equal_plain_kneser_ney(spark):
    rows = [(t, lang) for lang, texts in TEXTS.items() for t in texts * 4]
    table = spark.createDataFrame(rows, "text string, lang string")
    models = langid.train(table)
    # The rows kept aside for the limits are chosen by the text's hash.
    aside = {r.text for r in table.where(F.pmod(F.shiftright(F.xxhash64("text"), 32), F.lit(10)) == 0).collect()}
    learnt = {lang: [t for t in texts * 4 if t not in aside] for lang, texts in TEXTS.items()}
    signs = len(set("".join(plain_characters(t) for ts in learnt.values() for t in ts)))
    plain = {lang: PlainModel(texts, signs) for lang, texts in learnt.items()}
    tried = [*aside, "the Hund in the house", "Zug", "x", "dog  dog--Katze ", "Größe"]
    judged = langid.judge(spark.createDataFrame(list(enumerate(tried)), "doc_id int, text string"), models)
    for row in judged.collect():
        bits = {lang: plain[lang].bits(tried[row.doc_id]) for lang in models.languages}
        means = {lang: sum(b) / len(b) for lang, b in bits.items()}
        best = min(means, key=lambda lang: (means[lang], lang))
        assert row.n_chars == len(bits["de"]) and math.isclose(row.bits, min(means.values()), rel_tol=1e-4)
        assert row.lang_pred == best


@pytest.mark.parametrize("piece", [1, 2, 5, 17])
def test_pieces_change_nothing(monkeypatch, piece):
    draw = random.Random(piece)
    texts = ["".join(draw.choice(["a", "b", "É", "Σ", " ", ".", "1", "\x00", "ß", "日"]) for _ in range(draw.randrange(90))) for _ in range(60)]
    texts += ["", " ", "a", " a", "a ", "12 " * 50, "ab" + "-" * 80 + "ab"]
    codes = [langid.characters([t])[0] for t in texts]
    grams, seen = np.unique(np.concatenate([np.lib.stride_tricks.sliding_window_view(c, ORDER) for c in codes if len(c) >= ORDER]), axis=0, return_counts=True)
    models = langid.build({"x": (grams, seen), "y": (grams[::2], seen[::2])})

    def entropies(rows):
        return [langid._row_entropies(models, high - low, pieces, owners) for low, high, pieces, owners in langid._text_lists(pa.array(rows))]

    whole = entropies(texts)
    monkeypatch.setattr(langid, "_PIECE", piece)
    for rows in (texts, texts[:1], texts[-1:]):
        parts = entropies(rows)
        sums, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        at = [texts.index(t) for t in rows]
        assert np.array_equal(sizes, np.concatenate([w[1] for w in whole])[at])
        assert np.allclose(sums, np.concatenate([w[0] for w in whole])[at], rtol=1e-5)
