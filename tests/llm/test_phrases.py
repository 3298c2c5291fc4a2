"""Phrase mining against a plain count, with odd rows, and by shards of several sizes."""

import random
import re
from collections import Counter, defaultdict

import pytest

from rosterlink.llm import phrases

SCHEMA = "doc_id int, text string, lang string, phrase string, shard int, n string"


def odd_docs():
    draw = random.Random(11)
    words = ["a", "The", "THE", "of", "new", "york", "city", "é", "ß", "x'y", " ", "w-w"]
    texts = []
    for _ in range(90):
        made = [draw.choice(words) for _ in range(draw.choice([0, 1, 2, 5, 30]))]
        texts.append("".join(w + draw.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", ";x", "\r\n", "\x0b"]) for w in made))
    texts += texts[:15] + [None, "", " ", ".,;", "word", "a a a a a a a a a a a a a", "new york city " * 4000, "z" * 200_000]
    langs = ["en", "en", "en", "de", None, "und", ""]
    return [(i, t, langs[i % 7], "p", 1, "n") for i, t in enumerate(texts)]


def plain(rows, least, longest, percent, most):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        sizes[lang] += 0
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            found = re.findall("[^ \t]+", piece)
            sizes[lang] += len(found)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(found[i: i + k]) for i in range(len(found) - k + 1))
    out, frequent = [], {lang: {p: n for p, n in c.items() if n >= least} for lang, c in counts.items()}
    for lang, known in frequent.items():
        rows = []
        for p, a in known.items():
            if len(p) == 1:
                continue
            score, cut = min((1000000 * a * a // (known[p[:k]] * known[p[k:]]), k) for k in range(1, len(p)))
            longer = [n for q, n in known.items() if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q)))]
            if not any(100 * n >= percent * a for n in longer):
                rows.append((-score, -a, " ".join(p).encode(), known[p[:cut]], known[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return frequent, sorted(out)


@pytest.mark.parametrize("least, longest, most, shard_bytes", [(10, 3, 7, 600), (2, 4, None, 12 << 20), (300, 3, None, 5000)])
def test_phrases_equal_a_plain_count(spark, least, longest, most, shard_bytes):
    rows = odd_docs()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frequent, expected = plain(rows, least, longest, 50, most)
    found = phrases.collocations(docs, least, longest, 50, most, shard_bytes)
    assert sorted(map(tuple, found.collect())) == expected
    assert expected
    counts, _ = phrases.frequent_phrases(docs, least, longest, shard_bytes)
    assert {(r.lang, tuple(r.phrase.split(" ")), r.n) for r in counts.collect()} == {
        (lang, p, n) for lang, known in frequent.items() for p, n in known.items()}


def test_a_shard_lists_phrases_from_its_lowered_support_on():
    text = ["to be or not to be"] * 4
    import pyarrow as pa

    _, words, lengths, numbers = phrases._shard([pa.array(text, pa.large_string())])
    mine = phrases._miner(3, 0)
    rows = pa.RecordBatch.from_arrays([pa.array([v]) for v in (1, "en", 5, words, lengths, numbers)],
                                      names=["shard", "lang", "support", "words", "lengths", "numbers"])
    (batch,) = mine(iter([rows]))
    # "to", "be" and "to be" stand eight times, all else four times; a key has three bytes.
    assert len(batch.column("keys")[0].as_py()) == 3 * 3


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, "en", "", 1, "")], SCHEMA)).count() == 0


def drawn_shard(n=60_000):
    import pyarrow as pa

    draw = random.Random(5)
    text = " ".join(format(min(int(draw.paretovariate(0.5)), 10**6) * 2654435761 % 2**32, "x") for _ in range(n))
    return phrases._shard([pa.array([text], pa.large_string())])


def test_packed_numbers_come_back():
    import numpy as np

    for numbers in ([], [0], [191, 192, 16319, 16320, 2**31 - 1, 2**32 - 1, 5], list(range(0, 70_000, 7))):
        assert phrases._unpacked(phrases._packed(np.array(numbers, np.int64))).tolist() == numbers
    keys = np.array([7, 4_000_000, 4_194_303, 0, 9], np.int64)
    assert phrases._stepped(phrases._steps(keys)).tolist() == keys.tolist()


def test_what_is_shuffled_is_small():
    """Listed keys, shards and counted phrases, in bytes for each."""
    import pyarrow as pa

    n, words, lengths, numbers = drawn_shard()
    # 0.87 bytes a word before.
    assert len(numbers) < 0.75 * n
    row = pa.RecordBatch.from_arrays([pa.array([v]) for v in (1, "en", 1, words, lengths, numbers)],
                                     names=["shard", "lang", "support", "words", "lengths", "numbers"])
    listed = pa.Table.from_batches(phrases._with_steps(phrases._miner(3, 1))(iter([row])))
    keys = [phrases._stepped(k) for k in listed["keys"].to_pylist()]
    # Three bytes a key before.
    assert sum(map(len, listed["keys"].to_pylist())) < 1.5 * sum(map(len, keys))

    sent = pa.table({"range": listed["range"], "keys": listed["keys"]})
    counted = phrases._counter(3, 1)(pa.Table.from_batches([row]), sent)
    summed = pa.concat_tables([phrases._summer(1)(counted.slice(i, 1)) for i in range(counted.num_rows)])
    texts = summed["phrase"].to_pylist()
    # A row of its own for each phrase and shard before.
    assert counted.num_rows <= 2 and len(set(texts)) == len(texts)
    assert sum(map(len, counted["phrases"].to_pylist())) < 0.35 * sum(map(len, texts))
    assert sum(summed["n"].to_pylist()) == 3 * n - 3


def test_a_shard_without_any_phrase_it_was_sent():
    import numpy as np
    import pyarrow as pa

    _, words, lengths, numbers = phrases._shard([pa.array(["to be"], pa.large_string())])
    left = pa.table({"lang": ["en"], "words": [words], "lengths": [lengths], "numbers": [numbers]})
    for keys in ([], [3]):
        right = pa.table({"range": pa.array([0], pa.int32()), "keys": [phrases._steps(np.array(keys, np.int64))]})
        assert phrases._counter(3, 1)(left, right).num_rows == 0


def test_words_that_are_no_valid_text_count_as_shown():
    import numpy as np
    import pyarrow as pa

    _, *packed = phrases._shard([phrases._strings(b"\xff be \xfe be", np.array([9]))])
    names = ["words", "lengths", "numbers"]
    row = pa.RecordBatch.from_arrays([pa.array([v]) for v in (1, "en", 1, *packed)], names=["shard", "lang", "support", *names])
    listed = pa.Table.from_batches(phrases._with_steps(phrases._miner(2, 1))(iter([row])))
    counted = phrases._counter(2, 1)(pa.Table.from_batches([row]), pa.table({"range": listed["range"], "keys": listed["keys"]}))
    summed = pa.concat_tables([phrases._summer(2)(counted.slice(i, 1)) for i in range(counted.num_rows)])
    assert sorted(zip(summed["phrase"].to_pylist(), summed["n"].to_pylist())) == [("be", 2), ("�", 2), ("� be", 2)]
