"""Pieces of the language model against plain versions: sums, parts of split words, Elias-Fano search."""

import random

import numpy as np

from rosterlink.llm import eliasfano, lm


def coded(parts):
    """Several parts as one sequence."""
    rows = [eliasfano.encode(p) for p in parts]
    arrays = {a: np.concatenate([r[1][a] for r in rows]) for a in eliasfano.ARRAYS}
    offsets = {a: np.concatenate([[0], np.cumsum([len(r[1][a]) for r in rows])]) for a in eliasfano.ARRAYS}
    return eliasfano.EliasFano(arrays, np.array([r[0] for r in rows]), offsets, np.zeros(0))


def test_search_in_clustered_and_sparse_sequences():
    draw = np.random.default_rng(3)
    dense = np.arange(5000, 9000, dtype=np.uint64)
    parts = [np.unique(np.concatenate([dense, draw.integers(0, 1 << 50, 300, np.uint64)])),
             np.zeros(0, np.uint64), np.array([7], np.uint64), np.unique(draw.integers(0, 1 << 62, 2000, np.uint64))]
    sequence = coded(parts)
    for k, values in enumerate(parts):
        asked = np.concatenate([values, values + np.uint64(1), draw.integers(0, 1 << 50, 500, np.uint64)])
        part, first = np.full(len(asked), k), np.zeros(len(asked), np.int64)
        found = sequence.find(part, asked, first, np.full(len(asked), len(values)))
        place = {int(v): i for i, v in enumerate(values)}
        assert found.tolist() == [place.get(int(v), -1) for v in asked]
        if len(values) > 1:
            at = np.arange(len(values) - 1)
            here, following = sequence.neighbours(np.full(len(at), k), at)
            assert (here == values[:-1]).all() and (following == values[1:]).all()
            # Only places from the first on count, and none from the end on.
            half = len(values) // 2
            found = sequence.find(np.full(len(values), k), values, np.full(len(values), half), np.full(len(values), len(values) - 1))
            assert (found[:half] == -1).all() and found[-1] == -1 and (found[half:-1] == np.arange(half, len(values) - 1)).all()


def test_counts_beyond_32_bits():
    keys, sums = lm.summed(np.array([5, 3, 5, 5], np.uint64), np.array([2 ** 32 - 1, 4, 2 ** 32 - 1, 2 ** 32 - 1], np.uint32))
    assert keys.tolist() == [3, 5] and sums.tolist() == [4, 3 * (2 ** 32 - 1)]
    row = lm._part_row({"part": 0, "size": 2, "total": int(sums.sum())}, {"nodes": keys}, {"counts": sums}).to_pylist()[0]
    assert np.frombuffer(row["counts"], lm._PLAIN["counts"]).tolist() == sums.tolist() and row["total"] == sums.sum()


def test_parts_of_pairs():
    draw = random.Random(1)
    # Parts that begin within one word, twice at the same pair, and at whole words.
    edges = [(2, 0), (4, 3), (4, 3), (4, 9), (4, 12), (8, 5)]
    pairs = sorted((draw.randrange(10), draw.randrange(15)) for _ in range(400))
    first, second = np.array(pairs).T
    assert lm.part_of_pair(np.array(edges), first, second).tolist() == [sum(e <= p for e in edges) for p in pairs]
    assert lm.part_of_pair(np.zeros((0, 2), np.int64), first, second).tolist() == [0] * len(pairs)


def test_a_word_split_over_parts(spark):
    """A word before a third of all tokens lies in several parts; scores do not depend on the number of parts."""
    draw = random.Random(2)
    rows = [(i, " ".join(w for _ in range(60) for w in ("the", f"w{draw.randrange(400)}", f"v{draw.randrange(30)}"))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    scores = []
    for tokens in (1 << 20, 500):
        model = lm.train(docs, part_tokens=tokens)
        split = model.edges[:, 0].tolist()
        assert tokens > 500 or max(split.count(w) for w in split) >= 2
        scores.append([tuple(r) for r in lm.score_texts(docs, model).orderBy("doc_id").collect()])
    assert [r[:5] for r in scores[0]] == [r[:5] for r in scores[1]]
    assert np.allclose([r[5] for r in scores[0]], [r[5] for r in scores[1]], rtol=1e-9)
