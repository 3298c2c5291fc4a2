import random

import brute
import numpy as np
import pytest

from rosterlink.functions import similarity as S

SCORES = [
    (S.ratio_scores, brute.ratio), (S.token_sort_scores, brute.token_sort), (S.token_set_scores, brute.token_set),
    (S.partial_scores, brute.partial), (S.partial_token_scores, brute.partial_token),
    (S.weighted_scores, brute.weighted),
]


@pytest.mark.parametrize("fast,slow", SCORES)
def test_scores_equal_plain_python(fast, slow):
    rng = random.Random(7)
    words = ["ab", "abc", "é", "bca", "x" * 70, "", "caab"]
    left = [" ".join(rng.choices(words, weights=[5, 5, 5, 5, 1, 2, 5], k=rng.randrange(4))) for _ in range(150)]
    right = [" ".join(rng.choices(words, weights=[5, 5, 5, 5, 1, 2, 5], k=rng.randrange(4))) for _ in range(150)]
    assert np.allclose(fast(left, right), [slow(a, b) for a, b in zip(left, right)], atol=1e-9)


def test_columns(spark):
    df = spark.createDataFrame([("DUPONT, Jeen", "DUPONT, Jean"), (None, "x")], "a string, b string")
    assert [round(r[0], 2) for r in df.select(S.weighted_ratio("a", "b")).collect()] == [91.67, 0.0]
