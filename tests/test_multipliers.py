"""The multiplier search runs until a round changes nothing, not for a set number of rounds."""

import numpy as np
import pytest

from zonalis.operators import ranking

GRID = (0.8, 1.0, 1.2, 1.5, 2.0)


def score(p, truth, w):
    y, k = (p * np.array(w)).argmax(axis=1), p.shape[1]
    both = np.bincount(y, minlength=k) + np.bincount(truth, minlength=k)
    return float(np.mean(2 * np.bincount(truth[y == truth], minlength=k)[both > 0] / both[both > 0])), float((y == truth).mean())


def test_multiplier_search_goes_on_until_nothing_changes(spark):
    rng = np.random.default_rng(40)
    truth = rng.integers(0, 6, 60)
    p = rng.integers(1, 30, (60, 6)).astype(float)
    p[np.arange(60), truth] += 8
    df = spark.createDataFrame([(int(t), [float(x) for x in r]) for t, r in zip(truth, p)], "t int, p array<double>")
    w, before, after = ranking.search_multipliers(df, "t", "p", 6)
    assert w == [1.0, 1.0, 0.8, 1.0, 0.8, 1.0] and before == pytest.approx(score(p, truth, [1.0] * 6)) and after == pytest.approx(score(p, truth, w))
    for c in range(6):  # no class's change is better and within the floor
        for g in GRID:
            s = score(p, truth, [*w[:c], g, *w[c + 1 :]])
            assert s[1] < before[1] - 0.02 or s <= after or s == pytest.approx(after)
    two = ranking.search_multipliers(df, "t", "p", 6, iterations=2)
    assert two[0] == [1.0, 0.8, 0.8, 1.0, 1.2, 1.0] and two[2] < after
