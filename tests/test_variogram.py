"""Variograms against all pairs in plain Python, on crowds, repeated keys, missing values and far points; the growth of what a task holds."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from zonalis.operators import spatial

SCHEMA = "k int, x double, y double, v double"


def plain(rows, lags, reach):
    bins = {}
    for i, (k, x, y, v) in enumerate(rows):
        for l, a, b, w in rows[:i]:
            if None in (k, l, x, y, a, b) or k == l:
                continue
            h = math.sqrt((x - a) * (x - a) + (y - b) * (y - b))
            if h <= reach:
                t = bins.setdefault(min(math.floor(h / (reach / lags)), lags - 1), [0, 0.0, 0, 0.0])
                t[0], t[1] = t[0] + 1, t[1] + h
                if None not in (v, w):
                    t[2], t[3] = t[2] + 1, t[3] + (v - w) ** 2
    return {b: (n, h / n, g / m / 2 if m else None) for b, (n, h, m, g) in bins.items()}


def same(got, want):
    got = {r["bin"]: (r["pairs"], r["lag"], r["semivariance"]) for r in got.collect()}
    assert got.keys() == want.keys()
    for b, (n, h, g) in want.items():
        assert got[b][0] == n and got[b][1] == pytest.approx(h, rel=1e-12, abs=1e-15)
        assert got[b][2] == (None if g is None else pytest.approx(g, rel=1e-11))


def odd_rows():
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 0.1), rng.gauss(0, 0.1), rng.choice([None, 1.0, 2.5, 4.0])) for i in range(600)]
    rows += [(1000 + i, 0.02, 0.03, 1.0 if i % 3 else None) for i in range(120)]  # a crowd at one place
    rows += [(i % 7, rng.gauss(0, 0.1), 0.0, 3.0) for i in range(40)] + [(5, 0.02, 0.03, 1.0)] * 3  # repeated keys
    rows += [(2000 + i, 0.02 * i, 0.5, float(i)) for i in range(12)]  # distances at the bins' ends
    return rows + [(3000, None, 0.0, 1.0), (None, 0.0, 0.0, 1.0), (3001, float("nan"), 0.0, 1.0), (3002, float("inf"), 0.0, 1.0), (3003, 1e300, -1e300, 1.0)]


def test_variogram_equals_all_pairs(spark):
    rows = odd_rows()
    known = [r for r in rows if r[1] is None or math.isfinite(r[1])]
    for block in (65536, 16):  # 16: points of a place and of a key lie in many blocks
        same(spatial.variogram(spark.createDataFrame(rows, SCHEMA), "k", "x", "y", "v", 10, 0.2, block), plain(known, 10, 0.2))


def test_variogram_bins_by_the_root_of_the_squares(spark):
    """The distance is SQL's sqrt(dx dx + dy dy); ``hypot`` differs in the last bit, and so in the bin at its end."""
    rng = random.Random(1)
    rows, reach = [], 0.2
    while len(rows) < 40:
        x = rng.uniform(0, reach)
        y = math.sqrt(reach * reach - x * x)
        if (math.sqrt(x * x + y * y) <= reach) != (math.hypot(x, y) <= reach):
            rows += [(len(rows), 0.0, 1e6 * len(rows), 1.0), (len(rows) + 1, x, y, 4.0)] if not rows else [(len(rows), x, y, 4.0)]
    same(spatial.variogram(spark.createDataFrame(rows, SCHEMA), "k", "x", "y", "v", 10, reach), plain(rows, 10, reach))


def test_variogram_of_nothing_and_of_one_place(spark):
    assert spatial.variogram(spark.createDataFrame([], SCHEMA), "k", "x", "y", "v", 10, 0.2).collect() == []
    assert spatial.variogram(spark.createDataFrame([(1, 0.0, 0.0, 1.0)], SCHEMA), "k", "x", "y", "v", 10, 0.2).collect() == []
    crowd = spark.range(3_000_000).selectExpr("cast(id as int) as k", "0.5D as x", "0.5D as y", "cast(id % 2 as double) as v")
    got = spatial.variogram(crowd, "k", "x", "y", "v", 10, 0.2).collect()  # 4.5e12 pairs at one place, which no join of rows ends
    n = 1_500_000
    assert [tuple(r) for r in got] == [(0, n * (2 * n - 1), 0.0, n * n / (n * (2 * n - 1)) / 2)]


def test_lag_sums_count_beyond_doubles():
    n = 94_906_267  # n n is odd and above 2^53
    p = pd.DataFrame({"x": [0.0], "y": [0.0], "v": [1.0], "known": [True], "n": [n], "g": [-1]})
    q = p.assign(x=0.05, v=3.0)
    got = spatial._lag_sums(p, q, False, 4, 0.2).iloc[0]
    assert (got["pairs"], got["known"]) == (n * n, n * n) and spatial._lag_sums(p, p, True, 4, 0.2)["pairs"][0] == n * (n - 1) // 2


def test_variogram_tasks_stay_bounded(spark):
    """No pair is a row of the plan: what meets in a group are places of two blocks."""
    rng = np.random.default_rng(2)
    d = spark.createDataFrame(pd.DataFrame({"k": range(3000), "x": rng.normal(0, 0.01, 3000), "y": rng.normal(0, 0.01, 3000), "v": rng.normal(0, 1, 3000)}))
    plan = spatial.variogram(d, "k", "x", "y", "v", 10, 0.2)._jdf.queryExecution().optimizedPlan().toString()
    assert "_cx" not in plan and "FlatMapGroupsInPandas" in plan
