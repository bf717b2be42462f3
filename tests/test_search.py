"""Successive halving against a plain search, the catalogue, and curves against a plain recount."""

import collections
import json
import math
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from zonalis.operators import learning, search


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        y = i % 3
        rows.append((i, float(y), None if i % 29 == 0 else y + rng.gauss(0, 0.4), -y + rng.gauss(0, 0.6)))
    return learning.folds(spark.createDataFrame(rows, "id long, label double, a double, b double"), "id", "label", 2).cache()


def test_rungs():
    assert search.rungs(1000, 8, 100) == [100, 200, 400]
    assert search.rungs(1000, 2, 100) == [100]
    assert search.rungs(250, 64, 100) == [100, 200, 250]
    assert search.rungs(50, 9, 100, 3) == [50]


def test_drawn_is_repeatable_and_without_replacement():
    grid = {"forest": {"numTrees": [5, 10, 20], "maxDepth": [2, 3, 4]}, "tree": {"maxDepth": [2, 3]}}
    got = search.drawn(grid, 4, 1)
    assert got == search.drawn(grid, 4, 1) and len(got) == 6
    assert len({json.dumps(c) for c in got}) == 6 and [c for c in got if c[0] == "tree"] == [("tree", {"maxDepth": 2}), ("tree", {"maxDepth": 3})]


def test_halving_keeps_the_survivors_of_a_plain_search(spark, table):
    """Models are thresholds on one feature: a plain search counts the same hits."""

    class Cut:
        def __init__(self, name, params):
            self.c, self.by = name, params["by"]

        def fit(self, train):
            return self

        def transform(self, rest):
            return rest.withColumn("prediction", F.greatest(F.lit(0.0), F.least(F.lit(2.0), F.round(F.col(self.c) * self.by))))

    candidates = [(c, {"by": b}) for c in "ab" for b in (-1.5, -1.0, 0.2, 0.9, 1.1)]
    got = search.halving(table, "id", ["a", "b"], candidates, 2, 60, fit=lambda name, columns, classes, params: Cut(name, params)).collect()
    rows = table.withColumn("h", F.xxhash64("id", F.lit(0))).collect()
    rows.sort(key=lambda r: (r.h, r.id))
    alive = list(range(10))
    for rung, n in enumerate([60, 120, 240]):
        part, means = rows[:n], {}
        for c in alive:
            name, by, scores = candidates[c][0], candidates[c][1]["by"], []
            for i in range(2):
                known = sorted(r[name] for r in part if r.fold != i and r[name] is not None)
                m = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
                rest = [r for r in part if r.fold == i]
                half_up = lambda v: math.copysign(math.floor(abs(v) + 0.5), v)
                scores.append(sum(max(0.0, min(2.0, half_up((r[name] if r[name] is not None else m) * by))) == r.label for r in rest) / len(rest))
            means[c] = sum(scores) / 2
        order = sorted(alive, key=lambda c: (-means[c], c))
        alive = sorted(order[: math.ceil(len(order) / 2)])
        mine = [r for r in got if r.rung == rung]
        assert [r.candidate for r in mine] == order and all(r.rows == n for r in mine)
        assert {r.candidate: r.mean for r in mine} == {c: pytest.approx(m) for c, m in means.items()}
        assert sorted(r.candidate for r in mine if r.kept) == alive
    assert [(r.rung, r.candidate) for r in got if r.best] == [(2, order[0])]


def test_halving_fits_models(spark, table):
    got = search.halving(table, "id", ["a", "b"], [("tree", {"maxDepth": 1}), ("logistic", {"regParam": 0.001}), ("bayes", {})], 2, 120, score=search.macro_f1).collect()
    assert collections.Counter(r.rung for r in got) == {0: 3, 1: 2}
    best = [r for r in got if r.best]
    assert len(best) == 1 and best[0].mean > 0.8 and best[0].model != "tree"
    with pytest.raises(ValueError):
        search.halving(table.where("false"), "id", ["a", "b"], [("tree", {})], 2, 10)


@pytest.mark.parametrize("name", ["bagging", "boosting", "linear_svc", "perceptron"])
def test_catalogue(spark, table, name):
    d = table.na.fill(1.0, ["a"])
    params = {"maxIter": 5} if name == "boosting" else {"numTrees": 5} if name == "bagging" else {}
    scored = search.pipeline(name, ["a", "b"], 3, params).fit(d).transform(d)
    assert search.accuracy(scored) > 0.75
    p = scored.select(search.scores_of(scored).alias("p")).collect()
    assert all(len(r.p) == 3 and sum(r.p) == pytest.approx(1) for r in p)
    with pytest.raises(ValueError):
        search.estimator("none", 1, 2)


def test_softmax_of_raw_scores(spark):
    d = spark.createDataFrame([([1000.0, 1001.0],)], "r array<double>").select(array_to_vector("r").alias("rawPrediction"))
    assert d.select(search.scores_of(d).alias("p")).first().p == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)])


def test_curves_equal_a_plain_recount(spark):
    rng = random.Random(9)
    rows = [(c, None if rng.random() < 0.05 else rng.randint(0, 12) / 8, rng.choice([0, 1, 2, None])) for c in (0, 1) for _ in range(150)]
    got = {(r["class"], r.threshold): r for r in search.curves(spark.createDataFrame(rows, "class int, p double, t int"), "t").collect()}
    assert set(got) == {(c, p) for c, p, _ in rows if p is not None}
    for (c, p), r in got.items():
        mine = [x for x in rows if x[0] == c]
        hits = sum(x[1] is not None and x[1] >= p and x[2] == c for x in mine)
        false = sum(x[1] is not None and x[1] >= p and x[2] != c for x in mine)
        yes = sum(x[2] == c for x in mine)
        assert (r.hits, r.false_alarms) == (hits, false)
        assert (r.hit_rate, r.false_alarm_rate, r.precision) == pytest.approx((hits / yes, false / (len(mine) - yes), hits / (hits + false)))
