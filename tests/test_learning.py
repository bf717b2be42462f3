"""Folds and permutation importance against plain versions."""

import collections

import pytest
from pyspark.sql import functions as F

from zonalis.operators import learning


def hashes(spark, keys, seed):
    return {r.k: r.h for r in spark.createDataFrame([(k,) for k in keys], "k long").select("k", F.xxhash64("k", F.lit(seed)).alias("h")).collect()}


def test_folds_equal_hash_order_within_classes(spark):
    rows = [(i, None if i % 17 == 0 else "abc"[i % 3 if i % 5 else 0], i * 2) for i in range(400)]
    got = {r.id: r.fold for r in learning.folds(spark.createDataFrame(rows, "id long, c string, v long"), "id", "c", 4, 3).collect()}
    h, classes = hashes(spark, [r[0] for r in rows], 3), collections.defaultdict(list)
    for i, c, _ in rows:
        classes[c].append(i)
    want = {i: k % 4 for ids in classes.values() for k, i in enumerate(sorted(ids, key=lambda i: (h[i], i)))}
    assert got == want


def test_shuffled_columns(spark):
    rows = [(i * 3 % 101, float(i), i % 7 if i % 9 else None, "x") for i in range(101)]
    df = spark.createDataFrame(rows, "id long, a double, b long, c string")
    got = learning.shuffled(df, "id", ["a", "b"], 5)
    assert got.columns == df.columns
    h, old = hashes(spark, [r[0] for r in rows], 5), {r[0]: r for r in rows}
    takes = dict(zip(sorted(old), sorted(old, key=lambda i: (h[i], i))))
    assert {r.id: (r.a, r.b, r.c) for r in got.collect()} == {i: (old[j][1], old[j][2], "x") for i, j in takes.items()}


def test_importance_equals_plain_recount(spark):
    rows = [(i, (i * 37 % 100) / 10, (i * 61 % 100) / 10, (i * 17 % 100) / 10) for i in range(300)]
    rows = [(*r, float(r[1] + 0.3 * r[2] > 6.5) if r[0] % 11 else 1.0) for r in rows]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double")
    score = lambda d: d.withColumn("prediction", (F.col("a") + 0.3 * F.col("b") > 6.5).cast("double"))
    got = learning.permutation_importance(score, df, "id", ["c", "b", "a"], seeds=(1, 2))
    base = sum((a + 0.3 * b > 6.5) == bool(y) for _, a, b, _, y in rows) / 300
    want = {}
    for k, name in ((1, "a"), (2, "b"), (3, "c")):
        lost = []
        for seed in (1, 2):
            h = hashes(spark, range(300), seed)
            takes = dict(zip(range(300), sorted(range(300), key=lambda i: (h[i], i))))
            new = [[*r[:k], rows[takes[r[0]]][k], *r[k + 1 :]] for r in rows]
            lost.append(base - sum((a + 0.3 * b > 6.5) == bool(y) for _, a, b, _, y in new) / 300)
        want[name] = (sum(lost) / 2, abs(lost[0] - lost[1]) / 2**0.5)
    res = got.collect()
    assert [r.feature for r in res] == ["a", "b", "c"] and res[0].baseline == pytest.approx(base)
    assert {r.feature: (r.importance, r.deviation) for r in res} == {k: pytest.approx(v) for k, v in want.items()}
    assert res[-1].importance == 0
