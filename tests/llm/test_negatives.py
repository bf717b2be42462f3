"""Hard negatives by distance keys against a plain search of all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, row int, pivot string"


def plain(rows, anchors=50, positives=5, keep=3, low=50, high=95):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor, by comparing all rows."""
    some = []
    for i, r in enumerate(rows):
        if r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]):
            some.append((i, r[0], r[2], [math.floor(256.0 * float(np.float32(x))) for x in r[1]]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    out = []
    for i, id_, label, v in some:
        if id_ is None or id_ % anchors:
            continue
        score = [(dot(v, w), k, j, lab) for j, k, lab, w in some if j != i]
        for p in sorted([x for x in score if x[3] == label], key=order)[:positives]:
            found = [x for x in score if x[3] != label and low * p[0] <= 100 * x[0] <= high * p[0]]
            out += [(id_, p[1], n + 1, x[1], p[0], x[0]) for n, x in enumerate(sorted(found, key=order)[:keep])]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame([tuple(r) + ("x", 1, "y") for r in rows], SCHEMA)
    got = negatives.mine(df, F.col("vec_id") % 50 == 0, **options)
    return sorted((tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def points(n, width, seed, labels=4, spread=1.0, centres=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * spread
    if centres:
        x += rng.normal(size=(centres, width))[rng.integers(0, centres, n)] * 4
    return [(i * 5, [float(v) for v in r], int(rng.integers(0, labels))) for i, r in enumerate(x)]


@pytest.mark.parametrize("block, per, share, pivots", [(7, 3, 2, 5), (64, 100, 64, 1), (16, 2, 1, 12)])
def test_equals_all_rows(spark, block, per, share, pivots):
    rows = points(230, 6, block)
    assert mined(spark, rows, block=block, per=per, share=share, pivots=pivots) == plain(rows)


def test_ties_copies_and_odd_rows(spark):
    rows = points(150, 3, 5, spread=0.01)  # whole numbers of a few values: scores tie
    rows += [(r[0], r[1], r[2]) for r in rows[::10]]  # repeated rows, anchors among them
    rows += [(1000 + i, [0.5, 0.25, 0.125], i % 3) for i in range(90)]  # a common vector
    rows += [(50, None, 1), (100, [1.0, None, 0.0], 1), (150, [float("nan"), 1.0, 1.0], 2), (200, [float("inf"), 0.0, 0.0], 2), (250, [1.0, 1.0, 1.0], None), (None, [0.3, 0.3, 0.3], 1), (None, [0.3, 0.3, 0.3], 2)]
    rows += [(300, [], 1), (350, [0.7], 2), (400, [0.2, 0.1, 0.9], 7)]  # shorter vectors; a label of its own
    assert mined(spark, rows, block=16, per=8, share=3, pivots=6) == plain(rows)


def test_negative_scores_and_few_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.1], 1), (2, [0.0, 0.0], 1), (3, [-0.7, 0.2], 2), (4, [0.0, 1.0], 2), (50, [0.5, 0.5], 3)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows[:1]) == []
    assert negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_large_components(spark):
    rows = [(i, [5e5 * (i % 7 + 1), -2e5 * (i % 5), 1e4 * i], i % 2) for i in range(60)]  # scores beyond 2^53 are exact
    assert max(abs(x[4]) for x in plain(rows)) > 2**55
    assert mined(spark, rows, block=8, pivots=3) == plain(rows)
    with pytest.raises(ValueError, match="scale"):
        mined(spark, [(0, [1e9, 1e9], 1), (1, [1e9, 1.0], 1)])


def test_wide_gaps_leave_keys_unread(spark, monkeypatch):
    """On clustered vectors the annuli leave out most blocks; nothing else changes."""
    rows = points(1200, 4, 9, spread=0.002, centres=12)
    read = []
    real = negatives.stored

    def counting(df, name):
        out = real(df, name)
        if name == "pairs":
            read.append((out.count(), out.select("block").distinct().count()))
        return out

    monkeypatch.setattr(negatives, "stored", counting)
    got = mined(spark, rows, block=16, per=2, pivots=12)
    assert got == plain(rows)
    blocks, queries = len(rows) // 16, len([r for r in rows if r[0] % 50 == 0]) / 2
    assert read and sum(n for n, _ in read) < len(read) * blocks * queries / 2
