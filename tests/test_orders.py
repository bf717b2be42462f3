"""Ranks and shares over a global order against plain counts."""

import random

import pytest

from zonalis.operators import ranking, screening


def test_ecdf_and_auc_with_nulls_and_ties(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 0.5, 1.0, 1.5, 2.0, 9.0])) for _ in range(200)]
    got = screening.ecdf(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()
    want = {(g, v): sum(h == g and w is not None and w <= v for h, w in rows) / sum(h == g and w is not None for h, w in rows) for g, v in rows if v is not None}
    assert {(r.g, r.v): r.share for r in got} == pytest.approx(want) and len(got) == len(want)

    long = [(i, c, rng.randint(0, 6) / 4, i % 3) for i in range(90) for c in range(4)]
    got = {r["class"]: r for r in ranking.auc_ovr(spark.createDataFrame(long, "row int, class int, p double, t int"), "t").collect()}
    for c in range(3):
        yes, no = ([p for _, k, p, t in long if k == c and (t == c) is side] for side in (True, False))
        pairs = sum((a > b) + (a == b) / 2 for a in yes for b in no)
        assert got[c].auc == pytest.approx(pairs / len(yes) / len(no)) and got[c].positives == 30
    assert got[3].auc is None


def test_metric_row(spark):
    long = [(i, c, 0.8 if c == (i + (i % 7 == 0)) % 2 else 0.2, i % 2 if i % 11 else None) for i in range(60) for c in (0, 1)]
    got = ranking.metric_row(spark.createDataFrame(long, "row int, class int, p double, t int"), "t").first()
    known = [i for i in range(60) if i % 11]
    assert got.accuracy == pytest.approx(sum(i % 7 != 0 for i in known) / len(known)) and 0.5 < got.roc_auc_weighted <= 1
