"""Nearest searches over crowds: the pairs that they meet, and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonalis.operators import joins, spatial
from zonalis.plans import QUERIES


@pytest.fixture
def met(monkeypatch):
    """The pairs that each call of ``within`` gave."""
    seen, plain = [], joins.within

    def counted(*args, **kwargs):
        out = plain(*args, **kwargs)
        seen.append(out.count())
        return out

    monkeypatch.setattr(joins, "within", counted)
    return seen


def test_synthetic_points_of_a_crowd_meet_few_pairs(spark, met):
    near = spark.range(1500).select("id", (F.col("id") % 40 / 1000.0).alias("x"), (F.col("id") % 7 / 1000.0).alias("y"))
    assert spatial.synthetic(near, "id", "x", "y", 0.5).count() == 1500
    assert sum(met) < 40 * 1500  # all pairs: 2.2 million


def test_synthetic_points_equal_brute_force(spark):
    r = random.Random(3)
    rows = [(k, float(r.randrange(12)), float(r.randrange(12)) / 4) for k in range(120)] + [(500, 100.0, 100.0), (501, None, 1.0), (7, 55.0, 0.0), (8, 55.5, 0.25)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    got = {(r["k"], round(r["x"], 9), round(r["y"], 9)) for r in spatial.synthetic(df, "k", "x", "y", 1.0).collect()}
    u = {r["k"]: r["u"] for r in df.select("k", (F.pmod(F.xxhash64("k", F.lit(0)), F.lit(1000003)) / F.lit(1000003.0)).alias("u")).collect()}
    want = set()
    for k, x, y in rows:
        others = [(math.hypot(x - x2, y - y2), k2, x2, y2) for k2, x2, y2 in rows if k2 != k and None not in (x, x2)]
        d, _, x2, y2 = min(others, default=(9, 0, 0, 0))
        if d <= 1.0:
            want.add((k, round(x + (x2 - x) * u[k], 9), round(y + (y2 - y) * u[k], 9)))
    assert got == want


def test_nearest_point_join_meets_few_pairs(spark, tmp_path, met):
    e = spark.range(4000).select(F.col("id").alias("vec_id"), F.array(F.rand(1).cast("float") / 10, F.rand(2).cast("float") / 10).cast("array<float>").alias("embedding"), (F.col("id") % 2).cast("int").alias("label"))
    e.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["nearest_point_join"](spark, str(tmp_path)).where("near_id is not null").count() == 2000
    assert sum(met) < 40 * 4000  # all pairs: 4 million
