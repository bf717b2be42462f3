"""Quantiles of whole columns: equal to ``percentile``, without its buffer of a column's values."""

import pytest
from pyspark.sql import functions as F

from zonalis.operators import cleaning, learning, profile, screening, zonal
from zonalis.plans import QUERIES

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("value", ["cast(id * 7919 % 10007 as double)", "cast(id % 3 as double)", "if(id % 5 = 0, null, if(id % 7 = 0, double('nan'), if(id % 11 < 2, double('inf'), -id / 3.0)))", "if(id % 2 = 0, 1e300, -1e300)", "cast(null as double)"])
def test_quantiles_equal_percentile(spark, value):
    df = spark.range(20000).selectExpr("if(id % 5000 < 4, 9, id % 2) as g", f"{value} as v").union(spark.sql("select null, 4d union all select 7, null"))
    for keys in ([], ["g"]):
        want = {str(r[:-2]): r[-2:] for r in df.groupBy(*keys).agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, PROBS))).alias("q")).collect()}
        got = {str(r[:-2]): r[-2:] for r in zonal.quantiles(df, keys, "v", PROBS).collect()}
        assert {k: (n, str(q or [None] * len(PROBS))) for k, (n, q) in want.items()} == {k: (n, str(q)) for k, (n, q) in got.items()}


def test_whole_columns_use_no_percentile_buffer(spark, small):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), (F.col("id") / 7).alias("v"))
    plans = [cleaning.fences(df, [], "v"), profile.numeric_summary(df, ["v"]), profile.robust_summary(df, ["v"]), screening.box_plot(df, "g", "v")]
    plans += [QUERIES[n](spark, small) for n in ("outlier_univariate_summary", "outlier_vote", "model_feature_cleaning", "numeric_summary", "robust_summary", "box_plots")]
    for p in plans:
        assert " percentile(" not in p._jdf.queryExecution().optimizedPlan().toString()


def test_robust_summary_without_rows_or_with_ties(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 30 + [(5.0, 2.0)] * 3 + [(None, 2.0)], "a double, b double")
    r = {x["column_name"]: x for x in profile.robust_summary(df, ["a", "b"]).collect()}
    assert r["a"]["trimmed_mean"] == 1.0 and r["b"]["trimmed_mean"] == 2.0 and r["b"]["mad"] == 0.0
    assert profile.robust_summary(df.limit(0), ["a"]).collect() == []
    assert learning.medians(spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double"), ["a", "b"]) == {"a": 1.5}
