"""Ensembles in a row: the same as the long table, and no row moves."""

from pyspark.sql import functions as F

from zonalis.operators import ranking
from zonalis.plans import QUERIES
from zonalis.plans.decisions import ensembles, probabilities
from zonalis.plans.registry import Tables


def test_confidence_within_equals_the_long_table(spark, small):
    t = Tables(spark, small)
    p = probabilities(t)
    long, own = ranking.confidence(ranking.ranks(p), ranking.vote(p)), ranking.confidence_within(ensembles(t))
    cols = ["row", "prediction", "winner", "tied", "agrees", "level", "valid", "reason", "n_models", "rank_range", "top1_agreement", *[F.round(c, 9).alias(c) for c in ("mean_borda", "mean_rank", "median_rank", "rank_std", "rank_iqr")]]
    a, b = (sorted(map(tuple, d.select(*cols).collect())) for d in (long, own))
    assert len(a) > 100 and a == b


def test_ensembles_are_judged_where_they_lie(spark, small):
    for name in ("rank_confidence_levels",):
        assert "Exchange" not in QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for name in ("confidence_summary",):  # nothing is gathered by row
        assert "hashpartitioning(row#" not in QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
