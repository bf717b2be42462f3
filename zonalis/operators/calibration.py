"""Probabilities from decision scores: a sigmoid per class fitted by Newton steps on sums, or a softmax."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Sigmoids = dict[str, tuple[float, float]]


def sigmoids(scores: DataFrame, steps: int = 60, close: float = 1e-10) -> Sigmoids | None:
    """Of each class the (a, b) of 1 / (1 + exp(a score + b)) with the least cross entropy, one class against the rest.

    ``scores``: class, score, hit (whether the row is of the class), out of
    fold.  Targets are Platt's: (n1 + 1) / (n1 + 2) and 1 / (n0 + 2).  A step is
    one grouped sum over all rows for all classes; a step that does not lessen the
    loss is halved.  None if a class has fewer than two rows or no others.
    """
    count = scores.groupBy("class").agg(F.count_if("hit").alias("n1"), F.count_if(~F.col("hit")).alias("n0")).collect()  # a row a class
    if not count or any(r.n1 < 2 or r.n0 < 1 for r in count):
        return None
    spark = scores.sparkSession
    at = {r["class"]: (0.0, math.log((r.n0 + 1) / (r.n1 + 1))) for r in count}
    ends = {r["class"]: ((r.n1 + 1) / (r.n1 + 2), 1 / (r.n0 + 2)) for r in count}
    loss, step, done = {c: math.inf for c in at}, {c: (0.0, 0.0) for c in at}, set()
    base = dict(at)
    for _ in range(steps):
        now = spark.createDataFrame([(c, *map(float, at[c]), *ends[c]) for c in at if c not in done], "class string, a double, b double, high double, low double")
        z = F.col("a") * F.col("score") + F.col("b")
        t = F.when(F.col("hit"), F.col("high")).otherwise(F.col("low"))
        p = F.when(z >= 0, F.exp(-z) / (1 + F.exp(-z))).otherwise(1 / (1 + F.exp(z)))
        cost = F.when(z >= 0, t * z + F.log1p(F.exp(-z))).otherwise((t - 1) * z + F.log1p(F.exp(z)))
        d, w, s = t - p, p * (1 - p), F.col("score")
        sums = scores.join(F.broadcast(now), "class").groupBy("class").agg(F.sum(cost).alias("f"), F.sum(d * s).alias("ga"), F.sum(d).alias("gb"), F.sum(w * s * s).alias("haa"), F.sum(w * s).alias("hab"), F.sum(w).alias("hbb")).collect()  # a row a class
        for r in sums:
            c = r["class"]
            if r.f > loss[c] + 1e-12 * abs(loss[c]):  # too far: half the step
                step[c] = (step[c][0] / 2, step[c][1] / 2)
                at[c] = (base[c][0] + step[c][0], base[c][1] + step[c][1])
                if max(map(abs, step[c])) < close:
                    at[c] = base[c]
                    done.add(c)
                continue
            loss[c], base[c] = r.f, at[c]
            haa, hbb = r.haa + 1e-12, r.hbb + 1e-12
            det = haa * hbb - r.hab * r.hab
            step[c] = (-(hbb * r.ga - r.hab * r.gb) / det, -(haa * r.gb - r.hab * r.ga) / det)
            if max(map(abs, step[c])) < close * (1 + max(map(abs, at[c]))):
                done.add(c)
            else:
                at[c] = (at[c][0] + step[c][0], at[c][1] + step[c][1])
        if len(done) == len(at):
            break
    return base


def _shares(scores: DataFrame, weight: Column) -> DataFrame:
    """Weights as shares of their row; equal ones where all are nought."""
    w = Window.partitionBy("row")
    total = F.sum("_w").over(w)
    return scores.withColumn("_w", weight).withColumn("p", F.when(total > 0, F.col("_w") / total).otherwise(1 / F.count("*").over(w))).drop("_w")


def probabilities(scores: DataFrame, fitted: Sigmoids | None) -> DataFrame:
    """Adds ``p`` to (row, class, score): the sigmoids' values, normalised over a row's classes; without sigmoids the softmax of the scores."""
    if fitted is None:
        top = F.max("score").over(Window.partitionBy("row"))
        return _shares(scores, F.exp(F.col("score") - top))
    now = scores.sparkSession.createDataFrame([(c, float(a), float(b)) for c, (a, b) in fitted.items()], "class string, _a double, _b double")
    z = F.col("_a") * F.col("score") + F.col("_b")
    p = F.when(z >= 0, F.exp(-z) / (1 + F.exp(-z))).otherwise(1 / (1 + F.exp(z)))
    return _shares(scores.join(F.broadcast(now), "class"), p).drop("_a", "_b")  # a row a class
