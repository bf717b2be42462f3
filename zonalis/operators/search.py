"""Successive halving over model candidates, and the evaluation curves of their scores."""

from __future__ import annotations

import itertools
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LinearSVC, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import shared
from . import learning, order

#: Names of the models that ``estimator`` knows.
CATALOGUE = (*learning.MODELS, "bagging", "boosting", "linear_svc", "perceptron")


def estimator(name: str, features: int, classes: int, params: dict | None = None):
    """An estimator of the catalogue with ``params`` set: of ``x`` and ``label``; classes beyond two are one against the rest where the model knows two only."""
    params = dict(params or {})
    of = {"featuresCol": "x", "labelCol": "label"}
    if name in learning.MODELS:
        return learning.MODELS[name]().setParams(**params)
    if name == "bagging":  # trees of bootstrap rows that see every feature
        return RandomForestClassifier(**of, featureSubsetStrategy="all", **{"numTrees": 20, "seed": 7, **params})
    if name == "boosting":
        return OneVsRest(**of, classifier=GBTClassifier(**{"maxIter": 20, "maxDepth": 3, "seed": 7, **params}))
    if name == "linear_svc":
        return OneVsRest(**of, classifier=LinearSVC(**{"maxIter": 50, "regParam": 0.01, **params}))
    if name == "perceptron":
        hidden = params.pop("hidden", 16)
        return MultilayerPerceptronClassifier(**of, layers=[features, hidden, classes], **{"maxIter": 100, "seed": 7, **params})
    raise ValueError(f"unknown model {name!r}: one of {', '.join(CATALOGUE)}")


def pipeline(name: str, columns: list[str], classes: int, params: dict | None = None) -> Pipeline:
    """Assembled and scaled features, then the estimator."""
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="_v"), StandardScaler(inputCol="_v", outputCol="x", withMean=True), estimator(name, len(columns), classes, params)])


def scores_of(scored: DataFrame) -> Column:
    """An array of a probability for each class: the model's, or the softmax of its raw scores where it has none."""
    if "probability" in scored.columns:
        return vector_to_array("probability")
    raw = vector_to_array("rawPrediction")
    e = F.transform(raw, lambda x: F.exp(x - F.array_max(raw)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def drawn(grids: dict[str, dict[str, list]], most: int, seed: int = 0) -> list[tuple[str, dict]]:
    """Candidates (model, parameters): at most ``most`` of each model's grid, without replacement, the same for the same seed."""
    out = []
    for name in sorted(grids):
        keys = sorted(grids[name])
        every = [dict(zip(keys, v)) for v in itertools.product(*[grids[name][k] for k in keys])]
        picked = every if len(every) <= most else [every[i] for i in sorted(random.Random(f"{seed}/{name}").sample(range(len(every)), most))]
        out += [(name, p) for p in picked]
    return out


def accuracy(scored: DataFrame) -> float:
    """The share of rows whose prediction is their label."""
    return scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] or 0.0


def macro_f1(scored: DataFrame) -> float:
    """The mean F1 of the classes that occur; a row for each pair of classes reaches the driver."""
    conf = {(r["label"], r["prediction"]): r["n"] for r in scored.groupBy("label", "prediction").agg(F.count("*").alias("n")).collect()}
    seen = {c for pair in conf for c in pair}
    f1 = [2 * conf.get((c, c), 0) / sum(n * ((a == c) + (b == c)) for (a, b), n in conf.items()) for c in seen]
    return sum(f1) / len(f1) if f1 else 0.0


def rungs(rows: int, candidates: int, least: int, factor: int = 2) -> list[int]:
    """Rows of each rung: ``least``, then ``factor`` times as many, until one candidate is left or all rows are taken."""
    out = [min(least, rows)]
    while out[-1] < rows and (candidates := math.ceil(candidates / factor)) > 1:
        out.append(min(out[-1] * factor, rows))
    return out


def halving(df: DataFrame, key: str, columns: list[str], candidates: list[tuple[str, dict]], k: int, least: int, factor: int = 2, score=accuracy, seed: int = 0, parallelism: int = 4, fit=pipeline) -> DataFrame:
    """rung, rows, candidate, model, params (JSON), fold_scores, mean, deviation (population), mean_minus_deviation, kept, best.

    ``df`` has ``label`` (whole numbers from nought) and ``fold`` (0 to k - 1).
    Each rung scores its candidates by the ``k`` folds on the rows of least
    hash of ``key``, ``factor`` times as many as the rung before, and keeps
    the best of every ``factor`` (ties: the earlier candidate): no model sees
    more rows than its rung's.  Rungs are nested and the same whatever the
    partitioning.  Up to ``parallelism`` candidates are fitted at a time.  The
    best candidate is the best of the last rung.  Medians that stand for
    missing numbers are those of the training rows alone.  ValueError without
    rows or candidates.  Only scores reach the driver.
    """
    ranked = shared.stored(order.numbered(df.withColumn("_h", F.xxhash64(key, F.lit(seed))), ["_h", key], "_at").drop("_h"), "halving")
    rows, top = ranked.agg(F.count("*"), F.max("label")).first()
    if not rows or not candidates:
        raise ValueError("a search takes rows and candidates")
    classes, alive, out = max(int(top) + 1, 2), list(range(len(candidates))), []
    for rung, n in enumerate(rungs(rows, len(candidates), least, factor)):
        part = ranked.where(F.col("_at") <= n)
        sides = []
        for i in range(k):
            train, rest = part.where(F.col("fold") != i), part.where(F.col("fold") == i)
            fill = learning.medians(train, columns)
            sides.append((train.na.fill(fill), rest.na.fill(fill)) if fill else (train, rest))

        def tried(c: int) -> list[float]:
            name, params = candidates[c]
            return [score(fit(name, columns, classes, params).fit(train).transform(rest)) for train, rest in sides]  # noqa: B023

        with ThreadPoolExecutor(parallelism) as pool:
            got = dict(zip(alive, pool.map(tried, alive)))
        means = {c: sum(s) / k for c, s in got.items()}
        ranking = sorted(alive, key=lambda c: (-means[c], c))  # noqa: B023
        kept = set(ranking[: math.ceil(len(alive) / factor)])
        for c in ranking:
            deviation = (sum((x - means[c]) ** 2 for x in got[c]) / k) ** 0.5
            out.append([rung, n, c, candidates[c][0], json.dumps(candidates[c][1], sort_keys=True), got[c], means[c], deviation, means[c] - deviation, c in kept, False])
        last, alive = ranking[0], sorted(kept)
    for r in out:
        r[-1] = r[0] == out[-1][0] and r[2] == last
    return df.sparkSession.createDataFrame([tuple(r) for r in out], "rung int, rows long, candidate int, model string, params string, fold_scores array<double>, mean double, deviation double, mean_minus_deviation double, kept boolean, best boolean")


def curves(long: DataFrame, truth: str) -> DataFrame:
    """class, threshold, hits, false_alarms, hit_rate, false_alarm_rate, precision: a point for each distinct score of each class against the rest.

    ``long`` has class, p and ``truth``.  Equal scores are one point, counted
    first; the counts run over a global order, so no task holds a class.  A
    rate without rows to divide by is null; null scores have no point but
    count as misses of every threshold.
    """
    yes = F.coalesce(F.col(truth) == F.col("class"), F.lit(False))
    freq = long.groupBy("class", "p").agg(F.count("*").alias("_n"), F.count_if(yes).alias("_pos"))
    total = freq.groupBy("class").agg(F.sum("_pos").alias("_all"), (F.sum("_n") - F.sum("_pos")).alias("_rest"))
    d = freq.where("p is not null").withColumn("_q", -F.col("p"))
    d = order.running_sums(d, ["class", "_q"], {"_tp": F.col("_pos"), "_seen": F.col("_n")})
    base = d.groupBy(F.col("class").alias("_k")).agg(F.min("_tp").alias("_tp0"), F.min("_seen").alias("_seen0"))
    d = d.join(F.broadcast(base), F.col("class").eqNullSafe(F.col("_k"))).drop("_k")  # a row for each class
    d = d.join(F.broadcast(total.withColumnRenamed("class", "_k")), F.col("class").eqNullSafe(F.col("_k")))  # a row for each class
    hits = F.col("_tp") - F.col("_tp0") + F.col("_pos")
    seen = F.col("_seen") - F.col("_seen0") + F.col("_n")
    ratio = lambda a, b: F.when(b > 0, a / b)
    return d.select("class", F.col("p").alias("threshold"), hits.alias("hits"), (seen - hits).alias("false_alarms"), ratio(hits, F.col("_all")).alias("hit_rate"), ratio(seen - hits, F.col("_rest")).alias("false_alarm_rate"), ratio(hits, seen).alias("precision"))
