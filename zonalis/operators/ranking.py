"""Ensembles and evaluation over long tables (row, model, class, p): ranks, Borda scores, confidence levels, votes, metrics."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import borda
from ..sources import shared
from . import order

#: Least Borda score and largest rank range of the two upper levels.
LEVELS = {"HIGH": (90.0, 2.0), "MEDIUM": (75.0, 4.0)}
#: Precision of the two upper reliability levels, and the least support.
PRECISION = {"HIGH": 0.80, "MEDIUM": 0.60}
LEAST_SUPPORT = 100


def ranks(long: DataFrame) -> DataFrame:
    """Adds rank (mean of ties, best 1) within row and model, n_classes and the Borda score.

    A row's probabilities by one model are few: they are gathered once and a
    rank is counted within them, in one exchange and without sorting by p.
    """
    p = F.col("_all")
    above, same = F.size(F.filter(p, lambda x: x > F.col("p"))), F.size(F.filter(p, lambda x: x == F.col("p")))
    own = long.withColumn("_all", F.collect_list("p").over(Window.partitionBy("row", "model")))
    own = own.withColumn("rank", above + (same + 1) / F.lit(2.0)).withColumn("n_classes", F.size("_all").cast("long")).drop("_all")
    return own.withColumn("borda", borda(F.col("rank"), F.col("n_classes").cast("double")))


def vote(long: DataFrame) -> DataFrame:
    """Per row: the class of greatest mean probability (ties: first class) and that mean."""
    mean = long.groupBy("row", "class").agg(F.avg("p").alias("p"))
    best = mean.groupBy("row").agg(F.min_by("class", F.struct(-F.round("p", 12), F.col("class"))).alias("prediction"), F.max("p").alias("probability"))
    return best


def confidence(ranked: DataFrame, predicted: DataFrame, least_models: int = 3) -> DataFrame:
    """Per row: the predicted class's Borda mean and rank spread over the models, the winner, level, validity and reason."""
    mean = ranked.groupBy("row", "class").agg(F.avg("borda").alias("b"))
    score = F.round("b", 9)
    top = mean.groupBy("row").agg(F.max(score).alias("_top"), F.min_by("class", F.struct(-score, F.col("class"))).alias("winner"))
    tie = mean.join(top, "row").groupBy("row").agg(F.count_if(F.abs(score - F.col("_top")) <= 1e-9).alias("_n"))
    own = ranked.join(predicted.select("row", "prediction"), "row").where(F.col("class") == F.col("prediction"))
    own = own.groupBy("row").agg(F.first("prediction").alias("prediction"), F.avg("borda").alias("mean_borda"), F.avg("rank").alias("mean_rank"), F.percentile("rank", F.lit(0.5)).alias("median_rank"), F.stddev_pop("rank").alias("rank_std"), (F.percentile("rank", F.lit(0.75)) - F.percentile("rank", F.lit(0.25))).alias("rank_iqr"), (F.max("rank") - F.min("rank")).alias("rank_range"), F.count("*").alias("n_models"), F.avg((F.col("rank") == 1).cast("double")).alias("top1_agreement"))
    return _levelled(own.join(top, "row").join(tie, "row"), least_models)


def _levelled(out: DataFrame, least_models: int) -> DataFrame:
    out = out.withColumn("tied", F.col("_n") > 1).withColumn("agrees", F.col("winner") == F.col("prediction"))
    ok = F.col("n_models") >= least_models
    fit = {k: F.col("agrees") & ~F.col("tied") & (F.col("mean_borda") >= b) & (F.col("rank_range") <= r) for k, (b, r) in LEVELS.items()}
    level = F.when(ok & fit["HIGH"], "HIGH").when(ok & fit["MEDIUM"], "MEDIUM").otherwise("LOW")
    why = F.when(~ok, "insufficient_models").when(F.col("tied"), "borda_winner_tie").when(~F.col("agrees"), "soft_vote_borda_disagreement")
    return out.withColumn("level", level).withColumn("valid", ok).withColumn("reason", why.otherwise(F.concat(F.lit("rank_confidence_"), F.lower("level")))).drop("_n", "_top")


def class_means(ps: Column) -> Column:
    """Of an ensemble (an array over models of arrays over classes): the mean probability of each class."""
    return F.transform(ps[0], lambda _, k: F.aggregate(ps, F.lit(0.0), lambda s, m: s + m[k]) / F.size(ps))


def class_ranks(ps: Column) -> Column:
    """Of an ensemble: the rank of each class (mean of ties, best 1) by each model, as ``ranks`` has it."""
    return F.transform(ps, lambda m: F.transform(m, lambda p: F.size(F.filter(m, lambda x: x > p)) + (F.size(F.filter(m, lambda x: x == p)) + 1) / F.lit(2.0)))


def first_best(scores: Column, places: int) -> Column:
    """The class, from 1, of the greatest score as rounded; ties: the first."""
    near = F.transform(scores, lambda x: F.round(x, places))
    return F.array_position(near, F.array_max(near)).cast("int")


def confidence_within(df: DataFrame, ps: str = "ps", least_models: int = 3) -> DataFrame:
    """Adds ``confidence`` to rows that hold an ensemble each (classes are numbered from 1): no row moves."""
    sum_ = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    d = df.withColumn("_m", class_means(F.col(ps))).withColumn("_r", class_ranks(F.col(ps))).withColumn("prediction", first_best(F.col("_m"), 12))
    d = d.withColumn("_b", F.transform("_r", lambda m: F.transform(m, lambda r: borda(r, F.size(m).cast("double")))))
    d = d.withColumn("_s", F.transform(class_means(F.col("_b")), lambda x: F.round(x, 9))).withColumn("_top", F.array_max("_s"))
    d = d.withColumn("winner", first_best(F.col("_s"), 9)).withColumn("_n", F.size(F.filter("_s", lambda x: F.abs(x - F.col("_top")) <= 1e-9)))
    d = d.withColumn("_own", F.array_sort(F.transform("_r", lambda m: m[F.col("prediction") - 1]))).withColumn("n_models", F.size("_own").cast("long"))
    d = d.withColumn("mean_borda", sum_(F.transform("_b", lambda m: m[F.col("prediction") - 1])) / F.col("n_models")).withColumn("mean_rank", sum_(F.col("_own")) / F.col("n_models"))

    def quantile(q: float) -> Column:
        at = F.lit(q) * (F.col("n_models") - 1)
        a, b = (F.col("_own")[f(at).cast("int")] for f in (F.floor, F.ceil))
        return F.when(a == b, a).otherwise((F.ceil(at) - at) * a + (at - F.floor(at)) * b)

    d = d.withColumn("median_rank", quantile(0.5)).withColumn("rank_iqr", quantile(0.75) - quantile(0.25)).withColumn("rank_range", F.array_max("_own") - F.array_min("_own"))
    d = d.withColumn("rank_std", F.sqrt(sum_(F.transform("_own", lambda x: (x - F.col("mean_rank")) ** 2)) / F.col("n_models")))
    d = d.withColumn("top1_agreement", F.size(F.filter("_own", lambda x: x == 1)) / F.col("n_models"))
    return _levelled(d, least_models).drop("_m", "_r", "_b", "_s", "_own")


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_metrics(conf: DataFrame) -> DataFrame:
    """Per class: support, predicted, correct, precision, recall, f1 (nought where undefined)."""
    t = conf.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("support"))
    p = conf.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("predicted"))
    c = conf.where("truth = predicted").select(F.col("truth").alias("class"), F.col("n").alias("correct"))
    out = t.join(p, "class", "full_outer").join(c, "class", "left").na.fill(0, ["support", "predicted", "correct"])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    out = out.withColumn("precision", ratio(F.col("correct"), F.col("predicted"))).withColumn("recall", ratio(F.col("correct"), F.col("support")))
    return out.withColumn("f1", ratio(2 * F.col("correct"), F.col("support") + F.col("predicted")))


def metrics(conf: DataFrame) -> DataFrame:
    """One row: accuracy, balanced accuracy, macro and weighted F1, weighted precision and recall."""
    m = class_metrics(conf)
    w = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    return m.agg((F.sum("correct") / F.sum("support")).alias("accuracy"), F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"), F.avg("f1").alias("f1_macro"), w("f1").alias("f1_weighted"), w("precision").alias("precision_weighted"), w("recall").alias("recall_weighted"))


def metric_row(long: DataFrame, truth: str, top: DataFrame | None = None) -> DataFrame:
    """One row from a table (row, class, p, truth): ``metrics`` of the likeliest class (ties: the first) and roc_auc_weighted, the classes' areas by their rows.

    Rows without truth take no part.  Classes that are never or always the
    truth have no area; where none has one it is null.  ``top``: truth and
    predicted of each row, where they are at hand and need no gathering.
    """
    known = long.where(F.col(truth).isNotNull())
    if top is None:
        top = known.groupBy("row").agg(F.first(truth).alias("truth"), F.min_by("class", F.struct(-F.col("p"), "class")).alias("predicted"))
    areas = auc_ovr(known, truth).where("auc is not null").agg(F.try_divide(F.sum(F.col("auc") * F.col("positives")), F.sum("positives")).alias("roc_auc_weighted"))
    return metrics(confusion(top, "truth", "predicted")).crossJoin(areas)  # one row each


def class_reliability(df: DataFrame, truth: str, predicted: str, least: int = LEAST_SUPPORT) -> DataFrame:
    """Per predicted class: support, correct, precision, level, validity and reason."""
    g = df.groupBy(F.col(predicted).alias("class")).agg(F.count("*").alias("support"), F.count_if(F.col(truth) == F.col(predicted)).alias("correct"))
    g = g.withColumn("precision", F.col("correct") / F.col("support"))
    p, few = F.col("precision"), F.col("support") < least
    level = F.when(few, "LOW").when(p >= PRECISION["HIGH"], "HIGH").when(p >= PRECISION["MEDIUM"], "MEDIUM").otherwise("LOW")
    why = F.when(few, "insufficient_oof_class_support").when(p >= PRECISION["HIGH"], "sufficient_oof_support").when(p >= PRECISION["MEDIUM"], "precision_below_high_threshold").otherwise("precision_below_medium_threshold")
    return g.withColumn("level", level).withColumn("valid", ~few).withColumn("reason", why)


def auc_ovr(long: DataFrame, truth: str) -> DataFrame:
    """Area under the curve of each class against the rest, by mean ranks: equal scores are counted first, and the counts run over a global order, so no task holds a class."""
    freq = long.groupBy("class", "p").agg(F.count("*").alias("n"), F.count_if(F.col(truth) == F.col("class")).alias("pos"))
    at = order.running(freq, ["class", "p"], F.col("n"), "_before")
    first = at.groupBy(F.col("class").alias("_k")).agg(F.min("_before").alias("_first"))
    r = at.join(F.broadcast(first), F.col("class").eqNullSafe(F.col("_k"))).withColumn("_rank", F.col("_before") - F.col("_first") + (F.col("n") + 1) / 2)  # a row for each class
    g = r.groupBy("class").agg(F.sum(F.col("_rank") * F.col("pos")).alias("_s"), F.sum("pos").alias("positives"), F.sum("n").alias("_n"))
    neg = F.col("_n") - F.col("positives")
    return g.select("class", "positives", F.when((F.col("positives") > 0) & (neg > 0), (F.col("_s") - F.col("positives") * (F.col("positives") + 1) / 2) / (F.col("positives") * neg)).alias("auc"))


def _score(conf: dict[tuple[int, int], int]) -> tuple[float, float]:
    """Macro F1 over the classes that occur, and accuracy, of one confusion matrix."""
    n = sum(conf.values())
    seen = {c for pair in conf for c in pair}
    f1 = [2 * conf.get((c, c), 0) / sum(k * ((a == c) + (b == c)) for (a, b), k in conf.items()) for c in seen]
    return (sum(f1) / len(f1), sum(k for (a, b), k in conf.items() if a == b) / n) if n else (0.0, 0.0)


def search_multipliers(df: DataFrame, truth: str, p: str, classes: int, grid: tuple[float, ...] = (0.8, 1.0, 1.2, 1.5, 2.0), max_drop: float = 0.02, iterations: int | None = None) -> tuple[list[float], tuple[float, float], tuple[float, float]]:
    """Class multipliers of best macro F1 (ties: accuracy) whose accuracy falls by ``max_drop`` at most, and (F1, accuracy) before and after.

    ``p`` holds an array of probabilities, ``truth`` the class's place in it; of
    equal products the first class is predicted.  The classes are searched one
    after the other until a round changes none, which ends as every change is
    better than all before; ``iterations`` stops after so many rounds.  A class's
    whole grid is one pass over the stored rows, and a confusion matrix for each
    candidate is all that reaches the driver.
    """
    known = df.select(F.col(truth).cast("int").alias("t"), F.col(p).alias("p")).where("t is not null and p is not null")
    rows = shared.stored(known.select("t", *[F.get("p", F.lit(i)).alias(f"p{i}") for i in range(classes)]), "out-of-fold")

    def tried(trials: list[list[float]]) -> list[tuple[float, float]]:
        def predicted(w: list[float]):
            a = [F.col(f"p{i}") * float(x) for i, x in enumerate(w)]
            best = F.greatest(*a) if len(a) > 1 else a[0]
            return F.coalesce(*[F.when(x == best, i) for i, x in enumerate(a)])

        long = rows.select("t", F.posexplode(F.array(*[predicted(w) for w in trials])).alias("i", "y"))
        conf: list[dict] = [{} for _ in trials]
        for r in long.groupBy("i", "t", "y").agg(F.count("*").alias("n")).collect():  # trials x classes x classes
            conf[r["i"]][r["t"], r["y"]] = r["n"]
        return [_score(c) for c in conf]

    weights = [1.0] * classes
    before = best = tried([weights])[0]
    for _ in count() if iterations is None else range(iterations):
        changed = False
        for c in range(classes):
            trials = [[*weights[:c], float(x), *weights[c + 1 :]] for x in grid]
            kept = weights
            for trial, got in zip(trials, tried(trials)):
                if got[1] >= before[1] - max_drop and got > best:
                    best, kept = got, trial
            changed, weights = changed or kept != weights, kept
        if not changed:
            break
    return weights, before, best
