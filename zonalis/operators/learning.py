"""Model tables with ``pyspark.ml``: preparation, candidates, folds, out-of-fold probabilities, votes, multipliers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import order, zonal

#: Candidate models by name.
MODELS: dict[str, Callable] = {
    "logistic": lambda: LogisticRegression(featuresCol="x", labelCol="label", maxIter=30, regParam=0.01),
    "tree": lambda: DecisionTreeClassifier(featuresCol="x", labelCol="label", maxDepth=5, seed=7),
    "forest": lambda: RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=20, maxDepth=6, seed=7),
    "bayes": lambda: NaiveBayes(featuresCol="x", labelCol="label", modelType="gaussian"),
}


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """The exact median of each column that has one."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e")).select("e.*")
    m = {r["c"]: r["m"] for r in zonal.quantiles(long, ["c"], "v", [0.5]).select("c", F.col("q")[0].alias("m")).collect()}  # a row for each column
    return {c: m[c] for c in columns if m.get(c) is not None}


def labelled(df: DataFrame, target: str) -> DataFrame:
    """Adds ``label``: classes in alphabetical order."""
    return StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(df).transform(df)


def folds(df: DataFrame, key: str, target: str, k: int, seed: int = 0) -> DataFrame:
    """Stratified folds by hash order, the same whatever the partitioning; no task holds a class."""
    ranked = order.numbered(df.withColumn("_h", F.xxhash64(key, F.lit(seed))), [target, "_h", key], "_at")
    first = ranked.groupBy(F.col(target).alias("_t")).agg(F.min("_at").alias("_first"))
    met = ranked.join(F.broadcast(first), F.col(target).eqNullSafe(F.col("_t")))  # a row for each class
    return met.withColumn("fold", (F.col("_at") - F.col("_first")) % k).drop("_h", "_at", "_t", "_first")


def shuffled(df: DataFrame, key: str, columns: list[str], seed: int = 0) -> DataFrame:
    """``df`` with the values of ``columns`` handed round together: row i in the order of ``key`` gets those of row i in the order of a hash.

    Both orders are numbered globally and meet in a join, so no task or driver
    holds a column.  ``key`` must be unique.
    """
    given = df.select(F.xxhash64(key, F.lit(seed)).alias("_h"), F.col(key).alias("_k"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    given = order.numbered(given, ["_h", "_k"], "_at").drop("_h", "_k")
    met = order.numbered(df, [key], "_at").join(given, "_at")
    return met.select(*[F.col(f"_v{columns.index(c)}").alias(c) if c in columns else F.col(c) for c in df.columns])


def permutation_importance(score: Callable[[DataFrame], DataFrame], df: DataFrame, key: str, columns: list[str], label: str = "label", prediction: str = "prediction", seeds: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """feature, importance (mean loss of accuracy over ``seeds`` when its values are shuffled), deviation (sample), baseline; most important first, then by name.

    ``score`` adds the predictions, as a fitted model's ``transform`` does.  A
    number for each feature and seed reaches the driver.
    """
    accuracy = lambda d: score(d).agg(F.avg((F.col(prediction) == F.col(label)).cast("double"))).first()[0]
    base, rows = accuracy(df), []
    for c in columns:
        lost = [base - accuracy(shuffled(df, key, [c], s)) for s in seeds]
        mean = sum(lost) / len(lost)
        deviation = (sum((x - mean) ** 2 for x in lost) / (len(lost) - 1)) ** 0.5 if len(lost) > 1 else None
        rows.append((c, mean, deviation, base))
    return df.sparkSession.createDataFrame(sorted(rows, key=lambda r: (-r[1], r[0])), "feature string, importance double, deviation double, baseline double")


def out_of_fold(df: DataFrame, key: str, models: list[str], k: int, columns: list[str]) -> DataFrame:
    """Long table (row, model, class, p): each row scored by a model that didn't see its fold.

    Medians that stand for missing numbers, and the scale, are those of the
    training rows alone.
    """
    out = None
    for i in range(k):
        train, rest = df.where(F.col("fold") != i), df.where(F.col("fold") == i)
        fill = medians(train, columns)
        if fill:
            train, rest = train.na.fill(fill), rest.na.fill(fill)
        for name in models:
            stages = [VectorAssembler(inputCols=columns, outputCol="_v"), StandardScaler(inputCol="_v", outputCol="x", withMean=True), MODELS[name]()]
            got = Pipeline(stages=stages).fit(train).transform(rest)
            long = got.select(F.col(key).alias("row"), F.lit(name).alias("model"), F.posexplode(vector_to_array("probability")).alias("class", "p"))
            out = long if out is None else out.unionByName(long)
    return out


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Adds weight: rows / (classes x rows of the class)."""
    c = df.groupBy(target).agg(F.count("*").alias("_c"))
    t = c.agg(F.sum("_c").alias("_n"), F.count("*").alias("_k"))
    return df.join(F.broadcast(c.crossJoin(t)), target).withColumn("weight", F.col("_n") / (F.col("_k") * F.col("_c"))).drop("_c", "_n", "_k")  # a row for each class


def oversample(df: DataFrame, target: str) -> DataFrame:
    """Whole copies of the smaller classes' rows, as many as fit into the largest class."""
    c = df.groupBy(target).agg(F.count("*").alias("_c"))
    top = c.agg(F.max("_c").alias("_m"))
    n = c.crossJoin(top).select(target, F.floor(F.col("_m") / F.col("_c")).cast("int").alias("_r"))
    return df.join(F.broadcast(n), target).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_r")))).drop("_r")  # a row for each class
