"""Five outlier votes a row: fences, z-scores, isolation forest, density of the principal components, Mahalanobis distance."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import shared
from . import stats
from .zonal import bracketed_quantiles, finite

VOTES = ("iqr", "zscore", "iforest", "pca_dbscan", "mahalanobis")


def standardised(df: DataFrame, columns: list[str], most: int = 8) -> dict[str, Column]:
    """Of the first ``most`` columns those that are neither empty nor constant: finite, gaps by the median, mean 0, deviation 1."""
    columns = columns[:most]
    v = {c: finite(F.col(c).cast("double")) for c in columns}
    m = df.agg(*[F.percentile(v[c], F.lit(0.5)).alias(c) for c in columns]).first()
    full = {c: F.coalesce(v[c], F.lit(float(m[c]))) for c in columns if m[c] is not None}
    if not full:
        return {}
    s = df.agg(*[F.avg(e).alias(f"m_{c}") for c, e in full.items()], *[F.stddev_pop(e).alias(f"s_{c}") for c, e in full.items()]).first()
    return {c: (e - float(s[f"m_{c}"])) / float(s[f"s_{c}"]) for c, e in full.items() if s[f"s_{c}"] > 0}


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of a search that fails in a tree of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _tree(x: np.ndarray, rng: np.random.Generator, height: int) -> tuple[np.ndarray, ...]:
    """Feature (-1: leaf), cut, left and right child, path length, for each node."""
    nodes: list[list[float]] = []

    def grow(part: np.ndarray, depth: int) -> int:
        at, span = len(nodes), np.ptp(part, axis=0) if len(part) else np.zeros(x.shape[1])
        nodes.append([-1, 0.0, 0, 0, depth + float(_mean_path(len(part)))])
        if depth < height and len(part) > 1 and span.any():
            f = int(rng.choice(np.flatnonzero(span)))
            cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            below = part[:, f] <= cut
            nodes[at][:2] = [f, cut]
            nodes[at][2], nodes[at][3] = grow(part[below], depth + 1), grow(part[~below], depth + 1)
        return at

    grow(x, 0)
    a = np.array(nodes)
    return a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]


def isolation_scores(df: DataFrame, z: list[str], by: list[str], trees: int = 100, sample: int = 256, seed: int = 42) -> Column:
    """Isolation score (0 to 1, high: lonely) from the columns ``z``.

    As the method has it, each tree grows on ``sample`` rows: they are dealt
    from at most ``trees * sample`` rows drawn by hash of the columns ``by``, all
    that the driver holds.  Every row is scored, in Arrow batches.
    """
    order = [F.xxhash64(*by, F.lit(seed)), *by]
    pool = np.array([tuple(r) for r in df.select(*z).orderBy(*order).limit(trees * sample).collect()], float)
    rng = np.random.default_rng(seed)
    take = min(sample, len(pool))
    grown = [_tree(pool[rng.choice(len(pool), take, replace=False)], rng, math.ceil(math.log2(max(take, 2)))) for _ in range(trees)]
    norm = max(float(_mean_path(take)), 1e-9)

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float) for c in cols])
        total, row = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, right, path in grown:
            at = np.zeros(len(x), int)
            while (inner := feature[at] >= 0).any():
                go = x[row, np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += path[at]
        return pd.Series(2.0 ** (-total / len(grown) / norm))

    return score(*z)


def noise(points: DataFrame, x: str, y: str, eps: float, least: int) -> DataFrame:
    """The places (x, y) that density clustering leaves over: fewer than ``least`` points within ``eps``, and none of those that have as many.

    Points of one place are counted first.  In cells whose diagonal is ``eps``
    a cell of ``least`` points needs no comparison, all of them are core; only
    places of sparser cells look around, so each place meets at most
    ``24 * least`` others, however crowded a cell is.
    """
    side = eps / math.sqrt(2) * (1 - 1e-9)
    place = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("w"))
    place = place.withColumn("cx", F.floor(F.col("x") / side)).withColumn("cy", F.floor(F.col("y") / side))
    full = place.groupBy("cx", "cy").agg((F.sum("w") >= least).alias("dense"))
    place = shared.stored(place.join(full, ["cx", "cy"]), "places")
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)])
    look = place.where("not dense").select("x", "y", (F.col("cx")).alias("ox"), F.col("cy").alias("oy"), F.explode(steps).alias("s"))
    look = look.select("x", "y", (F.col("ox") + F.col("s.i")).alias("cx"), (F.col("oy") + F.col("s.j")).alias("cy"))
    other = place.select("cx", "cy", F.col("x").alias("qx"), F.col("y").alias("qy"), "w", "dense")
    met = look.join(other, ["cx", "cy"]).where((F.col("x") - F.col("qx")) ** 2 + (F.col("y") - F.col("qy")) ** 2 <= eps * eps)
    met = shared.stored(met.select("x", "y", "qx", "qy", "w", "dense"), "met")
    known = met.groupBy("x", "y").agg((F.sum("w") >= least).alias("core"), F.max("dense").alias("beside"))
    core = known.where("core").select(F.col("x").alias("qx"), F.col("y").alias("qy"))
    edge = met.where("not dense").join(core, ["qx", "qy"], "left_semi").select("x", "y").distinct()
    left = known.where("not core and not beside").select("x", "y").join(edge, ["x", "y"], "left_anti")
    return left.select(F.col("x").alias(x), F.col("y").alias(y))


def five_votes(df: DataFrame, columns: list[str], k: float = 1.5, limit: float = 3.0, contamination: float = 0.05, eps: float = 0.3, least: int = 5, confidence: float = 0.975, trees: int = 100, seed: int = 42) -> DataFrame:
    """Adds a nullable vote of each method, votes, available and is_outlier (a strict majority of at least two votes).

    Fences and z-scores vote for a row if any column does; the others see the
    standardised columns.  A row without any finite value has no vote; nor has
    a method that lacks rows (three; five for density) or columns (two for the
    distance).
    """
    z = standardised(df, columns)
    names, zs = list(z), [f"_z{i}" for i in range(len(z))]
    d = shared.stored(df.withColumn("_row", F.monotonically_increasing_id()).withColumns(dict(zip(zs, z.values()))), "votes")
    n = d.count()
    got: dict[str, Column] = {}
    if names and n >= 3:
        v = {c: finite(F.col(c).cast("double")) for c in names}
        q = d.agg(*[F.percentile(v[c], F.array(F.lit(0.25), F.lit(0.75))).alias(f"q_{c}") for c in names], *[F.avg(v[c]).alias(f"m_{c}") for c in names], *[F.stddev_samp(v[c]).alias(f"s_{c}") for c in names]).first()
        fence, far = F.lit(False), F.lit(False)
        for c in names:
            (a, b), m, s = q[f"q_{c}"], q[f"m_{c}"], q[f"s_{c}"]
            fence = fence | F.coalesce((v[c] < a - k * (b - a)) | (v[c] > b + k * (b - a)), F.lit(False))
            far = far | F.coalesce(F.abs(v[c] - m) / s > limit, F.lit(False)) if s else far
        got |= {"iqr": fence, "zscore": far}
        d = shared.stored(d.withColumn("_score", isolation_scores(d, zs, names, trees, seed=seed)), "scored")
        top = bracketed_quantiles(d.select(F.lit(0).alias("_g"), "_score"), ["_g"], "_score", {"t": 1 - contamination}).first()["t"]
        got["iforest"] = F.col("_score") > top
        if n >= 5:
            vectors = np.linalg.eigh(stats.covariance(d, zs, 0)[1])[1][:, ::-1][:, :2] if len(zs) > 1 else np.ones((1, 1))
            axis = lambda i: sum((F.col(c) * float(vectors[j, i]) for j, c in enumerate(zs)), F.lit(0.0)) if i < vectors.shape[1] else F.lit(0.0)
            d = shared.stored(d.withColumn("_x", axis(0)).withColumn("_y", axis(1)), "components")
            lone = noise(d, "_x", "_y", eps, least).withColumn("_lone", F.lit(True))
            d = d.join(lone, ["_x", "_y"], "left")
            got["pca_dbscan"] = F.coalesce("_lone", F.lit(False))
    if len(zs) >= 2 and n >= len(zs) + 2:
        d = stats.mahalanobis(d.drop("d2", "is_outlier"), zs, confidence).withColumnRenamed("is_outlier", "_far")
        got["mahalanobis"] = F.col("_far")
    seen = F.lit(False)
    for c in names:
        seen = seen | finite(F.col(c).cast("double")).isNotNull()
    d = d.withColumns({f"vote_{m}": F.when(seen, got.get(m, F.lit(None).cast("boolean"))) for m in VOTES})
    out = stats.outlier_vote(d, [f"vote_{m}" for m in VOTES])
    return out.select(*df.columns, *[f"vote_{m}" for m in VOTES], "votes", "available", "is_outlier")
