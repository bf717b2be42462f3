"""Association and multivariate statistics.  Sums are distributed; only matrices of a few columns reach the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import special
from .order import mean_ranks


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """r of each pair over the rows where both are present: one aggregate for all pairs."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    row = df.agg(*[F.corr(F.when(both(a, b), F.col(a)), F.when(both(a, b), F.col(b))).alias(f"r{i}") for i, (a, b) in enumerate(pairs)], *[F.count_if(both(a, b)).alias(f"n{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])).alias("e")).select("e.*")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation over the rows where both are present."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    ra, rb = mean_ranks(d, a).select(a, F.col("_rank").alias("_a")), mean_ranks(d, b).select(b, F.col("_rank").alias("_b"))
    return d.join(ra, a).join(rb, b).agg(F.lit(a).alias("x"), F.lit(b).alias("y"), F.corr("_a", "_b").alias("rho"), F.count("*").alias("n"))


def chi2(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: chi-square (Yates for 2 x 2), df, n, Cramer's V plain and corrected; no V where a side has one category."""
    o = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("o"))
    ra, cb = o.groupBy(a).agg(F.sum("o").alias("ra")), o.groupBy(b).agg(F.sum("o").alias("cb"))
    size = ra.agg(F.sum("ra").alias("n"), F.count("*").alias("r")).crossJoin(cb.agg(F.count("*").alias("c")))  # one row each
    grid = ra.crossJoin(F.broadcast(cb)).join(o, [a, b], "left").na.fill(0, ["o"]).crossJoin(F.broadcast(size))  # categories, not rows
    e = F.col("ra") * F.col("cb") / F.col("n")
    off = F.abs(F.col("o") - e)
    off = F.when((F.col("r") == 2) & (F.col("c") == 2), off - F.least(F.lit(0.5), off)).otherwise(off)
    g = grid.agg(F.sum(off * off / e).alias("chi2"), F.first("n").alias("n"), F.first("r").alias("r"), F.first("c").alias("c"))
    k = F.least(F.col("r") - 1, F.col("c") - 1)
    phi = F.greatest(F.col("chi2") / F.col("n") - F.try_divide((F.col("r") - 1) * (F.col("c") - 1), F.col("n") - 1), F.lit(0.0))
    rc, cc = F.col("r") - F.try_divide((F.col("r") - 1) ** 2, F.col("n") - 1), F.col("c") - F.try_divide((F.col("c") - 1) ** 2, F.col("n") - 1)
    return g.select(F.lit(a).alias("x"), F.lit(b).alias("y"), "chi2", ((F.col("r") - 1) * (F.col("c") - 1)).cast("long").alias("df"), "n", F.sqrt(F.try_divide(F.col("chi2") / F.col("n"), k)).alias("cramers_v"), F.sqrt(F.try_divide(phi, F.least(rc - 1, cc - 1))).alias("cramers_v_corrected"))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: F, eta squared, degrees of freedom."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    g = d.groupBy(group).agg(F.count("*").alias("_n"), F.avg(value).alias("_m"), F.var_pop(value).alias("_v"))
    total = g.agg(F.sum("_n").alias("n"), (F.sum(F.col("_n") * F.col("_m")) / F.sum("_n")).alias("_all"), F.count("*").alias("k"))
    s = g.crossJoin(F.broadcast(total)).agg(F.sum(F.col("_n") * (F.col("_m") - F.col("_all")) ** 2).alias("between"), F.sum(F.col("_n") * F.col("_v")).alias("within"), F.first("k").alias("k"), F.first("n").alias("n"))  # one row
    return s.select((F.col("between") / (F.col("k") - 1) / (F.col("within") / (F.col("n") - F.col("k")))).alias("f"), (F.col("between") / (F.col("between") + F.col("within"))).alias("eta_squared"), (F.col("k") - 1).alias("df1"), (F.col("n") - F.col("k")).alias("df2"))


def kruskal(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: H with tie correction, epsilon squared; null where all values are equal or rows are too few."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, value)
    ranks = mean_ranks(d, value)
    ties = ranks.agg(F.sum(F.col("_c").cast("double") ** 3 - F.col("_c")).alias("t"), F.sum("_c").alias("n"), F.count("*").alias("_k"))
    g = d.join(ranks.select(value, "_rank"), value).groupBy(group).agg(F.count("*").alias("m"), F.sum("_rank").alias("s"))
    h = g.agg(F.sum(F.col("s") ** 2 / F.col("m")).alias("q"), F.count("*").alias("k")).crossJoin(ties)  # one row each
    n = F.col("n")
    raw = F.try_divide(12 * F.col("q"), n * (n + 1)) - 3 * (n + 1)
    return h.withColumn("h", F.try_divide(raw, 1 - F.try_divide(F.col("t"), n.cast("double") ** 3 - n))).select("h", F.try_divide(F.col("h") - F.col("k") + 1, n - F.col("k")).alias("epsilon_squared"), "k", "n")


def jarque_bera(df: DataFrame, columns: list[str]) -> DataFrame:
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e")).select("e.*")
    return long.groupBy("column_name").agg(F.count("v").alias("n"), (F.count("v") / 6 * (F.skewness("v") ** 2 + F.kurtosis("v") ** 2 / 4)).alias("jb"))


def kendall_tables(df: DataFrame, a: str, b: str) -> DataFrame:
    """Tau-b of two columns of few distinct values, from their contingency table: concordant and discordant pairs of cells, not of rows."""
    o = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count("*").alias("c"))
    p, q = o, o.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("c").alias("c2"))
    pairs = p.join(q, F.col("x") < F.col("x2"))  # cells of the table
    s = pairs.agg(F.sum(F.col("c") * F.col("c2") * F.signum(F.col("y2") - F.col("y"))).alias("s"))
    ties = lambda k: o.groupBy(k).agg(F.sum("c").alias("t")).agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias(f"t{k}"))
    n = o.agg(F.sum("c").alias("n"))
    one = s.crossJoin(ties("x")).crossJoin(ties("y")).crossJoin(n)  # one row each
    total = F.col("n") * (F.col("n") - 1) / 2
    return one.select((F.col("s") / F.sqrt((total - F.col("tx")) * (total - F.col("ty")))).alias("tau_b"), "n")


def covariance(df: DataFrame, columns: list[str], ddof: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean vector, covariance matrix and number of complete rows: one aggregate, a few numbers for the driver."""
    full = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]).na.drop()
    n = len(columns)
    cov = F.covar_samp if ddof else F.covar_pop
    r = full.agg(F.count("*").alias("n"), *[F.avg(f"v{i}").alias(f"m{i}") for i in range(n)], *[cov(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i in range(n) for j in range(i, n)]).first()
    c = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)])
    return np.array([r[f"m{i}"] for i in range(n)]), c, r["n"]


def mahalanobis(df: DataFrame, columns: list[str], confidence: float = 0.975) -> DataFrame:
    """Adds d2 by the pseudo-inverse covariance, and is_outlier beyond the chi-square quantile for its rank; incomplete rows get null."""
    if len(columns) < 2:
        raise ValueError("two columns at least are asked for")
    mean, cov, n = covariance(df, columns)
    if n < len(columns) + 2:
        raise ValueError(f"{len(columns) + 2} complete rows at least are asked for, not {n}")
    inv, rank = np.linalg.pinv(cov), int(np.linalg.matrix_rank(cov))
    dev = [F.col(c).cast("double") - float(m) for c, m in zip(columns, mean)]
    d2: Column = F.lit(0.0)
    for i in range(len(columns)):
        for j in range(len(columns)):
            d2 = d2 + dev[i] * dev[j] * float(inv[i, j])
    return df.withColumn("d2", d2).withColumn("is_outlier", F.col("d2") > special.chi2_quantile(confidence, rank))


def pca(df: DataFrame, columns: list[str]) -> list[tuple[int, float, float]]:
    """(component, share of variance, running share) of the standardised columns."""
    _, cov, _ = covariance(df, columns, 0)
    sd = np.sqrt(np.diag(cov))
    values = np.sort(np.linalg.eigvalsh(cov / np.outer(sd, sd)))[::-1]
    share = values / values.sum()
    return [(i + 1, float(s), float(c)) for i, (s, c) in enumerate(zip(share, np.cumsum(share)))]


def vif(df: DataFrame, columns: list[str]) -> list[tuple[str, float]]:
    """Variance inflation of each column: the diagonal of the inverse correlation matrix."""
    _, cov, _ = covariance(df, columns)
    sd = np.sqrt(np.diag(cov))
    return [(c, float(v)) for c, v in zip(columns, np.diag(np.linalg.inv(cov / np.outer(sd, sd))))]


def outlier_vote(df: DataFrame, votes: list[str]) -> DataFrame:
    """Adds votes, available and is_outlier: a strict majority of at least two votes that aren't null."""
    cast = sum((F.coalesce(F.col(v).cast("int"), F.lit(0)) for v in votes), F.lit(0))
    have = sum((F.col(v).isNotNull().cast("int") for v in votes), F.lit(0))
    return df.withColumn("votes", cast).withColumn("available", have).withColumn("is_outlier", (F.col("available") >= 2) & (F.col("votes") > F.col("available") / 2))
