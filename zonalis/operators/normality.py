"""Normality tests: Shapiro-Wilk, D'Agostino-Pearson, Jarque-Bera and Anderson-Darling.

Ranks are global (``order.numbered``), so no task sorts a column; only sums and
the two smallest and largest values reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import special
from . import order
from .zonal import finite

#: Critical values of A2 (1 + 0.75 / n + 2.25 / n^2) for an unknown mean and variance, and their levels in per cent.
ANDERSON = ((0.561, 15.0), (0.631, 10.0), (0.752, 5.0), (0.873, 2.5), (1.035, 1.0))
#: Royston's polynomials in 1 / sqrt(n) for the two outer weights.
OUTER = ((0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056), (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633))
_POLY = lambda c, x: sum(a * x**k for k, a in enumerate(c))


def skew_z(g1: float, n: int) -> float:
    """D'Agostino's normal score of a sample's skewness."""
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2 * (b2 - 1)) - 1
    return math.asinh(y / math.sqrt(2 / (w2 - 1))) / math.sqrt(0.5 * math.log(w2))


def kurtosis_z(b2: float, n: int) -> float:
    """Anscombe and Glynn's normal score of a sample's kurtosis (3 for a normal one)."""
    x = (b2 - 3 * (n - 1) / (n + 1)) / math.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5)))
    s = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / s * (2 / s + math.sqrt(1 + 4 / s**2))
    d = 1 + x * math.sqrt(2 / (a - 4))
    if not d:
        return math.nan
    return (1 - 2 / (9 * a) - math.copysign(((1 - 2 / a) / abs(d)) ** (1 / 3), d)) / math.sqrt(2 / (9 * a))


def shapiro_p(w: float, n: int) -> float:
    """Royston's tail of W."""
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return 1.0
    if n <= 11:
        g = 0.459 * n - 2.273
        if math.log(1 - w) >= g:
            return 0.0
        y, mu, sigma = -math.log(g - math.log(1 - w)), _POLY((0.5440, -0.39978, 0.025054, -0.0006714), n), math.exp(_POLY((1.3822, -0.77857, 0.062767, -0.0020322), n))
    else:
        x = math.log(n)
        y, mu, sigma = math.log(1 - w), _POLY((-1.5861, -0.31082, -0.083751, 0.0038915), x), math.exp(_POLY((-0.4803, -0.082676, 0.0030302), x))
    return special.normal_sf((y - mu) / sigma)


def anderson_p(a2: float, n: int) -> float:
    """Interpolated between the tabled levels; 0.15 and 0.01 are its ends."""
    x = a2 * (1 + 0.75 / n + 2.25 / n**2)
    if x <= ANDERSON[0][0]:
        return 0.15
    for (a, p), (b, q) in zip(ANDERSON, ANDERSON[1:]):
        if x <= b:
            return (p + (q - p) * (x - a) / (b - a)) / 100
    return 0.01


@F.pandas_udf(DoubleType())
def _log_normal(z):
    """Logarithm of the normal distribution function."""
    import pandas as pd

    return pd.Series([math.log(max(math.erfc(-x / math.sqrt(2)) / 2, 5e-324)) for x in z])


def _weight(i: Column, n: int) -> Column:
    """Blom's expected normal order statistic."""
    return special.normal_quantile_column((i - 0.375) / (n + 0.25))


def tests(df: DataFrame, column: str, key: str | None = None, sample: int | None = 5000) -> dict:
    """One column's statistics and p-values.

    Beyond ``sample`` rows, those of least hash of ``key`` are taken (None:
    all rows).  W is given for three rows or more, the others for eight; a
    constant column has none.
    """
    rows = df.select(*([key] if key else []), finite(F.col(column).cast("double")).alias("v")).where("v is not null")
    if sample is not None:
        rows = order.hash_sample(rows, key or "v", sample)
    v = F.col("v")
    n, mean, low, high = rows.agg(F.count("v"), F.avg("v"), F.min("v"), F.max("v")).first()
    names = [f"{t}_{x}" for t in ("shapiro", "dagostino", "jarque_bera", "anderson") for x in ("statistic", "pvalue")]
    out = {"column": column, "sample_size": n} | dict.fromkeys(names) | {"normality_hint": "insufficient_data"}
    if n < 3 or low == high:
        return out
    m2, m3, m4 = rows.agg(*[F.avg((v - mean) ** k) for k in (2, 3, 4)]).first()
    ranked = order.numbered(rows.select("v"), ["v"], "i")
    sd, m = math.sqrt(m2 * n / (n - 1)), _weight(F.col("i"), n)
    z = (v - mean) / sd
    logs = F.avg((2 * F.col("i") - 1) * _log_normal(z) + (2 * (n - F.col("i")) + 1) * _log_normal(-z)) if n >= 8 else F.lit(None)
    at = lambda k: F.max(F.when(F.col("i") == k, v))
    mm, mx, a, b, y, x, ln = ranked.agg(F.sum(m * m), F.sum(m * v), at(1), at(2), at(n - 1), at(n), logs).first()
    # the outer weights have polynomials, the inner ones keep the proportions of the order statistics
    m1, m0 = (-special.normal_quantile((k - 0.375) / (n + 0.25)) for k in (2, 1))
    if n == 3:
        top = math.sqrt(0.5) * (x - a)
    else:
        u = 1 / math.sqrt(n)
        a0, a1 = m0 / math.sqrt(mm) + _POLY(OUTER[0], u), m1 / math.sqrt(mm) + _POLY(OUTER[1], u)
        two = n > 5
        eps = (mm - 2 * m0**2 - two * 2 * m1**2) / (1 - 2 * a0**2 - two * 2 * a1**2)
        inner = mx - m0 * (x - a) - two * m1 * (y - b)
        top = a0 * (x - a) + two * a1 * (y - b) + inner / math.sqrt(eps)
    w = min(top * top / (m2 * n), 1.0)
    out |= {"shapiro_statistic": w, "shapiro_pvalue": shapiro_p(w, n)}
    if n >= 8:
        g1, b2 = m3 / m2**1.5, m4 / m2**2
        k2, jb, a2 = skew_z(g1, n) ** 2 + kurtosis_z(b2, n) ** 2, n / 6 * (g1**2 + (b2 - 3) ** 2 / 4), -n - ln
        out |= {"dagostino_statistic": k2, "dagostino_pvalue": math.exp(-k2 / 2), "jarque_bera_statistic": jb, "jarque_bera_pvalue": math.exp(-jb / 2), "anderson_statistic": a2, "anderson_pvalue": anderson_p(a2, n)}
        out["normality_hint"] = "likely_normal" if min(out["dagostino_pvalue"], out["jarque_bera_pvalue"]) >= 0.05 else "likely_not_normal"
    return out


def table(df: DataFrame, columns: list[str], key: str | None = None, sample: int | None = 5000) -> DataFrame:
    """A row per column."""
    rows = [tests(df, c, key, sample) for c in columns]
    kinds = {"column": "string", "sample_size": "long", "normality_hint": "string"}
    return df.sparkSession.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{k}` {kinds.get(k, 'double')}" for k in rows[0]))
