"""Tails and quantiles of the normal, t, chi-square and F distributions, by series and continued fractions (numpy only)."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma."""
    if x <= 0:
        return 0.0
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return total * math.exp(-x + a * math.log(x) - math.lgamma(a))
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return 1 - h * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_i(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or 1e-300)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or 1e-300)
            c = 1 + num / c or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def normal_sf(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def chi2_sf(x: float, df: float) -> float:
    return 1 - _gamma_p(df / 2, x / 2)


def t_sf2(t: float, df: float) -> float:
    """Two-sided tail."""
    return _beta_i(df / 2, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    return _beta_i(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def _solve(f, lo: float, hi: float) -> float:
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) > 0 else (lo, mid)
    return (lo + hi) / 2


def chi2_quantile(p: float, df: float) -> float:
    return _solve(lambda x: p - (1 - chi2_sf(x, df)), 0.0, 1000.0 + 10 * df)


def t_quantile(p: float, df: float) -> float:
    if p < 0.5:
        return -t_quantile(1 - p, df)
    return _solve(lambda t: t_sf2(t, df) / 2 - (1 - p), 0.0, 1e4)


def t_quantile_column(p: float, df: Column) -> Column:
    """t quantile as a column: exact for up to 30 degrees of freedom, beyond by the Cornish-Fisher series (error below 1e-6)."""
    z = _solve(lambda x: normal_sf(x) - (1 - p), -40.0, 40.0)
    n = df.cast("double")
    g = [(z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384, (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
    series = F.lit(z) + F.lit(g[0]) / n + F.lit(g[1]) / n**2 + F.lit(g[2]) / n**3 + F.lit(g[3]) / n**4
    table = F.array(*[F.lit(t_quantile(p, k)) for k in range(1, 31)])
    return F.when(df < 1, F.lit(None).cast("double")).when(df <= 30, F.element_at(table, df.cast("int"))).otherwise(series)


#: Wichura's rational approximations of the normal quantile (numerator, denominator), near the middle, further out and in the tails.
_QUANTILE = (
    ((3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125, 45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
     (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610)),
    ((1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504, 1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640),
     (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9)),
    ((6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230, 0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
     (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 0.000786869131145613259100, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)),
)


def _ratio(part: int, r):
    top, low = (sum((c * r**k for k, c in enumerate(cs[1:], 1)), r * 0 + cs[0]) for cs in _QUANTILE[part])
    return top / low


def normal_quantile_column(p: Column) -> Column:
    """Normal quantile as a column, to about sixteen digits; null outside (0, 1)."""
    q = p - 0.5
    r = F.sqrt(-F.log(F.when(q < 0, p).otherwise(1 - p)))
    tail = F.when(r <= 5, _ratio(1, r - 1.6)).otherwise(_ratio(2, r - 5.0))
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, q * _ratio(0, F.lit(0.180625) - q * q)).otherwise(F.signum(q) * tail))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)
