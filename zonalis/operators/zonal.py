"""Zonal statistics: pooled reducers over samples, derived statistics, provenance ratios."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Named reducers of one sample column, nulls skipped; quantiles interpolate linearly between ranks.
REDUCERS = {
    "mean": F.avg,
    "median": lambda v: F.percentile(v, F.lit(0.5)),
    "sd": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
    "range": lambda v: F.max(v) - F.min(v),
    "p10": lambda v: F.percentile(v, F.lit(0.10)),
    "p25": lambda v: F.percentile(v, F.lit(0.25)),
    "p75": lambda v: F.percentile(v, F.lit(0.75)),
    "p90": lambda v: F.percentile(v, F.lit(0.90)),
}
#: The reducers that are quantiles.
QUANTILES = {"median": 0.5, "p10": 0.10, "p25": 0.25, "p75": 0.75, "p90": 0.90}
ALIASES = {"average": "mean", "avg": "mean", "std": "sd", "stdev": "sd", "stddev": "sd", "minimum": "min", "maximum": "max", "n": "count"}


def finite(v: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def reducers(names: list[str]) -> list[str]:
    """Canonical names, aliases resolved, repeats dropped; an unknown name is an error."""
    out = []
    for n in names:
        k = ALIASES.get(n.lower(), n.lower())
        if k not in REDUCERS:
            raise ValueError(f"unknown statistic {n!r}; known: {sorted(REDUCERS)}")
        if k not in out:
            out.append(k)
    return out


def pooled(df: DataFrame, keys: list[str], value: str, stats: list[str]) -> DataFrame:
    """One row per key: the statistics of all its samples pooled (never an average of averages)."""
    v = finite(F.col(value).cast("double"))
    names = reducers(stats)
    at = {n: QUANTILES[n] for n in names if n in QUANTILES}
    quantiles = [F.percentile(v, F.array(*map(F.lit, at.values()))).alias("_q")] if at else []  # one buffer of values for all of them
    out = df.groupBy(*keys).agg(*[REDUCERS[s](v).alias(s) for s in names if s not in at], *quantiles)
    return out.select(*keys, *[F.col("_q")[list(at).index(s)].alias(s) if s in at else F.col(s) for s in names])


def at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, tuple[float, Callable[[Column], Column]]], accuracy: int = 5000) -> DataFrame:
    """keys, n (values that aren't null), and a column for each of ``ranks``: the value at that place, from 0, in the order of a group's values; NaN comes last.

    A rank is given as about which share of the values lies below it, and as a
    function of n.  A sketch brackets each; values outside the brackets are
    only counted, with the least and the greatest between two edges, so what
    is ranked is a few thousandths of a group's distinct values, and no task
    holds a group.  Groups are few: their edges are broadcast.  A rank that its
    bracket missed is an error when the plan runs.
    """
    slack = 4.0 / accuracy
    edges = [e for p, _ in ranks.values() for e in (max(0.0, p - slack), min(1.0, p + slack))]
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    sketch = rows.groupBy(*keys).agg(F.percentile_approx(F.when(F.isnan("_v"), float("inf")).otherwise(F.col("_v")), edges, accuracy).alias("_e"))  # a sketch has no place for NaN
    sketch = sketch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.transform("_e", lambda e, i: F.when((e == float("inf")) & (i % 2 == 1), float("nan")).otherwise(e)).alias("_e"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    met = rows.join(F.broadcast(sketch), reduce(Column.__and__, on)) if keys else rows.crossJoin(F.broadcast(sketch))  # a row for each group
    edge = [F.col("_e")[i] for i in range(len(edges))]
    inside = reduce(Column.__or__, [F.col("_v").between(lo, hi) for lo, hi in zip(edge[::2], edge[1::2])])
    above = reduce(Column.__add__, [(F.col("_v") > e).cast("int") for e in edge])
    parts = met.groupBy(*keys, above.alias("_s"), F.when(inside, F.col("_v")).alias("_i")).agg(F.count("_v").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    by = Window.partitionBy(*keys)
    parts = parts.withColumn("_n", F.sum("_c").over(by)).withColumn("_b", F.sum("_c").over(by.orderBy(F.col("_lo").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c"))

    def value_at(rank: Column) -> Column:
        got = F.when((F.col("_lo") == F.col("_hi")) | (rank == F.col("_b")), F.col("_lo")).when(rank == F.col("_b") + F.col("_c") - 1, F.col("_hi"))
        return F.max(F.when((rank >= F.col("_b")) & (rank < F.col("_b") + F.col("_c")), got.otherwise(F.raise_error(F.lit("a rank lies outside its bracket")).cast("double"))))

    return parts.groupBy(*keys).agg(F.coalesce(F.max("_n"), F.lit(0)).cast("long").alias("n"), *[value_at(f(F.col("_n")).cast("long")).alias(k) for k, (_, f) in ranks.items()])


def quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], accuracy: int = 5000, more: dict | None = None) -> DataFrame:
    """keys, n, q: the values of ``percentile`` for ``probs``, to the bit, as an array (of nulls without values), by ``at_ranks``, and ``more`` of its ranks."""
    place = lambda p, n: F.lit(float(p)) * (n - 1)
    ranks = {f"_{s}{i}": (p, lambda n, p=p, f=f: f(place(p, n))) for i, p in enumerate(probs) for s, f in (("a", F.floor), ("b", F.ceil))}
    got = at_ranks(df, keys, value, ranks | (more or {}), accuracy)

    def between(i: int, p: float) -> Column:
        a, b, at = F.col(f"_a{i}"), F.col(f"_b{i}"), place(p, F.col("n"))
        return F.when(a == b, a).otherwise((F.ceil(at) - at) * a + (at - F.floor(at)) * b)

    return got.select(*keys, "n", F.array(*[between(i, p) for i, p in enumerate(probs)]).alias("q"), *(more or {}))


def bracketed_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int = 1000) -> DataFrame:
    """The exact interpolated quantiles of ``pooled`` by name, without any group's values in one buffer; groups without values are left out."""
    v = finite(F.col(value).cast("double"))
    q = quantiles(df.select(*keys, v.alias("_v")).where("_v is not null"), keys, "_v", list(probs.values()), accuracy * 4).where("n > 0")
    return q.select(*keys, *[F.col("q")[i].alias(k) for i, k in enumerate(probs)])


def derived(prefix: str = "") -> dict[str, Column]:
    """Derived statistics from pooled ones; a denominator near nought gives null."""
    c = lambda n: F.col(prefix + n)
    iqr = c("p75") - c("p25")
    return {
        "range": c("max") - c("min"),
        "variance": c("sd") * c("sd"),
        "cv": F.when(F.abs(c("mean")) > 1e-12, c("sd") / c("mean")),
        "iqr": iqr,
        "bowley_skew": F.when(F.abs(iqr) > 1e-12, (c("p75") + c("p25") - 2 * c("median")) / iqr),
        "p90_p10": c("p90") - c("p10"),
    }


def with_derived(df: DataFrame, prefix: str = "") -> DataFrame:
    """Adds the derived statistics that ``df`` doesn't have."""
    return df.withColumns({prefix + k: v for k, v in derived(prefix).items() if prefix + k not in df.columns})


def provenance(df: DataFrame, keys: list[str], observed: str, temporal: str, final: str, expected: str | None = None) -> DataFrame:
    """Shares of expected samples that were observed, filled over time, filled over space, or are still missing."""
    have, filled = F.col(final).isNotNull(), F.col(temporal) & ~F.col(observed)
    out = df.groupBy(*keys).agg(
        (F.max(expected) if expected else F.count("*")).alias("expected"),
        F.count_if(F.col(observed)).alias("observed"),
        F.count_if(filled & have).alias("temporal"),
        F.count_if(have & ~F.col(observed) & ~filled).alias("spatial"),
    )
    share = {f"{k}_ratio": F.when(F.col("expected") > 0, F.col(k) / F.col("expected")) for k in ("observed", "temporal", "spatial")}
    return out.withColumns(share)
