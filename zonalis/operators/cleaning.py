"""Cleaning: fences, z-score masks, coverage guards, fills over time and space, stage counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins, zonal


def fences(df: DataFrame, keys: list[str], value: str, k: float = 1.5, q: tuple[float, float] = (0.25, 0.75), many: bool = False) -> DataFrame:
    """q1, q3, lower, upper and n of each key; ``many``: groups are many, and each one's values fit into one buffer."""
    if many:
        out = df.groupBy(*keys).agg(F.percentile(F.col(value), F.array(F.lit(q[0]), F.lit(q[1]))).alias("_q"), F.count(value).alias("n"))
    else:
        out = zonal.quantiles(df, keys, value, list(q)).withColumnRenamed("q", "_q")
    out = out.select(*keys, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return out.withColumn("lower", F.col("q1") - k * iqr).withColumn("upper", F.col("q3") + k * iqr)


def fence_clean(df: DataFrame, keys: list[str], value: str, least: int = 20, k: float = 1.5) -> DataFrame:
    """Adds ``cleaned`` (null strictly outside the fences) and ``fence_applied`` (false below ``least`` samples).

    The bounds are one row per key; the adaptive planner broadcasts them while they are small.
    """
    bounds = fences(df, keys, value, k, many=True).select(*keys, "lower", "upper", (F.col("n") >= least).alias("fence_applied"))
    out = df.join(bounds, keys)
    outside = F.col("fence_applied") & ((F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper")))
    return out.withColumn("cleaned", F.when(~outside, F.col(value)))


def zscore(df: DataFrame, keys: list[str], value: str, limit: float = 3.0, few: bool = False) -> DataFrame:
    """Adds z (sample deviation) and is_outlier (strictly beyond ``limit``); ``few``: keys are few, so their bounds are broadcast and no row moves."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    joined = df.join(F.broadcast(stats) if few else stats, keys) if keys else df.crossJoin(F.broadcast(stats))  # one row
    z = F.when(F.col("_s") > 0, (F.col(value) - F.col("_m")) / F.col("_s"))
    return joined.withColumn("z", z).withColumn("is_outlier", F.coalesce(F.abs(F.col("z")) > limit, F.lit(False))).drop("_m", "_s")


def _sides(value: str, by, before: int | None, after: int | None) -> tuple[Column, Column]:
    lo = Window.unboundedPreceding if before is None else -before
    hi = Window.unboundedFollowing if after is None else after
    return F.last(value, True).over(by.rowsBetween(lo, -1)), F.first(value, True).over(by.rowsBetween(1, hi))


def fill_past(df: DataFrame, keys: list[str], order: str, value: str, out: str = "filled") -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(order)
    past, _ = _sides(value, by, None, None)
    return df.withColumn(out, F.coalesce(value, past))


def fill_both(df: DataFrame, keys: list[str], order: str, value: str, out: str = "filled") -> DataFrame:
    """The midpoint of the nearest observations on both sides, else the one there is."""
    by = Window.partitionBy(*keys).orderBy(order)
    past, next_ = _sides(value, by, None, None)
    return df.withColumn(out, F.coalesce(F.col(value), (past + next_) / 2, past, next_))


def fill_bounded(df: DataFrame, keys: list[str], order: str, value: str, windows: tuple[int, ...] = (3, 5), past_only: bool = False, out: str = "filled") -> DataFrame:
    """Nearest *observed* neighbours within half a window; wider windows retry what is missing; fills never feed fills."""
    by = Window.partitionBy(*keys).orderBy(order)
    tries: list[Column] = [F.col(value)]
    for w in windows:
        past, next_ = _sides(value, by, w // 2, w // 2)
        tries += [past] if past_only else [(past + next_) / 2, past, next_]
    return df.withColumn(out, F.coalesce(*tries))


def coverage_guard(df: DataFrame, period: list[str], value: str, least: float = 0.2) -> DataFrame:
    """Adds coverage, fill_allowed (coverage reaches ``least``) and donor (the value where it may be used)."""
    shares = df.groupBy(*period).agg((F.count(value) / F.count("*")).alias("coverage"))
    out = df.join(shares, period).withColumn("fill_allowed", F.col("coverage") >= least)
    return out.withColumn("donor", F.when(F.col("fill_allowed"), F.col(value)))


def spatial_mean(df: DataFrame, keys: list[str], y: str, x: str, value: str, size: int = 3, out: str = "filled") -> DataFrame:
    """Missing cells from the mean of their window's observed cells: sums and counts over x, then over y.

    Frames are ranges of the integer index, so absent cells don't shift neighbours.
    """
    r = size // 2
    over_x = Window.partitionBy(*keys, y).orderBy(x).rangeBetween(-r, r)
    over_y = Window.partitionBy(*keys, x).orderBy(y).rangeBetween(-r, r)
    d = df.withColumn("_s", F.sum(value).over(over_x)).withColumn("_n", F.count(value).over(over_x))
    d = d.withColumn("_s", F.sum("_s").over(over_y)).withColumn("_n", F.sum("_n").over(over_y))
    return d.withColumn(out, F.coalesce(F.col(value), F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")))).drop("_s", "_n")


def nearest_fill(df: DataFrame, keys: list[str], y: str, x: str, value: str, spacing: tuple[float, float] = (1.0, 1.0), most: float | None = None, out: str = "filled") -> DataFrame:
    """Missing cells from the nearest observed cell of their layer (ties: least y, then x), ``spacing`` being the size of a step in y and x."""
    d = df.withColumn("_py", F.col(y) * spacing[0]).withColumn("_px", F.col(x) * spacing[1])
    donors = d.where(F.col(value).isNotNull()).select(*keys, F.col("_py").alias("_qy"), F.col("_px").alias("_qx"), F.col(value).alias("_near"))
    gaps = d.where(F.col(value).isNull()).select(*keys, y, x, "_py", "_px")
    got = joins.nearest_2d(gaps, donors, [*keys, y, x], "_px", "_py", "_qx", "_qy", ["_qy", "_qx"], ["_near"], keys, most)
    return df.join(got.select(*keys, y, x, "_near"), [*keys, y, x], "left").withColumn(out, F.coalesce(value, "_near")).drop("_near")


def dilate(df: DataFrame, keys: list[str], y: str, x: str, flag: str, size: int = 3, out: str = "dilated") -> DataFrame:
    """A flag spread to its square neighbourhood."""
    r = size // 2
    over_x = Window.partitionBy(*keys, y).orderBy(x).rangeBetween(-r, r)
    over_y = Window.partitionBy(*keys, x).orderBy(y).rangeBetween(-r, r)
    return df.withColumn(out, F.max(flag).over(over_x)).withColumn(out, F.max(out).over(over_y))


def stage_report(df: DataFrame, keys: list[str], stages: list[str]) -> DataFrame:
    """Nulls left after each stage, and filled by it."""
    out = df.groupBy(*keys).agg(F.count("*").alias("cells"), *[F.count_if(F.col(s).isNull()).alias(f"null_{s}") for s in stages])
    return out.withColumns({f"by_{b}": F.col(f"null_{a}") - F.col(f"null_{b}") for a, b in zip(stages, stages[1:])})
