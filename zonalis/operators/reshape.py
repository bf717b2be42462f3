"""Long and wide forms, calendars, set operations, grain checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def widen(df: DataFrame, keys: list[str], label: str, values: list[str], labels: list[str]) -> DataFrame:
    """``value__label`` columns; the labels are given, so no job looks for them, and a missing period is a null column."""
    aggs = [F.first(v, True).alias(v) for v in values]
    out = df.groupBy(*keys).pivot(label, labels).agg(*aggs)
    return out.select(*keys, *[F.col(f"`{l}`" if len(values) == 1 else f"`{l}_{v}`").alias(f"{v}__{l}") for v in values for l in labels])


def melt(df: DataFrame, keys: list[str], columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def annual(df: DataFrame, keys: list[str], columns: list[str], prefix: str) -> DataFrame:
    """Row-wise mean, min, max and population deviation over the columns, nulls skipped."""
    a = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())
    d = df.select(*keys, a.alias("_a")).withColumn("_n", F.size("_a"))
    mean = F.aggregate("_a", F.lit(0.0), lambda s, x: s + x) / F.col("_n")
    d = d.withColumn("_m", F.when(F.col("_n") > 0, mean))
    var = F.aggregate("_a", F.struct(F.lit(0.0).alias("s"), F.col("_m").alias("m")), lambda s, x: F.struct((s["s"] + (x - s["m"]) * (x - s["m"])).alias("s"), s["m"].alias("m")))["s"] / F.col("_n")
    return d.select(*keys, F.col("_m").alias(f"{prefix}_mean"), F.array_min("_a").alias(f"{prefix}_min"), F.array_max("_a").alias(f"{prefix}_max"), F.when(F.col("_n") > 0, F.sqrt(var)).alias(f"{prefix}_std"))


def check_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that stand in more than one row; empty when the grain holds."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def varying(df: DataFrame, keys: list[str], columns: Iterable[str]) -> DataFrame:
    """Columns that aren't constant within a key, null counting as a value."""
    cols = list(columns)
    g = df.groupBy(*keys).agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in cols])
    return g.agg(*[F.count_if(F.col(c) > 1).alias(c) for c in cols]).unpivot([], cols, "column_name", "keys_varying")


def align(parts: list[DataFrame]) -> DataFrame:
    """Union by name; columns that a part lacks are null in its rows."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def cover_errors(parts: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """Why parts aren't an exact cover of the whole: keys missing, unknown or doubled; empty when they are."""
    n = parts.groupBy(key).agg(F.count("*").alias("_n"))
    both = n.join(whole.select(key).distinct().withColumn("_w", F.lit(True)), key, "full_outer")
    kind = F.when(F.col("_n").isNull(), "missing").when(F.col("_w").isNull(), "unknown").when(F.col("_n") > 1, "doubled")
    return both.select(key, kind.alias("error")).where("error is not null")


def first_of(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key: the first in a total order, by partial aggregation rather than a sort of each group."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def periods(start: str, end: str, step: str) -> list[tuple[str, str]]:
    """Half-open bins [start, next) of ``nD``, ``nM`` or ``nY`` from start through end's day; the last is cut there.  Months add to the bin before."""
    import calendar
    import datetime as dt

    n, unit = int(step[:-1]), step[-1].upper()
    if n <= 0 or unit not in "DMY":
        raise ValueError(f"a step like 15D, 1M or 1Y is asked for, not {step!r}")
    at, stop, out = dt.date.fromisoformat(start), dt.date.fromisoformat(end) + dt.timedelta(days=1), []
    while at < stop:
        if unit == "D":
            nxt = at + dt.timedelta(days=n)
        else:
            m = at.month - 1 + n * (12 if unit == "Y" else 1)
            y, m = at.year + m // 12, m % 12 + 1
            nxt = dt.date(y, m, min(at.day, calendar.monthrange(y, m)[1]))
        out.append((at.isoformat(), min(nxt, stop).isoformat()))
        at = nxt
    return out


def month_gaps(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Keys with months missing between their first and last, or doubled."""
    m = df.select(*keys, F.trunc(F.col(day).cast("date"), "month").alias("_m"))
    g = m.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("_m").alias("months"), (F.months_between(F.max("_m"), F.min("_m")) + 1).cast("long").alias("expected"))
    return g.where("n <> months or months <> expected")


def dedup_flags(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds is_duplicate: the key stands in another row too."""
    return df.withColumn("is_duplicate", F.count("*").over(Window.partitionBy(*keys)) > 1)
