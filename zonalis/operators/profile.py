"""Profiling: column, numeric, robust, categorical and datetime summaries, missingness, quality flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import special
from ..sources import shared
from . import zonal


def kinds(df: DataFrame) -> dict[str, list[str]]:
    """Columns by kind: numeric (booleans too), datetime, categorical."""
    out: dict[str, list[str]] = {"numeric": [], "datetime": [], "categorical": []}
    for f in df.schema:
        k = "numeric" if isinstance(f.dataType, (T.NumericType, T.BooleanType)) else "datetime" if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "categorical"
        out[k].append(f.name)
    return out


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One pass over the table: rows, non_null, missing_pct, n_distinct, unique_pct, is_constant of each column.

    Distinct counts of several columns in one aggregate expand each row once a column; nothing is sorted.
    """
    columns = columns or df.columns
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("e")).select("e.*")
    counts = long.groupBy("column_name", "v").agg(F.count("*").alias("c"))
    out = counts.groupBy("column_name").agg(F.sum("c").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("c"))), F.lit(0)).alias("non_null"), F.count("v").alias("n_distinct"))
    return out.select("*", ((1 - F.col("non_null") / F.col("n_rows")) * 100).alias("missing_pct"), F.when(F.col("non_null") > 0, F.col("n_distinct") / F.col("non_null") * 100).otherwise(0.0).alias("unique_pct"), (F.col("n_distinct") <= 1).alias("is_constant"))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e")).select("e.*").where("v is not null and not isnan(v)")


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Moments and quartiles; skewness and kurtosis corrected for bias."""
    long = _long(df, columns)
    q = zonal.quantiles(long, ["column_name"], "v", [0.25, 0.5, 0.75]).select("column_name", F.col("q").alias("_q"))
    out = long.groupBy("column_name").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), F.skewness("v").alias("_g1"), F.kurtosis("v").alias("_g2"), F.count_if(F.col("v") == 0).alias("zeros"), F.count_if(F.col("v") < 0).alias("negatives")).join(q, "column_name")
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6))
    out = out.select("*", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"), skew.alias("skewness"), kurt.alias("kurtosis"))
    return out.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn("cv", F.when(F.abs("mean") > 1e-12, F.col("std") / F.col("mean"))).drop("_q", "_g1", "_g2")


def robust_summary(df: DataFrame, columns: list[str], trim: float = 0.1) -> DataFrame:
    """Trimmed mean (10 values at least), normalised MAD, tail percentiles, t-based 95 % interval of the mean."""
    v, k = _long(df, columns), ["column_name"]
    # the values at both cuts; what lies between is summed, and of the cuts' own rows those that are left
    cut = lambda n: F.floor(n * trim)
    places = shared.stored(zonal.quantiles(v, k, "v", [0.01, 0.05, 0.5, 0.95, 0.99], more={"lo": (trim, cut), "hi": (1 - trim, lambda n: n - cut(n) - 1)}).withColumnRenamed("q", "_p"), "places")
    base = v.groupBy(*k).agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd")).join(places, "column_name")
    x, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    sums = v.join(F.broadcast(places), "column_name").groupBy(*k, "n", "lo", "hi").agg(F.count_if(x <= lo).alias("_l"), F.count_if(x < hi).alias("_h"), F.coalesce(F.sum(F.when((x > lo) & (x < hi), x)), F.lit(0.0)).alias("_s"))  # a row for each column
    kept = F.col("_s") + lo * (F.col("_l") - cut(F.col("n"))) + hi * (F.col("n") - cut(F.col("n")) - F.col("_h"))
    trimmed = sums.select("column_name", F.when(lo < hi, kept / (F.col("n") - 2 * cut(F.col("n")))).when(lo == hi, lo).alias("trimmed_mean"))
    dev = v.join(F.broadcast(places.select("column_name", F.col("_p")[2].alias("m"))), "column_name").select("column_name", F.abs(x - F.col("m")).alias("v"))  # a row for each column
    mad = zonal.quantiles(dev, k, "v", [0.5]).select("column_name", (F.col("q")[0] / F.lit(0.6744897501960817)).alias("mad"))
    out = base.join(trimmed, "column_name").join(mad, "column_name")
    half = special.t_quantile_column(0.975, F.col("n") - 1) * F.col("sd") / F.sqrt("n")
    return out.select("column_name", "n", F.when(F.col("n") >= 10, F.col("trimmed_mean")).alias("trimmed_mean"), "mad", *[F.col("_p")[i].alias(k) for i, k in enumerate(("p1", "p5", "median", "p95", "p99"))], (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def categorical_summary(df: DataFrame, columns: list[str], top: int = 5) -> DataFrame:
    """Count, distinct values, mode and its share, values of at most max(1, 1 %) rows, entropy, the commonest values."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("e")).select("e.*").where("v is not null")
    freq = long.groupBy("column_name", "v").agg(F.count("*").alias("c"))
    total = freq.groupBy("column_name").agg(F.sum("c").alias("n"))
    f = freq.join(total, "column_name").withColumn("p", F.col("c") / F.col("n"))
    by = Window.partitionBy("column_name").orderBy(F.desc("c"), "v")
    best = f.withColumn("r", F.row_number().over(by)).where(F.col("r") <= top).groupBy("column_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "v", "c"))), lambda x: F.concat_ws("=", x["v"], x["c"].cast("string"))), "|").alias("top_values"))
    out = f.groupBy("column_name").agg(F.max("n").alias("n"), F.count("*").alias("n_distinct"), F.max_by("v", F.struct("c")).alias("_m"), F.max("p").alias("top_share"), F.count_if(F.col("c") <= F.greatest(F.lit(1.0), 0.01 * F.col("n"))).alias("rare"), F.sum(-F.col("p") * F.log("p")).alias("entropy"))
    return out.drop("_m").join(best, "column_name").withColumn("mode", F.regexp_extract("top_values", "^(.*?)=[0-9]+(?:\\||$)", 1))


def datetime_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("timestamp_ntz").alias("v")) for c in columns])).alias("e")).select("e.*")
    days = long.groupBy("column_name", "v").agg(F.count("*").alias("c"))
    return days.groupBy("column_name").agg(F.min("v").alias("first"), F.max("v").alias("last"), F.count("v").alias("n_distinct")).withColumn("range_days", F.datediff("last", "first"))


def missing_pairs(df: DataFrame, columns: list[str], top: int = 5) -> DataFrame:
    """For each column, the columns most often missing with it: one aggregate of all pairs, then a rank over the few pairs."""
    pairs = [(a, b) for a in columns for b in columns if a != b]
    row = df.agg(*[F.count_if(F.col(a).isNull()).alias(f"n_{a}") for a in columns], *[F.count_if(F.col(a).isNull() & F.col(b).isNull()).alias(f"b_{i}") for i, (a, b) in enumerate(pairs)])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("column_name"), F.lit(b).alias("other"), F.col(f"n_{a}").alias("missing"), F.col(f"b_{i}").alias("together")) for i, (a, b) in enumerate(pairs)])).alias("e")).select("e.*")
    by = Window.partitionBy("column_name").orderBy(F.desc("together"), "other")
    return long.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top).withColumn("rate", F.when(F.col("missing") > 0, F.col("together") / F.col("missing")).otherwise(0.0))


def quality_flags(profile: DataFrame, high_missing: float = 30.0, id_like: float = 95.0) -> DataFrame:
    """One row for each flag that a column's profile raises."""
    rules = {"constant": F.col("n_distinct") <= 1, "high_missing": F.col("missing_pct") > high_missing, "id_like": (F.col("unique_pct") >= id_like) & (F.col("n_distinct") > 1)}
    flags = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]))
    return profile.select("column_name", F.explode(flags).alias("flag"))
