"""Order, ranks and deterministic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import root


def running(df: DataFrame, keys: list[str], weight: Column, name: str) -> DataFrame:
    """Adds the sum of ``weight`` over all rows before each in the order of ``keys``, without one task holding all rows."""
    return running_sums(df, keys, {name: weight})


def running_sums(df: DataFrame, keys: list[str], weights: dict[str, Column]) -> DataFrame:
    """Adds the sum of each weight over all rows before each in the order of ``keys``: one order and one store for all of them.

    Rows are range-partitioned and stored with their partition's number, so
    that every later reading has the same; sums run within a partition, and
    only a sum for each partition is gathered to shift them.
    """
    root(df.sparkSession)
    at = {name: (f"_w{i}", f"_i{i}", f"_b{i}") for i, name in enumerate(weights)}
    parts = df.select("*", *[weights[k].alias(w) for k, (w, _, _) in at.items()]).repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()).checkpoint()
    before = Window.partitionBy("_p").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    local = parts.select("*", *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(i) for w, i, _ in at.values()])
    sizes = parts.groupBy("_p").agg(*[F.sum(w).alias(b) for w, _, b in at.values()])
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_p", *[F.sum(b).over(earlier).alias(b) for _, _, b in at.values()])  # a row for each partition
    met = local.join(F.broadcast(shift), "_p")
    return met.select(*df.columns, *[(F.col(i) + F.coalesce(b, F.lit(0))).alias(k) for k, (_, i, b) in at.items()])


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds each row's global position in the order of ``keys``, from 1."""
    return running(df, keys, F.lit(1), name).withColumn(name, F.col(name) + 1)


def mean_ranks(df: DataFrame, column: str) -> DataFrame:
    """value, _c (its rows), _rank (the mean rank of its rows), from counts of equal values; nulls have no rank."""
    freq = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_c"))
    return running(freq, [column], F.col("_c"), "_rank").withColumn("_rank", F.col("_rank") + (F.col("_c") + 1) / F.lit(2.0))


def with_percent_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the mean-tie rank of ``column`` among all rows over the number of its non-null values; null for null."""
    ranks = mean_ranks(df.select(column), column)
    n = df.agg(F.count(column).alias("_n"))
    met = df.join(ranks, column, "left").crossJoin(F.broadcast(n))  # one row
    return met.withColumn(out, F.col("_rank") / F.col("_n")).drop("_c", "_rank", "_n")


def average_rank(by: list[str], value: Column, ascending: bool = True) -> Column:
    """Ranks in which ties share their mean."""
    order = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    w = Window.partitionBy(*by)
    return F.rank().over(w.orderBy(order)) + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / F.lit(2.0)


def percent_rank_mean(by: list[str], value: Column) -> Column:
    """Mean-tie rank over the number of non-null values; null for null."""
    return F.when(value.isNotNull(), average_rank(by, value) / F.count(value).over(Window.partitionBy(*by)))


def adjust_p(df: DataFrame, by: list[str], p: str, out: str = "p_adjusted") -> DataFrame:
    """Benjamini-Hochberg: the running minimum of p n / rank from the largest p down, at most 1; null p stay null."""
    w = Window.partitionBy(*by)
    d = df.withColumn("_n", F.count(p).over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.col(p).asc_nulls_last())))
    d = d.withColumn("_q", F.col(p) * F.col("_n") / F.col("_r"))
    low = F.min("_q").over(w.orderBy(F.col("_r").desc()).rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), low))).drop("_n", "_r", "_q")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The ``n`` rows of least hash: a sample that any partitioning repeats."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def lump(df: DataFrame, column: str, k: int, other: str = "Other") -> DataFrame:
    """Values outside the ``k`` most frequent (ties by value) as ``other``."""
    top = df.groupBy(column).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), column).limit(k).select(column, F.lit(True).alias("_top"))
    return df.join(F.broadcast(top), column, "left").withColumn(column, F.when(F.col("_top"), F.col(column)).otherwise(other)).drop("_top")  # k rows
