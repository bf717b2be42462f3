"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile
from .registry import Tables, query

#: Orders with holes: the price is missing on a seventh of the rows, the priority on some of the same.
_HOLES = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 21 <> 0 AND o_orderkey % 10 <> 0 THEN o_orderpriority END AS priority, CASE WHEN o_custkey % 11 <> 0 THEN o_orderstatus END AS status FROM orders"


def holes(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", "o_custkey", F.when(k % 7 != 0, F.col("o_totalprice")).alias("price"), F.when((k % 21 != 0) & (k % 10 != 0), F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderstatus")).alias("status"))


def _each(columns: list[str], select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in columns)


@query(f"WITH h AS ({_HOLES}) SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM h)) AS duplicate_rows, CAST(sum((price IS NULL)::INT + (priority IS NULL)::INT + (status IS NULL)::INT) AS BIGINT) AS missing FROM h")
def dataset_summary(t: Tables) -> DataFrame:
    h = holes(t)
    groups = h.groupBy(*h.columns).agg(F.count("*").alias("_c"))
    missing = sum((F.col(c).isNull().cast("long") for c in h.columns), F.lit(0))
    return groups.agg(F.sum("_c").alias("n_rows"), F.lit(len(h.columns)).cast("long").alias("n_columns"), F.sum(F.col("_c") - 1).alias("duplicate_rows"), F.sum(missing * F.col("_c")).alias("missing"))


@query(f"WITH h AS ({_HOLES}) " + _each(["o_custkey", "price", "priority", "status"], "SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, round((1 - count({c}) / count(*)) * 100, 6) AS missing_pct, round(count(DISTINCT {c}) / count({c}) * 100, 6) AS unique_pct, count(DISTINCT {c}) <= 1 AS is_constant FROM h"))
def column_profile(t: Tables) -> DataFrame:
    p = profile.column_profile(holes(t), ["o_custkey", "price", "priority", "status"])
    return p.withColumn("missing_pct", F.round("missing_pct", 6)).withColumn("unique_pct", F.round("unique_pct", 6))


@query(_each(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, round(median({c}), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3, max({c}) AS max, round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr, round(skewness({c}), 4) AS skewness, round(kurtosis({c}), 4) AS kurtosis, round(stddev_samp({c}) / avg({c}), 6) AS cv, count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} < 0) AS negatives FROM lineitem"))
def numeric_summary(t: Tables) -> DataFrame:
    s = profile.numeric_summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return s.select("column_name", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "max", *[F.round(c, 4).alias(c) for c in ("iqr", "skewness", "kurtosis")], F.round("cv", 6).alias("cv"), "zeros", "negatives")


_ROBUST = """SELECT '{c}' AS column_name, any_value(n) AS n, round(avg(v) FILTER (rn > floor(n * 0.1) AND rn <= n - floor(n * 0.1)), 4) AS trimmed_mean, round(median(abs(v - m)) / 0.6744897501960817, 4) AS mad, round(quantile_cont(v, 0.01), 4) AS p1, round(quantile_cont(v, 0.05), 4) AS p5, round(median(v), 4) AS median, round(quantile_cont(v, 0.95), 4) AS p95, round(quantile_cont(v, 0.99), 4) AS p99
FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n, median({c}) OVER () AS m FROM lineitem)"""


@query(_each(["l_quantity", "l_extendedprice", "l_discount"], _ROBUST))
def robust_summary(t: Tables) -> DataFrame:
    s = profile.robust_summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return s.select("column_name", "n", *[F.round(c, 4).alias(c) for c in ("trimmed_mean", "mad", "p1", "p5", "median", "p95", "p99")])


_CAT = """SELECT '{c}' AS column_name, CAST(sum(c) AS BIGINT) AS n, count(*) AS n_distinct, round(max(p), 6) AS top_share, count(*) FILTER (c <= greatest(1.0, 0.01 * n)) AS rare, round(sum(-p * ln(p)), 6) AS entropy, string_agg(v || '=' || c, '|' ORDER BY c DESC, v) FILTER (rn <= 5) AS top_values, arg_max(v, c) FILTER (rn = 1) AS mode
FROM (SELECT {c} AS v, count(*) AS c, sum(count(*)) OVER () AS n, count(*) / sum(count(*)) OVER () AS p, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rn FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY {c})"""


@query(_each(["c_mktsegment", "n_name"], _CAT))
def categorical_summary(t: Tables) -> DataFrame:
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    s = profile.categorical_summary(df, ["c_mktsegment", "n_name"])
    return s.withColumn("top_share", F.round("top_share", 6)).withColumn("entropy", F.round("entropy", 6))


@query("SELECT 'o_orderdate' AS column_name, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last, count(DISTINCT o_orderdate) AS n_distinct, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS INT) AS range_days FROM orders")
def datetime_summary(t: Tables) -> DataFrame:
    s = profile.datetime_summary(t.orders, ["o_orderdate"])
    return s.select("column_name", F.date_format("first", "yyyy-MM-dd").alias("first"), F.date_format("last", "yyyy-MM-dd").alias("last"), "n_distinct", "range_days")


@query(f"WITH h AS ({_HOLES}), p AS (" + " UNION ALL ".join(f"SELECT '{a}' AS column_name, '{b}' AS other, count(*) FILTER ({a} IS NULL) AS missing, count(*) FILTER ({a} IS NULL AND {b} IS NULL) AS together FROM h" for a in ("price", "priority", "status") for b in ("price", "priority", "status") if a != b) + ") SELECT column_name, other, missing, together, CAST(row_number() OVER (PARTITION BY column_name ORDER BY together DESC, other) AS INT) AS rank, round(together / missing, 6) AS rate FROM p")
def missingness_pairs(t: Tables) -> DataFrame:
    return profile.missing_pairs(holes(t), ["price", "priority", "status"]).withColumn("rate", F.round("rate", 6))


@query(f"WITH h AS ({_HOLES}), x AS (SELECT *, 1 AS one FROM h), p AS (" + _each(["o_orderkey", "price", "status", "one"], "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS d, (1 - count({c}) / count(*)) * 100 AS m, count(DISTINCT {c}) / count({c}) * 100 AS u FROM x") + ") SELECT column_name, unnest(list_filter([CASE WHEN d <= 1 THEN 'constant' END, CASE WHEN m > 10 THEN 'high_missing' END, CASE WHEN u >= 95 AND d > 1 THEN 'id_like' END], lambda f: f IS NOT NULL)) AS flag FROM p")
def data_quality_flags(t: Tables) -> DataFrame:
    p = profile.column_profile(holes(t).withColumn("one", F.lit(1)), ["o_orderkey", "price", "status", "one"])
    return profile.quality_flags(p, high_missing=10.0)


@query("SELECT o_orderpriority AS target, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct, round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders GROUP BY 1")
def target_summary(t: Tables) -> DataFrame:
    g = t.orders.groupBy(F.col("o_orderpriority").alias("target")).agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"), F.round(F.median("o_totalprice"), 4).alias("median"), F.round(F.stddev_samp("o_totalprice"), 4).alias("std"), F.min("o_totalprice").alias("min"), F.max("o_totalprice").alias("max"))
    total = g.agg(F.sum("n").alias("_t"))
    return g.crossJoin(F.broadcast(total)).withColumn("pct", F.round(F.col("n") / F.col("_t") * 100, 6)).drop("_t")  # one row
