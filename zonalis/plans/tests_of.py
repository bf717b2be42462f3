"""Statistical queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import special
from ..operators import cleaning, order, outliers, stats
from .profiles import _HOLES, holes
from .registry import Tables, query

_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(_COLS) for b in _COLS[i + 1 :]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 8) AS r, count(*) AS n FROM lineitem" for a, b in _PAIRS))
def pearson_matrix(t: Tables) -> DataFrame:
    return stats.pearson(t.lineitem, _COLS).withColumn("r", F.round("r", 8))


_NET = "(SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem)"


@query("SELECT x, y, round(r, 8) AS r FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS r FROM {_NET}" for a, b in [*_PAIRS, *((c, "net") for c in _COLS)]) + ") WHERE abs(r) >= 0.5")
def strong_pairs(t: Tables) -> DataFrame:
    """Strongly correlated pairs among the columns and the price less discount."""
    net = t.lineitem.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return stats.pearson(net, [*_COLS, "net"]).where("abs(r) >= 0.5").select("x", "y", F.round("r", 8).alias("r"))


@query("""WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, round(corr(a, b), 8) AS rho, count(*) AS n FROM r""")
def spearman_matrix(t: Tables) -> DataFrame:
    return stats.spearman(t.lineitem, "l_quantity", "l_extendedprice").withColumn("rho", F.round("rho", 8))


def _chi(a: str, b: str, table: str, yates: bool = False) -> str:
    off = "abs(o - e) - least(0.5, abs(o - e))" if yates else "abs(o - e)"
    return f"""WITH o AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {table} GROUP BY ALL), ra AS (SELECT a, sum(o) AS ra FROM o GROUP BY a), cb AS (SELECT b, sum(o) AS cb FROM o GROUP BY b), n AS (SELECT sum(o) AS n FROM o),
g AS (SELECT coalesce(o.o, 0) AS o, ra * cb / n AS e, n FROM ra CROSS JOIN cb CROSS JOIN n LEFT JOIN o USING (a, b)), s AS (SELECT sum(({off}) * ({off}) / e) AS chi2, any_value(n) AS n FROM g),
d AS (SELECT (SELECT count(*) FROM ra) AS r, (SELECT count(*) FROM cb) AS c)
SELECT '{a}' AS x, '{b}' AS y, round(chi2, 6) AS chi2, CAST((r - 1) * (c - 1) AS BIGINT) AS df, CAST(n AS BIGINT) AS n, round(sqrt(chi2 / n / least(r - 1, c - 1)), 6) AS cramers_v,
 round(sqrt(greatest(chi2 / n - (r - 1) * (c - 1) / (n - 1), 0) / least(r - (r - 1) * (r - 1) / (n - 1) - 1, c - (c - 1) * (c - 1) / (n - 1) - 1)), 6) AS cramers_v_corrected FROM s, d"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("chi2", "cramers_v", "cramers_v_corrected")})


@query(_chi("o_orderpriority", "o_orderstatus", "orders"))
def chi2_cramers_v(t: Tables) -> DataFrame:
    return _rounded(stats.chi2(t.orders, "o_orderpriority", "o_orderstatus"))


@query(_chi("l_linestatus", "taxed", "(SELECT l_linestatus, l_tax > 0.04 AS taxed FROM lineitem)", True))
def chi2_yates_2x2(t: Tables) -> DataFrame:
    return _rounded(stats.chi2(t.lineitem.withColumn("taxed", F.col("l_tax") > 0.04), "l_linestatus", "taxed"))


@query(_chi("priority_missing", "status", f"(SELECT priority IS NULL AS priority_missing, status FROM ({_HOLES}) WHERE status IS NOT NULL)"))
def missingness_vs_target(t: Tables) -> DataFrame:
    return _rounded(stats.chi2(holes(t).withColumn("priority_missing", F.col("priority").isNull()), "priority_missing", "status"))


@query("""WITH g AS (SELECT o_orderpriority AS k, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1), t AS (SELECT sum(n * m) / sum(n) AS mm, sum(n) AS nn, count(*) AS kk FROM g),
s AS (SELECT sum(n * (m - mm) * (m - mm)) AS b, sum(n * v) AS w, any_value(kk) AS k, any_value(nn) AS n FROM g, t) SELECT round(b / (k - 1) / (w / (n - k)), 6) AS f, round(b / (b + w), 8) AS eta_squared, CAST(k - 1 AS BIGINT) AS df1, CAST(n - k AS BIGINT) AS df2 FROM s""")
def anova_eta(t: Tables) -> DataFrame:
    return stats.anova(t.orders, "o_orderpriority", "o_totalprice").withColumn("f", F.round("f", 6)).withColumn("eta_squared", F.round("eta_squared", 8))


@query("""WITH r AS (SELECT l_returnflag AS g, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS rk FROM lineitem), t AS (SELECT sum(c::DOUBLE * c * c - c) AS t, sum(c)::DOUBLE AS n FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_quantity)),
q AS (SELECT sum(s * s / m) AS q, count(*) AS k FROM (SELECT g, count(*) AS m, sum(rk) AS s FROM r GROUP BY g)), h AS (SELECT (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - t / (n * n * n - n)) AS h, k, n FROM q, t)
SELECT round(h, 4) AS h, round((h - k + 1) / (n - k), 8) AS epsilon_squared, k, CAST(n AS BIGINT) AS n FROM h""")
def kruskal_epsilon(t: Tables) -> DataFrame:
    return stats.kruskal(t.lineitem, "l_returnflag", "l_quantity").withColumn("h", F.round("h", 4)).withColumn("epsilon_squared", F.round("epsilon_squared", 8))


@query("""WITH p AS (SELECT p_brand AS k, p_partkey, ((p_partkey * 37) % 1009 + 1) / 1010.0::DOUBLE AS p FROM part), r AS (SELECT *, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY p, p_partkey) AS rk FROM p)
SELECT k, p_partkey, round(least(1.0, min(p * n / rk) OVER (PARTITION BY k ORDER BY rk DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 8) AS adjusted FROM r""")
def bh_adjust(t: Tables) -> DataFrame:
    p = t.part.select(F.col("p_brand").alias("k"), "p_partkey", (((F.col("p_partkey") * 37) % 1009 + 1) / 1010.0).alias("p"))
    return order.adjust_p(p, ["k"], "p", "adjusted").select("k", "p_partkey", F.round("adjusted", 8).alias("adjusted"))


@query("""SELECT x, y, round(tau, 8) AS tau_b, n FROM (WITH o AS (SELECT l_tax AS x, l_discount AS y, count(*) AS c FROM lineitem GROUP BY ALL), s AS (SELECT sum(a.c * b.c * sign(b.y - a.y)) AS s FROM o a JOIN o b ON a.x < b.x),
tx AS (SELECT sum(t * (t - 1) / 2) AS t FROM (SELECT sum(c) AS t FROM o GROUP BY x)), ty AS (SELECT sum(t * (t - 1) / 2) AS t FROM (SELECT sum(c) AS t FROM o GROUP BY y)), n AS (SELECT CAST(sum(c) AS BIGINT) AS n FROM o)
SELECT 'l_tax' AS x, 'l_discount' AS y, s / sqrt((n * (n - 1) / 2 - tx.t) * (n * (n - 1) / 2 - ty.t)) AS tau, n FROM s, tx, ty, n)""")
def kendall_tau(t: Tables) -> DataFrame:
    return stats.kendall_tables(t.lineitem, "l_tax", "l_discount").select(F.lit("l_tax").alias("x"), F.lit("l_discount").alias("y"), F.round("tau_b", 8).alias("tau_b"), "n")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, round(n * 1.0 / 6 * (g1 * g1 + g2 * g2 / 4), 4) AS jb FROM (SELECT count({c}) AS n, avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5) AS g1, avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3 AS g2 FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)) z, lineitem GROUP BY n, g1, g2" for c in ("l_quantity", "l_extendedprice")))
def jarque_bera(t: Tables) -> DataFrame:
    return stats.jarque_bera(t.lineitem, ["l_quantity", "l_extendedprice"]).withColumn("jb", F.round("jb", 4))


@query("""WITH s AS (SELECT avg(l_quantity) AS ma, avg(l_extendedprice) AS mb, var_samp(l_quantity) AS va, var_samp(l_extendedprice) AS vb, covar_samp(l_quantity, l_extendedprice) AS c FROM lineitem),
d AS (SELECT l_orderkey, l_linenumber, ((l_quantity - ma) * (l_quantity - ma) * vb - 2 * (l_quantity - ma) * (l_extendedprice - mb) * c + (l_extendedprice - mb) * (l_extendedprice - mb) * va) / (va * vb - c * c) AS d2 FROM lineitem, s)
SELECT l_orderkey, l_linenumber, round(d2, 6) AS d2, d2 > 7.377758908227871 AS is_outlier FROM d ORDER BY round(d2, 6) DESC, l_orderkey, l_linenumber LIMIT 100""")
def mahalanobis_topk(t: Tables) -> DataFrame:
    m = stats.mahalanobis(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    m = m.select("l_orderkey", "l_linenumber", F.round("d2", 6).alias("d2"), "is_outlier")
    return m.orderBy(F.desc("d2"), "l_orderkey", "l_linenumber").limit(100)


@query("SELECT i AS component, round((1 + CASE i WHEN 1 THEN 1 ELSE -1 END * abs(r)) / 2, 8) AS share, round(CASE i WHEN 1 THEN (1 + abs(r)) / 2 ELSE 1.0 END, 8) AS running FROM (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem), range(1, 3) x(i)")
def pca_variance(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(stats.pca(t.lineitem, ["l_quantity", "l_extendedprice"]), "component long, share double, running double").select("component", F.round("share", 8).alias("share"), F.round("running", 8).alias("running"))


@query("SELECT c AS column_name, round(1 / (1 - r * r), 6) AS vif FROM (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem), (VALUES ('l_quantity'), ('l_extendedprice')) v(c)")
def vif(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(stats.vif(t.lineitem, ["l_quantity", "l_extendedprice"]), "column_name string, vif double").withColumn("vif", F.round("vif", 6))


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS d, avg(l_quantity) AS ma, var_samp(l_quantity) AS va, var_samp(l_extendedprice) AS vb, covar_samp(l_quantity, l_extendedprice) AS c FROM lineitem),
v AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice > q3 + 1.0 * (q3 - q1) AS INT) AS a, CASE WHEN l_linenumber <> 3 THEN CAST(abs((l_extendedprice - m) / d) > 2 AS INT) END AS b,
 CAST(((l_quantity - ma) * (l_quantity - ma) * vb - 2 * (l_quantity - ma) * (l_extendedprice - m) * c + (l_extendedprice - m) * (l_extendedprice - m) * va) / (va * vb - c * c) > 7.377758908227871 AS INT) AS e FROM lineitem, q)
SELECT count(*) AS n, count(*) FILTER (a + coalesce(b, 0) + e > (2 + (b IS NOT NULL)::INT) / 2.0) AS outliers, CAST(sum(a + coalesce(b, 0) + e) AS BIGINT) AS votes FROM v""")
def outlier_vote(t: Tables) -> DataFrame:
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    b = cleaning.fences(l, [], "l_extendedprice", 1.0).select("upper", "lower")
    d = stats.mahalanobis(l, ["l_quantity", "l_extendedprice"]).withColumnRenamed("is_outlier", "far")
    d = cleaning.zscore(d, [], "l_extendedprice", 2.0).withColumn("zvote", F.when(F.col("l_linenumber") != 3, F.col("is_outlier"))).drop("is_outlier").crossJoin(F.broadcast(b))  # one row
    d = d.withColumn("fence", F.col("l_extendedprice") > F.col("upper"))
    v = stats.outlier_vote(d, ["fence", "zvote", "far"])
    return v.agg(F.count("*").alias("n"), F.count_if("is_outlier").alias("outliers"), F.sum("votes").cast("long").alias("votes"))


_STANDARD = "WITH s AS (SELECT avg(p_size) AS ma, stddev_pop(p_size) AS sa, avg(p_retailprice) AS mb, stddev_pop(p_retailprice) AS sb FROM part), z AS (SELECT p_partkey, (p_size - ma) / sa AS x, (p_retailprice - mb) / sb AS y FROM part, s)"


@query(_STANDARD + """, m AS (SELECT a.p_partkey, b.p_partkey AS other FROM z a JOIN z b ON b.x BETWEEN a.x - 0.06 AND a.x + 0.06 AND b.y BETWEEN a.y - 0.06 AND a.y + 0.06 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.0036),
c AS (SELECT p_partkey FROM m GROUP BY p_partkey HAVING count(*) >= 8) SELECT p_partkey, p_partkey NOT IN (SELECT m.p_partkey FROM m JOIN c ON c.p_partkey = m.other) AS noise FROM z""")
def density_noise(t: Tables) -> DataFrame:
    """Parts that density clustering (0.06, eight points) of two standardised columns leaves over."""
    z = outliers.standardised(t.part, ["p_size", "p_retailprice"])
    d = t.part.select("p_partkey", z["p_size"].alias("x"), z["p_retailprice"].alias("y"))
    lone = outliers.noise(d, "x", "y", 0.06, 8).withColumn("noise", F.lit(True))
    return d.join(lone, ["x", "y"], "left").select("p_partkey", F.coalesce("noise", F.lit(False)).alias("noise"))


@query()
def outlier_vote_five(t: Tables) -> DataFrame:
    """Votes of all five methods; the forest's random trees have no SQL."""
    return outliers.five_votes(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])


@query()
def test_p_values(t: Tables) -> DataFrame:
    """p-values of the three tests above; their tails have no SQL."""
    c = stats.chi2(t.orders, "o_orderpriority", "o_orderstatus").first()
    a = stats.anova(t.orders, "o_orderpriority", "o_totalprice").first()
    k = stats.kruskal(t.lineitem, "l_returnflag", "l_quantity").first()
    rows = [("chi2", special.chi2_sf(c["chi2"], c["df"])), ("anova", special.f_sf(a["f"], a["df1"], a["df2"])), ("kruskal", special.chi2_sf(k["h"], k["k"] - 1))]
    return order.adjust_p(t.spark.createDataFrame(rows, "test string, p double"), [], "p")
