"""Queries of holdouts, folds, searches and evaluation curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import holdout, learning, profile, ranking, search, selection
from .decisions import _PROBS, _VOTED, probabilities
from .matches import _POINTS, points
from .registry import Tables, query


def celled(t: Tables) -> DataFrame:
    """Points with their cell of a grid of 10 x 10 over the extent."""
    p = points(t)
    b = p.agg(F.min("x").alias("_x"), F.min("y").alias("_y"), F.greatest(F.max("x") - F.min("x"), F.lit(1e-12)).alias("_w"), F.greatest(F.max("y") - F.min("y"), F.lit(1e-12)).alias("_h"))
    d = p.crossJoin(F.broadcast(b))  # one row
    at = lambda v, low, span: F.least(F.floor((F.col(v) - F.col(low)) / F.col(span) * 10), F.lit(9)).cast("long")
    return d.select("vec_id", "label", at("x", "_x", "_w").alias("cx"), at("y", "_y", "_h").alias("cy"))


_CELLS = _POINTS + """, b AS (SELECT min(x) AS x0, min(y) AS y0, greatest(max(x) - min(x), 1e-12) AS w, greatest(max(y) - min(y), 1e-12) AS h FROM p),
 c AS (SELECT vec_id, label, CAST(least(floor((x - x0) / w * 10), 9) AS BIGINT) AS cx, CAST(least(floor((y - y0) / h * 10), 9) AS BIGINT) AS cy FROM p, b)"""
_DEALT = _CELLS + """, n AS (SELECT cx * 10 + cy AS g, label, count(*) AS n FROM c GROUP BY ALL), g AS (SELECT g, sum(n) AS s, arg_min(label, (-n, label)) AS major FROM n GROUP BY g),
 a AS (SELECT g, row_number() OVER (ORDER BY major, -s, g) - 1 AS i FROM g), f AS (SELECT g, CASE WHEN i // 5 % 2 = 0 THEN i % 5 ELSE 4 - i % 5 END AS fold FROM a),
 m AS (SELECT fold, label, sum(n) AS n FROM n JOIN f USING (g) GROUP BY ALL), t AS (SELECT label, sum(n) AS all_n FROM m GROUP BY label), z AS (SELECT sum(n) AS n, count(DISTINCT label) AS k FROM m), ff AS (SELECT fold, sum(n) AS fn FROM m GROUP BY fold),
 x AS (SELECT ff.fold, fn, t.label, all_n, coalesce(m.n, 0) AS n FROM ff CROSS JOIN t LEFT JOIN m ON m.fold = ff.fold AND m.label = t.label),
 q AS (SELECT fold, CAST(fn AS BIGINT) AS n, count(*) FILTER (x.n = 0) + count(*) FILTER (x.n = all_n) AS missing, avg(abs(x.n / fn - all_n / z.n)) AS drift, abs(fn / z.n - 0.2) AS size FROM x, z GROUP BY fold, fn, z.n)"""


@query(_DEALT + " SELECT CAST(fold AS INT) AS fold, n, missing, round(drift, 9) AS drift, round(size, 9) AS size, round(10 * missing + drift + size, 9) AS score FROM q")
def holdout_scores(t: Tables) -> DataFrame:
    """Each of five folds of whole cells as a holdout of a fifth: classes it misses, drift of class shares, error of size."""
    d = holdout.grouped_folds(celled(t).withColumn("g", F.col("cx") * 10 + F.col("cy")), "g", "label", 5)
    return holdout.holdout_scores(d, "label", 0.2).select("fold", "n", "missing", *[F.round(c, 9).alias(c) for c in ("drift", "size", "score")])


@query(_DEALT + ", best AS (SELECT fold FROM q ORDER BY round(10 * missing + drift + size, 12), fold LIMIT 1) SELECT vec_id, fold = (SELECT fold FROM best) AS test FROM c JOIN f ON f.g = c.cx * 10 + c.cy")
def grouped_holdout(t: Tables) -> DataFrame:
    d = celled(t).withColumn("g", F.col("cx") * 10 + F.col("cy"))
    return holdout.grouped_holdout(d, "g", "label", 0.2).select("vec_id", "test")


@query()
def coverage_holdout(t: Tables) -> DataFrame:
    """A fifth of the rows, of every class its share, that meets as many cells and coarser regions as can be."""
    return holdout.coverage_holdout(celled(t), "vec_id", "label", "cx", "cy", 0.2).select("vec_id", "cx", "cy", "test")


@query(_CELLS + """, s AS (SELECT c.*, scale FROM c, (VALUES (1), (2), (4)) v(scale)), r AS (SELECT scale, cx // scale AS x, cy // scale AS y, count(*) AS n, count(*) FILTER (vec_id % 5 = 0) AS t FROM s GROUP BY ALL)
SELECT scale, count(*) AS regions, count(*) FILTER (t > 0) AS in_test, count(*) FILTER (t < n) AS in_train, CAST(sum(least(n, 2)) AS BIGINT) AS bound FROM r GROUP BY scale""")
def region_coverage(t: Tables) -> DataFrame:
    return holdout.coverage(celled(t).withColumn("test", F.col("vec_id") % 5 == 0), "cx", "cy", "test", [1, 2, 4])


_MEANS = _PROBS + ", m AS (SELECT row, CAST(left(any_value(truth), 1) AS INT) AS truth, CAST(class AS INT) AS class, round(avg(p), 12) AS p FROM p GROUP BY row, class)"


def averaged(t: Tables) -> DataFrame:
    """The four models' mean probability of each class."""
    m = probabilities(t).groupBy("row", "class").agg(F.first("truth").alias("truth"), F.round(F.avg("p"), 12).alias("p"))
    return m.withColumn("truth", F.substring("truth", 1, 1).cast("int"))


@query(_MEANS + """, f AS (SELECT class, p, count(*) AS n, count(*) FILTER (truth = class) AS pos FROM m GROUP BY ALL), s AS (SELECT *, sum(pos) OVER w AS hits, sum(n) OVER w AS seen, sum(pos) OVER (PARTITION BY class) AS yes, sum(n) OVER (PARTITION BY class) AS rows FROM f WINDOW w AS (PARTITION BY class ORDER BY p DESC))
SELECT class, round(p, 9) AS threshold, CAST(hits AS BIGINT) AS hits, CAST(seen - hits AS BIGINT) AS false_alarms, round(hits / yes, 9) AS hit_rate, round((seen - hits) / (rows - yes), 9) AS false_alarm_rate, round(hits / seen, 9) AS precision FROM s""")
def score_curves(t: Tables) -> DataFrame:
    """Points of the receiver and the precision-recall curve of each class against the rest."""
    c = search.curves(averaged(t), "truth")
    return c.select("class", F.round("threshold", 9).alias("threshold"), F.col("hits").cast("long").alias("hits"), F.col("false_alarms").cast("long").alias("false_alarms"), *[F.round(x, 9).alias(x) for x in ("hit_rate", "false_alarm_rate", "precision")])


@query(
    _VOTED.replace("avg(p) AS p", "round(avg(p), 12) AS p")
    + """, k AS (SELECT c.class, count(*) FILTER (truth = c.class) AS t, count(*) FILTER (predicted = c.class) AS q, count(*) FILTER (truth = c.class AND predicted = c.class) AS h FROM y, range(1, 6) c(class) GROUP BY c.class),
 r AS (SELECT class, CAST(left(truth, 1) AS INT) = class AS yes, rank() OVER (PARTITION BY class ORDER BY p) + (count(*) OVER (PARTITION BY class, p) - 1) / 2.0 AS rk FROM m),
 a AS (SELECT class, count(*) FILTER (yes) AS pos, (sum(rk) FILTER (yes) - count(*) FILTER (yes) * (count(*) FILTER (yes) + 1) / 2) / (count(*) FILTER (yes) * count(*) FILTER (NOT yes)) AS auc FROM r GROUP BY class)
SELECT round(sum(h) / sum(t), 6) AS accuracy, round(avg(h / t), 6) AS balanced_accuracy, round(avg(2 * h / (t + q)), 6) AS f1_macro, round(sum(2 * h / (t + q) * t) / sum(t), 6) AS f1_weighted, round(sum(h / nullif(q, 0) * t) / sum(t), 6) AS precision_weighted, round(sum(h / t * t) / sum(t), 6) AS recall_weighted, (SELECT round(sum(auc * pos) / sum(pos), 6) FROM a) AS roc_auc_weighted FROM k"""
)
def metric_row(t: Tables) -> DataFrame:
    m = ranking.metric_row(averaged(t), "truth")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


_ORDERS = "WITH d AS (SELECT o_orderstatus AS y, o_totalprice AS price, o_custkey % 100 AS customer, CAST(month(o_orderdate) AS BIGINT) AS month, o_orderpriority AS priority FROM orders)"


def described(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderstatus").alias("y"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") % 100).alias("customer"), F.month("o_orderdate").cast("long").alias("month"), F.col("o_orderpriority").alias("priority"))


def _ranked(c: str) -> str:
    return f"""SELECT '{c}' AS feature, 'kruskal_epsilon_squared' AS method, CAST(n AS BIGINT) AS rows_used, least(1, greatest(0, ((12.0 / (n * (n + 1.0)) * q - 3 * (n + 1)) / (1 - t / (n::DOUBLE ** 3 - n)) - k + 1) / (n - k))) AS e
FROM (SELECT sum(s * s / m) AS q, count(*) AS k, sum(m) AS n FROM (SELECT y, sum(rk) AS s, count(*)::DOUBLE AS m FROM (SELECT y, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rk FROM d) GROUP BY y)), (SELECT sum(c ** 3 - c) AS t FROM (SELECT count(*)::DOUBLE AS c FROM d GROUP BY {c}))"""


_CRAMER = """SELECT 'priority' AS feature, 'bias_corrected_cramers_v' AS method, CAST(any_value(n) AS BIGINT) AS rows_used, sqrt(greatest(0, sum((o - e) ** 2 / e) / any_value(n) - any_value((r - 1) * (c - 1) / (n - 1))) / any_value(least(r - (r - 1) ** 2 / (n - 1) - 1, c - (c - 1) ** 2 / (n - 1) - 1))) AS e
FROM (SELECT a.y, b.priority, ra * cb / n AS e, n, r, c, (SELECT count(*) FROM d WHERE d.y = a.y AND d.priority = b.priority) AS o FROM (SELECT y, count(*)::DOUBLE AS ra FROM d GROUP BY y) a, (SELECT priority, count(*)::DOUBLE AS cb FROM d GROUP BY priority) b, (SELECT count(*)::DOUBLE AS n, count(DISTINCT y) AS r, count(DISTINCT priority) AS c FROM d))"""


@query(_ORDERS + f""", f AS ({_ranked('price')} UNION ALL {_ranked('customer')} UNION ALL {_ranked('month')} UNION ALL {_CRAMER})
SELECT feature, method, rows_used, round(e, 8) AS effect_size, CASE WHEN method LIKE 'kruskal%' THEN CASE WHEN e >= 0.14 THEN 'large' WHEN e >= 0.06 THEN 'moderate' WHEN e >= 0.01 THEN 'small' ELSE 'negligible' END ELSE CASE WHEN e >= 0.5 THEN 'strong' WHEN e >= 0.3 THEN 'moderate' WHEN e >= 0.1 THEN 'weak' ELSE 'negligible' END END AS strength, CAST(rank() OVER (PARTITION BY method ORDER BY e DESC) AS INT) AS rank FROM f""")
def feature_associations(t: Tables) -> DataFrame:
    """Effect sizes of four features of orders on their state; p-values have no SQL and are tested apart."""
    a = selection.associations(described(t), "y", ["price", "customer", "month"], ["priority"], True)
    return a.select("feature", "method", "rows_used", F.round("effect_size", 8).alias("effect_size"), "strength", "rank")


@query()
def feature_proposal(t: Tables) -> DataFrame:
    """Lines' features proposed for their return flag: exclusions, quality, evidence, redundancy, shortlist."""
    numeric, categorical = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"], ["l_linestatus"]
    d = t.lineitem.select("l_returnflag", *numeric, *categorical)
    found = selection.associations(d, "l_returnflag", numeric, categorical, True)
    flags = profile.quality_flags(profile.column_profile(d))
    return selection.proposal(found, flags, selection.redundancy(d), excluded=["l_linenumber"], most=3)


@query()
def halving_search(t: Tables) -> DataFrame:
    """Eight candidates of two models for orders' states by halving."""
    o = t.orders.select("o_orderkey", "o_totalprice", F.month("o_orderdate").cast("double").alias("month"), F.year("o_orderdate").cast("double").alias("year"), "o_orderstatus")
    d = learning.folds(learning.labelled(o, "o_orderstatus"), "o_orderkey", "o_orderstatus", 2)
    candidates = search.drawn({"tree": {"maxDepth": [2, 4, 6], "minInstancesPerNode": [1, 20]}, "logistic": {"regParam": [0.0, 0.01, 0.1]}}, 4)
    return search.halving(d, "o_orderkey", ["o_totalprice", "month", "year"], candidates, 2, 2000)
