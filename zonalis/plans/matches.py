"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import joins
from .registry import Tables, query


@query("""
WITH l AS (SELECT o_custkey AS k, o_orderkey, o_orderdate AS at FROM orders WHERE o_orderpriority = '1-URGENT'),
r AS (SELECT o_custkey AS k, o_orderdate AS at, max(o_totalprice) AS price FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY ALL)
SELECT l.o_orderkey, r.price AS last_price FROM l ASOF LEFT JOIN r ON l.k = r.k AND l.at >= r.at""")
def asof_backward(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey", F.col("o_orderdate").alias("at"), "o_totalprice", "o_orderpriority")
    left = o.where("o_orderpriority = '1-URGENT'").select("k", "o_orderkey", "at")
    right = o.where("o_orderpriority <> '1-URGENT'").groupBy("k", "at").agg(F.max("o_totalprice").alias("last_price"))
    return joins.asof(left, right, ["k"], "at", ["last_price"]).select("o_orderkey", "last_price")


@query("""
WITH l AS (SELECT o_custkey AS k, o_orderkey, o_orderdate AS at FROM orders WHERE o_orderpriority = '1-URGENT'),
r AS (SELECT o_custkey AS k, o_orderdate AS at, max(o_totalprice) AS price FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY ALL)
SELECT l.o_orderkey, r.price AS next_price FROM l ASOF LEFT JOIN r ON l.k = r.k AND l.at < r.at""")
def asof_forward(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey", F.col("o_orderdate").alias("at"), "o_totalprice", "o_orderpriority")
    left = o.where("o_orderpriority = '1-URGENT'").select("k", "o_orderkey", "at")
    right = o.where("o_orderpriority <> '1-URGENT'").groupBy("k", "at").agg(F.max("o_totalprice").alias("next_price"))
    return joins.asof(left, right, ["k"], "at", ["next_price"], "forward", allow_exact=False).select("o_orderkey", "next_price")


@query("""
WITH p AS (SELECT i AS period, 5000.0 * i AS lo, 5000.0 * (i + 1) AS hi FROM range(0, 120) r(i))
SELECT p.period, count(*) AS n, round(avg(o_totalprice), 2) AS mean FROM orders JOIN p ON o_totalprice >= lo AND o_totalprice < hi GROUP BY p.period""")
def interval_join_periods(t: Tables) -> DataFrame:
    periods = t.spark.range(120).select(F.col("id").alias("period"), (F.col("id") * 5000.0).alias("lo"), ((F.col("id") + 1) * 5000.0).alias("hi"))
    got = joins.interval(t.orders.select("o_totalprice"), periods, "o_totalprice", "lo", "hi", 5000.0)
    return got.groupBy("period").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 2).alias("mean"))


@query("""
WITH d AS (SELECT c_custkey, s_suppkey, abs(c_acctbal - s_acctbal) AS dist, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(c_acctbal - s_acctbal), s_suppkey) AS rn
 FROM customer JOIN supplier ON c_nationkey = s_nationkey)
SELECT c.c_custkey, d.s_suppkey, round(d.dist, 6) AS distance FROM customer c LEFT JOIN d ON d.c_custkey = c.c_custkey AND rn = 1""")
def nearest_1nn(t: Tables) -> DataFrame:
    left = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("n"))
    right = t.supplier.select("s_suppkey", "s_acctbal", F.col("s_nationkey").alias("n"))
    got = joins.nearest_1d(left, right, "c_custkey", "c_acctbal", "s_suppkey", "s_acctbal", ["n"])
    return got.select("c_custkey", "s_suppkey", F.round("distance", 6).alias("distance"))


_POINTS = "WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label FROM embeddings)"


def points(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"), "label")


@query(_POINTS + """, d AS (SELECT a.vec_id, b.label AS v, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist FROM p a JOIN p b ON b.label >= 5 WHERE a.label < 5)
SELECT a.vec_id, round(f, 4) AS filled, coalesce(n, 0) AS donors FROM p a LEFT JOIN (SELECT vec_id, sum(v / greatest(dist, 1e-6)) / sum(1 / greatest(dist, 1e-6)) AS f, count(*) AS n FROM d WHERE dist <= 0.05 GROUP BY vec_id) USING (vec_id) WHERE a.label < 5""")
def idw_fill(t: Tables) -> DataFrame:
    p = points(t)
    donors = p.where("label >= 5").select(F.col("x").alias("dx"), F.col("y").alias("dy"), F.col("label").alias("v"))
    got = joins.idw(p.where("label < 5"), donors, "vec_id", "x", "y", "dx", "dy", "v", 0.05)
    return got.select("vec_id", F.round("filled", 4).alias("filled"), F.coalesce("donors", F.lit(0)).cast("long").alias("donors"))


@query(_POINTS + """, d AS (SELECT a.vec_id, b.vec_id AS near_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist FROM p a JOIN p b ON b.label = 0 WHERE a.label <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, near_id) AS rn FROM d WHERE dist <= 0.25)
SELECT p.vec_id, near_id, round(dist, 6) AS distance FROM p LEFT JOIN r ON r.vec_id = p.vec_id AND rn = 1 WHERE p.label <> 0""")
def nearest_point_join(t: Tables) -> DataFrame:
    p = points(t)
    right = p.where("label = 0").select(F.col("vec_id").alias("near_id"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    left = p.where("label <> 0")
    got = joins.nearest_2d(left, right, ["vec_id"], "x", "y", "rx", "ry", ["near_id"], ["near_id"], most=0.25)
    return got.select("vec_id", "near_id", F.round("distance", 6).alias("distance"))


@query(_POINTS + """, d AS (SELECT a.vec_id, b.vec_id AS near_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist FROM p a JOIN p b ON b.label = 0 AND b.vec_id % 40 = 0 WHERE a.label <> 0)
SELECT vec_id, arg_min(near_id, (dist, near_id)) AS near_id, round(min(dist), 6) AS distance FROM d GROUP BY vec_id""")
def nearest_point_anywhere(t: Tables) -> DataFrame:
    """The nearest of few sites, however far it lies."""
    p = points(t)
    sites = p.where("label = 0 and vec_id % 40 = 0").select(F.col("vec_id").alias("near_id"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    got = joins.nearest_2d(p.where("label <> 0"), sites, ["vec_id"], "x", "y", "rx", "ry", ["near_id"], ["near_id"])
    return got.select("vec_id", "near_id", F.round("distance", 6).alias("distance"))


@query(_POINTS + """, b AS (SELECT min(x) AS x0, min(y) AS y0, (max(x) - min(x)) / 8 AS w, (max(y) - min(y)) / 6 AS h FROM p)
SELECT vec_id, CAST(least(greatest(floor((x - x0) / w), 0), 7) AS BIGINT) AS col, CAST(least(greatest(floor((y - y0) / h), 0), 5) AS BIGINT) AS row FROM p, b""")
def grid_assign(t: Tables) -> DataFrame:
    p = points(t)
    b = p.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), ((F.max("x") - F.min("x")) / 8).alias("w"), ((F.max("y") - F.min("y")) / 6).alias("h"))
    j = p.crossJoin(F.broadcast(b))  # one row
    return j.select("vec_id", joins.grid_cell(F.col("x"), F.col("x0"), F.col("w"), 8).alias("col"), joins.grid_cell(F.col("y"), F.col("y0"), F.col("h"), 6).alias("row"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def anti_join_uncovered(t: Tables) -> DataFrame:
    """Customers that no large order covers."""
    return t.customer.join(t.orders.where("o_totalprice > 450000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)")
def semi_join(t: Tables) -> DataFrame:
    c = t.customer.where("c_acctbal < 0")
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.col("o_custkey").alias("c_custkey")).distinct()


@query("""
WITH k AS (SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'HIGH' ELSE 'MEDIUM' END AS level FROM nation WHERE n_nationkey < 15)
SELECT c_custkey, coalesce(k.level, 'LOW') AS level, k.level IS NOT NULL AS valid FROM customer JOIN nation n ON c_nationkey = n_nationkey LEFT JOIN k USING (n_name)""")
def contract_lookup(t: Tables) -> DataFrame:
    contract = t.nation.where("n_nationkey < 15").select("n_name", F.when(F.col("n_nationkey") % 3 == 0, "HIGH").otherwise("MEDIUM").alias("level"), F.lit(True).alias("valid"))
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return joins.lookup(c, contract, ["n_name"], {"level": "LOW", "valid": False}).select("c_custkey", "level", "valid")


@query("""
WITH a AS (SELECT l_suppkey AS k, avg(l_discount) AS m FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), b AS (SELECT l_suppkey AS k, avg(l_discount) AS m FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 3 = 0 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, round(a.m, 6) AS train, round(b.m, 6) AS test, round(a.m - b.m, 6) AS gap FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_gap(t: Tables) -> DataFrame:
    l = t.lineitem
    a = l.where("l_returnflag = 'A'").groupBy(F.col("l_suppkey").alias("k")).agg(F.avg("l_discount").alias("a"))
    b = l.where("l_returnflag = 'R' and l_suppkey % 3 = 0").groupBy(F.col("l_suppkey").alias("k")).agg(F.avg("l_discount").alias("b"))
    return a.join(b, "k", "full_outer").select("k", F.round("a", 6).alias("train"), F.round("b", 6).alias("test"), F.round(F.col("a") - F.col("b"), 6).alias("gap"))


@query("""
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders), b AS (SELECT o_orderkey AS key2, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders)
SELECT a.o_orderkey, b.o_totalprice FROM a JOIN b USING (pos) WHERE a.o_orderkey = b.key2""")
def positional_join(t: Tables) -> DataFrame:
    from ..operators.order import numbered

    a = numbered(t.orders.select("o_orderkey"), ["o_orderkey"], "pos")
    b = numbered(t.orders.select(F.col("o_orderkey").alias("key2"), "o_totalprice"), ["key2"], "pos")
    return a.join(b, "pos").where("o_orderkey = key2").select("o_orderkey", "o_totalprice")


@query("""
WITH a AS (SELECT o_custkey, o_totalprice, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
SELECT c_custkey, c_mktsegment, o_orderkey AS top_order FROM customer LEFT JOIN a ON o_custkey = c_custkey AND rn = 1""")
def largest_area_label_join(t: Tables) -> DataFrame:
    top = t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("top_order"))
    return t.customer.join(top, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_mktsegment", "top_order")
