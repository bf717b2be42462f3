"""Spatial, file, stream and model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import learning, ranking, spatial
from ..sources import files, shared
from ..streaming import events
from .matches import _POINTS, points
from .registry import Tables, query


@query(f"""{_POINTS}, e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON abs(a.x - b.x) <= 0.01 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.01),
 r AS (WITH RECURSIVE w(a, l) AS (SELECT vec_id, vec_id FROM p UNION SELECT e.b, w.l FROM w JOIN e ON e.a = w.a WHERE w.l < e.b) SELECT a, min(l) AS l FROM w GROUP BY a)
SELECT a AS vec_id, l AS cluster, count(*) OVER (PARTITION BY l) AS size FROM r""")
def connected_clusters(t: Tables) -> DataFrame:
    return spatial.clusters(points(t), "vec_id", "x", "y", 0.01)


@query(f"""{_POINTS}, d AS (SELECT sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS h, (a.label - b.label) * (a.label - b.label) AS g FROM p a JOIN p b ON a.vec_id < b.vec_id)
SELECT CAST(least(floor(h / (0.2 / 10)), 9) AS BIGINT) AS bin, count(*) AS pairs, round(avg(h), 6) AS lag, round(avg(g) / 2, 6) AS semivariance FROM d WHERE h <= 0.2 GROUP BY 1""")
def variogram_bins(t: Tables) -> DataFrame:
    return spatial.variogram(points(t), "vec_id", "x", "y", "label", 10, 0.2).select("bin", "pairs", F.round("lag", 6).alias("lag"), F.round("semivariance", 6).alias("semivariance"))


@query()
def kriging_fill(t: Tables) -> DataFrame:
    from .samples import _cells

    return spatial.krige(_cells(t), ["layer"], "x", "y", "value").select("layer", "y", "x", F.round("filled", 6).alias("filled"))


@query(f"{_POINTS} SELECT vec_id, CASE WHEN x BETWEEN -0.2 AND 0 AND y BETWEEN -0.2 AND 0.05 THEN 1 WHEN x BETWEEN 0 AND 0.3 AND y BETWEEN -0.1 AND 0.1 THEN 2 END AS zone FROM p")
def point_in_polygon(t: Tables) -> DataFrame:
    ring = lambda a, b, c, d: [(a, c), (b, c), (b, d), (a, d)]
    zones = t.spark.createDataFrame([(1, ring(-0.2, 0.0, -0.2, 0.05)), (2, ring(0.0, 0.3, -0.1, 0.1))], "zone int, ring array<struct<x:double,y:double>>")
    p = points(t).select("vec_id", "x", "y")
    return spatial.points_in_polygons(p, zones, "x", "y", "zone", "ring", 0.05).select("vec_id", "zone")


@query()
def smote_points(t: Tables) -> DataFrame:
    return spatial.synthetic(points(t).where("label = 3"), "vec_id", "x", "y", 0.5)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def typed_csv_roundtrip(t: Tables) -> DataFrame:
    path = shared.fresh(t.spark, "files") + "/customer.csv"
    files.write(t.customer, path)
    return files.read(t.spark, path)


@query("SELECT n_nationkey, n_name, CAST(n_regionkey AS INT) AS partition_number FROM nation")
def partition_folders(t: Tables) -> DataFrame:
    root = shared.fresh(t.spark, "files")
    for i in range(5):
        t.nation.where(F.col("n_regionkey") == i).select("n_nationkey", "n_name").write.parquet(f"{root}/partition_{i}/part.parquet")
    return files.read_partitions(t.spark, root)


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_features(t: Tables) -> DataFrame:
    return files.features(t.events, "props", {"k": "k", "missing": "missing"}).select("event_id", "k", "missing")


@query("SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_tumbling(t: Tables) -> DataFrame:
    """The streaming plan run over the table as one batch; tests run it as a stream."""
    w = events.tumbling(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "1 hour", "10 minutes")
    return w.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e)
SELECT user_id, epoch_us(min(ts)) AS start, count(*) AS n FROM s GROUP BY user_id, g""")
def stream_sessions(t: Tables) -> DataFrame:
    s = events.sessions(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "6 hours")
    return s.select("user_id", F.unix_micros("start").alias("start"), "n")


@query()
def model_out_of_fold(t: Tables) -> DataFrame:
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey", "o_orderstatus")
    d = shared.stored(learning.folds(learning.labelled(o, "o_orderstatus"), "o_orderkey", "o_orderstatus", 2).select("o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey", "label", "fold"), "folds")  # each fit reads it
    long = learning.out_of_fold(d, "o_orderkey", ["logistic", "tree"], 2, ["o_totalprice", "c_acctbal", "c_nationkey"])
    return ranking.vote(long).groupBy("prediction").agg(F.count("*").alias("n"))


@query("WITH c AS (SELECT o_orderstatus, count(*) AS c, sum(count(*)) OVER () AS n, count(*) OVER () AS k FROM orders GROUP BY 1) SELECT o_orderstatus, c AS n, round(n / (k * c), 8) AS weight FROM c")
def class_weights(t: Tables) -> DataFrame:
    w = learning.class_weights(t.orders, "o_orderstatus")
    return w.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.max("weight"), 8).alias("weight"))
