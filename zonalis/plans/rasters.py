"""Queries over resampled rasters, stored cubes, published parts, normality tests and calibrated scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import calibration, normality, resample
from ..operators.polygons import Grid
from ..sources import cubes, publish, shared
from .polygons import _RASTER, raster
from .registry import Tables, query

_SOURCE, _TARGET = Grid(0.0, 48.0, 1.0, 1.0, 64, 48), Grid(-1.0, 49.0, 0.37, 0.61, 180, 80)
#: Centres of the target's cells, in columns and rows of the source.
_CENTRES = "t AS (SELECT r.r AS row, c.c AS col, -1 + (c.c + 0.5::DOUBLE) * 0.37::DOUBLE AS fx, 48 - (49 - (r.r + 0.5::DOUBLE) * 0.61::DOUBLE) AS fy FROM range(80) r(r), range(180) c(c)), i AS (SELECT * FROM t WHERE fx >= 0 AND fx < 64 AND fy >= 0 AND fy < 48)"


@query(f"""WITH {_RASTER}, {_CENTRES}, q AS (SELECT row, col, floor(fy - 0.5) + a.a AS r, floor(fx - 0.5) + b.b AS c, CASE a.a WHEN 1 THEN fy - 0.5 - floor(fy - 0.5) ELSE 1 - (fy - 0.5 - floor(fy - 0.5)) END * CASE b.b WHEN 1 THEN fx - 0.5 - floor(fx - 0.5) ELSE 1 - (fx - 0.5 - floor(fx - 0.5)) END AS w FROM i, range(2) a(a), range(2) b(b))
SELECT q.row, q.col, round(0.7310585786::DOUBLE * (sum(value * w) / sum(w)), 8) AS value FROM q JOIN p ON p.row = q.r AND p.col = q.c WHERE w > 0 GROUP BY q.row, q.col""")
def resample_bilinear(t: Tables) -> DataFrame:
    """Scaled by an odd factor, so that no value ends in a rounding tie."""
    return resample.resample(raster(t), _SOURCE, _TARGET, "value").withColumn("value", F.round(0.7310585786 * F.col("value"), 8))


@query(f"WITH {_RASTER}, {_CENTRES} SELECT i.row, i.col, round(value, 8) AS value FROM i JOIN p ON p.row = floor(fy) AND p.col = floor(fx)")
def resample_near(t: Tables) -> DataFrame:
    return resample.resample(raster(t), _SOURCE, _TARGET, "value", method="near").withColumn("value", F.round("value", 8))


@query("""SELECT l_returnflag AS period, v.v AS variable, l_orderkey % 48 AS y, l_partkey % 64 AS x, CAST(max(CASE v.v WHEN 'QTY' THEN l_quantity ELSE l_linenumber END) AS FLOAT) AS cleaned, bool_or(l_linestatus = 'O') AS observed
FROM lineitem, (VALUES ('QTY'), ('LINE')) v(v) WHERE l_returnflag IN ('A', 'R') AND l_orderkey % 48 BETWEEN 10 AND 29 AND l_partkey % 64 BETWEEN 5 AND 40 GROUP BY ALL""")
def cube_window(t: Tables) -> DataFrame:
    """Line items as a cube of two variables, stored in chunks and read back by a window."""
    g = t.lineitem.groupBy(F.col("l_returnflag").alias("TIME"), (F.col("l_orderkey") % 48).alias("lat"), (F.col("l_partkey") % 64).alias("lon")).agg(F.max("l_quantity").alias("qty"), F.max("l_linenumber").alias("line"), F.bool_or(F.col("l_linestatus") == "O").alias("seen"))
    long = cubes.long_form(g, ["QTY", "LINE"]).withColumnRenamed("value", "cleaned")
    seen = g.select(F.col("TIME").alias("period"), F.col("lat").alias("y"), F.col("lon").alias("x"), F.col("seen").alias("observed"))
    path = shared.fresh(t.spark, "cube")
    cubes.write(long.join(seen, ["period", "y", "x"]), path, 16)
    return cubes.read(t.spark, path, ["A", "R"], None, (10, 30), (5, 41)).drop("temporal")


@query("SELECT CAST(o_orderkey % 3 AS INTEGER) AS partition_number, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def published_parts(t: Tables) -> DataFrame:
    """Orders published in three verified parts, and merged after a check that each stands there once."""
    root, paths = shared.fresh(t.spark, "published"), {}
    for k in range(3):
        paths[k] = f"{root}/partition_{k}"
        part = t.orders.where(F.col("o_orderkey") % 3 == k).select("o_orderkey", "o_totalprice")
        publish.publish(t.spark, paths[k], ["o_orderkey"], lambda part=part: part, [part], part)
    got = publish.merged(t.spark, paths, t.orders, ["o_orderkey"])
    return got.groupBy("partition_number").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_K2 = """WITH m AS (SELECT count({c}) AS n, avg({c}) AS m FROM lineitem), g AS (SELECT any_value(n)::DOUBLE AS n, avg(({c} - m) ** 3) / avg(({c} - m) ** 2) ** 1.5 AS g1, avg(({c} - m) ** 4) / avg(({c} - m) ** 2) ** 2 AS b2 FROM lineitem, m),
s AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y, sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
(b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS x, 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS k FROM g),
a AS (SELECT *, 6 + 8 / k * (2 / k + sqrt(1 + 4 / k ** 2)) AS a FROM s), z AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1, 1 + x * sqrt(2 / (a - 4)) AS d FROM a)
SELECT '{c}' AS column_name, CAST(n AS BIGINT) AS n, round(z1, 5) AS skew_z, round((1 - 2 / (9 * a) - sign(d) * ((1 - 2 / a) / abs(d)) ** (1.0 / 3)) / sqrt(2 / (9 * a)), 5) AS kurtosis_z FROM z"""


@query(" UNION ALL ".join(f"SELECT * FROM ({_K2.format(c=c)})" for c in ("l_quantity", "l_extendedprice")))
def dagostino_scores(t: Tables) -> DataFrame:
    """The normal scores of skewness and kurtosis of whole columns."""
    out = []
    for c in ("l_quantity", "l_extendedprice"):
        n, mean = t.lineitem.agg(F.count(c), F.avg(c)).first()
        m2, m3, m4 = t.lineitem.agg(*[F.avg((F.col(c) - mean) ** k) for k in (2, 3, 4)]).first()
        out.append((c, n, round(normality.skew_z(m3 / m2**1.5, n), 5), round(normality.kurtosis_z(m4 / m2**2, n), 5)))
    return t.spark.createDataFrame(out, "column_name string, n long, skew_z double, kurtosis_z double")


@query()
def normality_tests(t: Tables) -> DataFrame:
    """All four tests; normal quantiles and tails have no SQL."""
    keyed = t.lineitem.withColumn("id", F.struct("l_orderkey", "l_linenumber").cast("string"))
    return normality.table(keyed, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "id")


@query()
def calibrated_scores(t: Tables) -> DataFrame:
    """Scores of three order states made probabilities by fitted sigmoids; Newton's steps have no SQL."""
    states = F.explode(F.array(*map(F.lit, "FOP"))).alias("class")
    s = t.orders.select(F.col("o_orderkey").alias("row"), "o_totalprice", "o_orderstatus", states)
    score = (F.col("o_totalprice") / 200_000 - F.pmod(F.xxhash64("row", "class"), F.lit(1000)) / 500) + F.when(F.col("class") == F.col("o_orderstatus"), 1.0).otherwise(0.0)
    s = s.select("row", "class", score.alias("score"), (F.col("class") == F.col("o_orderstatus")).alias("hit"))
    got = calibration.probabilities(s, calibration.sigmoids(s))
    return got.groupBy("class").agg(F.count("*").alias("n"), F.round(F.avg("p"), 4).alias("mean"))
