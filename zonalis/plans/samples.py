"""Zonal statistics and cleaning over the driver's tables: line items as samples, events as acquisitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, filling, zonal
from .registry import Tables, query

_ZONE = "l_returnflag || '/' || l_linestatus"
_PIXELS = f"SELECT {_ZONE} AS zone, strftime(l_shipdate, '%Y-%m') AS period, l_extendedprice AS value FROM lineitem"


def pixels(t: Tables) -> DataFrame:
    """Line items as samples: zone, period (month), value."""
    return t.lineitem.select(F.concat_ws("/", "l_returnflag", "l_linestatus").alias("zone"), F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.col("l_extendedprice").alias("value"))


def series(t: Tables) -> DataFrame:
    """Events as a daily series of each event type and user group: key, day, value; days without an event are missing."""
    daily = t.events.groupBy("event_type", (F.col("user_id") % 50).alias("grp"), F.to_date("ts").alias("day")).agg(F.round(F.avg("value"), 4).alias("value"))
    span = t.events.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    keys = daily.select("event_type", "grp").distinct()
    # the calendar is one row a day, the keys are a product of fixed domains
    grid = keys.crossJoin(F.broadcast(days)).withColumn("step", F.dayofyear("day"))
    gappy = daily.where((F.col("grp") * 7 + F.dayofyear("day") * 3) % 5 != 0)
    return grid.join(gappy, ["event_type", "grp", "day"], "left").select("event_type", "grp", "step", "value")


_SERIES = """
WITH daily AS (SELECT event_type, user_id % 50 AS grp, CAST(ts AS DATE) AS day, round(avg(value), 4) AS value FROM events GROUP BY ALL),
span AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
keys AS (SELECT DISTINCT event_type, grp FROM daily),
series AS (
  SELECT k.event_type, k.grp, CAST(dayofyear(d.day) AS INT) AS step, v.value
  FROM keys k CROSS JOIN days d
  LEFT JOIN (SELECT * FROM daily WHERE (grp * 7 + dayofyear(day) * 3) % 5 <> 0) v ON v.event_type = k.event_type AND v.grp = k.grp AND v.day = d.day)
"""


@query(f"""
WITH p AS ({_PIXELS})
SELECT zone, period, round(avg(value), 6) AS mean, round(median(value), 4) AS median, round(stddev_samp(value), 6) AS sd, min(value) AS min, max(value) AS max, count(*) AS count,
 round(quantile_cont(value, 0.1), 4) AS p10, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.75), 4) AS p75, round(quantile_cont(value, 0.9), 4) AS p90
FROM p GROUP BY zone, period""")
def zonal_pooled_stats(t: Tables) -> DataFrame:
    out = zonal.pooled(pixels(t), ["zone", "period"], "value", ["average", "median", "stdev", "min", "max", "count", "p10", "p25", "p75", "p90"])
    return out.select("zone", "period", F.round("mean", 6).alias("mean"), F.round("median", 4).alias("median"), F.round("sd", 6).alias("sd"), "min", "max", "count", *[F.round(c, 4).alias(c) for c in ("p10", "p25", "p75", "p90")])


@query(f"""
WITH p AS ({_PIXELS})
SELECT zone, round(quantile_cont(value, 0.1), 4) AS p10, round(median(value), 4) AS p50, round(quantile_cont(value, 0.9), 4) AS p90 FROM p GROUP BY zone""")
def zonal_bracketed_quantiles(t: Tables) -> DataFrame:
    got = zonal.bracketed_quantiles(pixels(t), ["zone"], "value", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return got.select("zone", *[F.round(c, 4).alias(c) for c in ("p10", "p50", "p90")])


@query(f"""
WITH p AS ({_PIXELS}), s AS (SELECT zone, period, avg(value) AS mean, median(value) AS median, stddev_samp(value) AS sd, min(value) AS min, max(value) AS max,
 quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.9) AS p90 FROM p GROUP BY zone, period)
SELECT zone, period, round(max - min, 4) AS range, round(sd * sd / 1e6, 4) AS variance_m, round(CASE WHEN abs(mean) > 1e-12 THEN sd / mean END, 6) AS cv, round(p75 - p25, 4) AS iqr,
 round(CASE WHEN abs(p75 - p25) > 1e-12 THEN (p75 + p25 - 2 * median) / (p75 - p25) END, 6) AS bowley_skew, round(p90 - p10, 4) AS p90_p10 FROM s""")
def derived_stats(t: Tables) -> DataFrame:
    out = zonal.with_derived(zonal.pooled(pixels(t), ["zone", "period"], "value", ["mean", "median", "sd", "min", "max", "p10", "p25", "p75", "p90"]))
    return out.select("zone", "period", F.round("range", 4).alias("range"), F.round(F.col("variance") / 1e6, 4).alias("variance_m"), F.round("cv", 6).alias("cv"), F.round("iqr", 4).alias("iqr"), F.round("bowley_skew", 6).alias("bowley_skew"), F.round("p90_p10", 4).alias("p90_p10"))


_FENCED = f"""
WITH p AS ({_PIXELS}), q AS (SELECT zone, period, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, count(value) AS n FROM p GROUP BY zone, period),
b AS (SELECT zone, period, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, n >= 20 AS applied FROM q),
c AS (SELECT p.*, CASE WHEN NOT (applied AND (value < lower OR value > upper)) THEN value END AS cleaned, applied FROM p JOIN b USING (zone, period))
"""


@query(_FENCED + "SELECT zone, period, count(*) AS n, count(cleaned) AS n_kept, round(avg(cleaned), 6) AS mean, round(stddev_samp(cleaned), 6) AS sd, round(median(cleaned), 4) AS median, round(quantile_cont(cleaned, 0.9), 4) AS p90 FROM c GROUP BY zone, period")
def iqr_fence_clean(t: Tables) -> DataFrame:
    c = cleaning.fence_clean(pixels(t), ["zone", "period"], "value")
    return c.groupBy("zone", "period").agg(F.count("*").alias("n"), F.count("cleaned").alias("n_kept"), F.round(F.avg("cleaned"), 6).alias("mean"), F.round(F.stddev_samp("cleaned"), 6).alias("sd"), F.round(F.median("cleaned"), 4).alias("median"), F.round(F.percentile("cleaned", F.lit(0.9)), 4).alias("p90"))


@query(f"""
WITH p AS ({_PIXELS}), s AS (SELECT zone, avg(value) AS m, stddev_samp(value) AS d FROM p GROUP BY zone)
SELECT p.zone, count(*) AS n, count(*) FILTER (abs((value - m) / d) > 2) AS n_outliers, round(max(abs((value - m) / d)), 6) AS max_z FROM p JOIN s USING (zone) GROUP BY p.zone""")
def zscore_mask(t: Tables) -> DataFrame:
    z = cleaning.zscore(pixels(t), ["zone"], "value", 2.0)
    return z.groupBy("zone").agg(F.count("*").alias("n"), F.count_if("is_outlier").alias("n_outliers"), F.round(F.max(F.abs("z")), 6).alias("max_z"))


@query("""
WITH l AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON COLUMNS(*) INTO NAME column_name VALUE value),
s AS (SELECT column_name, count(value) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, avg(value) AS m, stddev_samp(value) AS d FROM l GROUP BY column_name)
SELECT l.column_name, any_value(n) AS n, round(any_value(q1 - 1.5 * (q3 - q1)), 4) AS lower, round(any_value(q3 + 1.5 * (q3 - q1)), 4) AS upper,
 count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS iqr_outliers, count(*) FILTER (abs((value - m) / d) > 3) AS z_outliers
FROM l JOIN s USING (column_name) GROUP BY l.column_name""")
def outlier_univariate_summary(t: Tables) -> DataFrame:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    long = t.lineitem.unpivot([], cols, "column_name", "value")
    b = cleaning.fences(long, ["column_name"], "value")
    z = cleaning.zscore(long.join(F.broadcast(b), "column_name"), ["column_name"], "value", few=True)  # a row for each column
    out = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return z.groupBy("column_name").agg(F.max("n").alias("n"), F.round(F.max("lower"), 4).alias("lower"), F.round(F.max("upper"), 4).alias("upper"), F.count_if(out).alias("iqr_outliers"), F.count_if("is_outlier").alias("z_outliers"))


@query(_SERIES + "SELECT event_type, grp, step, round(coalesce(value, last_value(value IGNORE NULLS) OVER (PARTITION BY event_type, grp ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 6) AS filled FROM series")
def temporal_fill_past(t: Tables) -> DataFrame:
    return cleaning.fill_past(series(t), ["event_type", "grp"], "step", "value").select("event_type", "grp", "step", F.round("filled", 6).alias("filled"))


_BOTH = """, f AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY event_type, grp ORDER BY step ROWS BETWEEN {lo} PRECEDING AND 1 PRECEDING) AS p,
 first_value(value IGNORE NULLS) OVER (PARTITION BY event_type, grp ORDER BY step ROWS BETWEEN 1 FOLLOWING AND {hi} FOLLOWING) AS q{more} FROM series)
"""


@query(_SERIES + _BOTH.format(lo="UNBOUNDED", hi="UNBOUNDED", more="") + "SELECT event_type, grp, step, round(coalesce(value, (p + q) / 2, p, q), 6) AS filled FROM f")
def temporal_fill_bidir(t: Tables) -> DataFrame:
    return cleaning.fill_both(series(t), ["event_type", "grp"], "step", "value").select("event_type", "grp", "step", F.round("filled", 6).alias("filled"))


@query(
    _SERIES
    + _BOTH.format(lo=1, hi=1, more=", last_value(value IGNORE NULLS) OVER (PARTITION BY event_type, grp ORDER BY step ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS p2, first_value(value IGNORE NULLS) OVER (PARTITION BY event_type, grp ORDER BY step ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS q2")
    + "SELECT event_type, grp, step, round(coalesce(value, (p + q) / 2, p, q, (p2 + q2) / 2, p2, q2), 6) AS filled FROM f"
)
def temporal_fill_bounded_retry(t: Tables) -> DataFrame:
    return cleaning.fill_bounded(series(t), ["event_type", "grp"], "step", "value", (3, 5)).select("event_type", "grp", "step", F.round("filled", 6).alias("filled"))


@query(_SERIES + "SELECT step, event_type, round(count(value) / count(*), 6) AS coverage, count(value) / count(*) >= 0.75 AS fill_allowed, CASE WHEN count(value) / count(*) >= 0.75 THEN count(value) ELSE 0 END AS donors FROM series GROUP BY step, event_type")
def coverage_guard(t: Tables) -> DataFrame:
    g = cleaning.coverage_guard(series(t), ["event_type", "step"], "value", 0.75)
    return g.groupBy("step", "event_type").agg(F.round(F.max("coverage"), 6).alias("coverage"), F.max("fill_allowed").alias("fill_allowed"), F.count("donor").alias("donors"))


@query(_SERIES + """, a AS (SELECT event_type, step, dense_rank() OVER (PARTITION BY event_type ORDER BY step) AS active FROM (SELECT event_type, step, count(value) AS n FROM series WHERE step % 4 <> 0 GROUP BY ALL) WHERE n > 0)
SELECT s.event_type, s.grp, s.step, CAST(a.active AS INT) AS active FROM series s JOIN a USING (event_type, step)""")
def active_steps(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    s = series(t)
    live = s.where("step % 4 <> 0").groupBy("event_type", "step").agg(F.count("value").alias("n")).where("n > 0")
    live = live.withColumn("active", F.dense_rank().over(Window.partitionBy("event_type").orderBy("step"))).drop("n")
    return s.join(live, ["event_type", "step"]).select("event_type", "grp", "step", "active")


@query(_SERIES + _BOTH.format(lo=1, hi=1, more="") + """, g AS (SELECT *, coalesce((p + q) / 2, p, q) AS tf, coalesce(value, (p + q) / 2, p, q) AS fin FROM f)
SELECT event_type, grp, count(*) AS expected, count(value) AS observed, count(*) FILTER (value IS NULL AND tf IS NOT NULL) AS temporal, round(count(value) / count(*), 6) AS observed_ratio, round(count(*) FILTER (value IS NULL AND tf IS NOT NULL) / count(*), 6) AS temporal_ratio FROM g GROUP BY event_type, grp""")
def fill_provenance(t: Tables) -> DataFrame:
    f = cleaning.fill_bounded(series(t), ["event_type", "grp"], "step", "value", (3,))
    f = f.withColumn("observed", F.col("value").isNotNull()).withColumn("temporal", F.col("value").isNull() & F.col("filled").isNotNull())
    out = zonal.provenance(f, ["event_type", "grp"], "observed", "temporal", "filled")
    return out.select("event_type", "grp", "expected", "observed", "temporal", F.round("observed_ratio", 6).alias("observed_ratio"), F.round("temporal_ratio", 6).alias("temporal_ratio"))


@query(_SERIES + _BOTH.format(lo=1, hi=1, more="") + """SELECT event_type, step, count(*) AS cells, count(*) FILTER (value IS NULL) AS null_value, count(*) FILTER (coalesce(value, p, q) IS NULL) AS null_near, count(*) FILTER (value IS NULL) - count(*) FILTER (coalesce(value, p, q) IS NULL) AS by_near FROM f GROUP BY event_type, step""")
def cleaning_report(t: Tables) -> DataFrame:
    f = cleaning.fill_bounded(series(t), ["event_type", "grp"], "step", "value", (3,), out="near")
    return cleaning.stage_report(f, ["event_type", "step"], ["value", "near"])


_GRID = """
WITH v AS (SELECT vec_id, vec_id % 25 AS y, (vec_id // 25) % 20 AS x, label AS layer, embedding[1] AS e FROM embeddings),
g AS (SELECT layer, y, x, avg(CAST(e AS DOUBLE)) AS value FROM v GROUP BY ALL)
"""


def raster(t: Tables) -> DataFrame:
    """Vectors as a sparse raster: layer, y, x, value."""
    v = t.embeddings.select(F.col("label").alias("layer"), (F.col("vec_id") % 25).alias("y"), (F.floor(F.col("vec_id") / 25) % 20).alias("x"), F.col("embedding")[0].cast("double").alias("e"))
    return v.groupBy("layer", "y", "x").agg(F.avg("e").alias("value"))


def _cells(t: Tables) -> DataFrame:
    """Every cell of every layer."""
    g = raster(t)
    grid = t.spark.range(25).select(F.col("id").alias("y"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))).alias("x"))
    return g.select("layer").distinct().crossJoin(F.broadcast(grid)).join(g, ["layer", "y", "x"], "left")  # 500 cells


_ALL = _GRID + ", c AS (SELECT l.layer, CAST(y.y AS BIGINT) AS y, CAST(x.x AS BIGINT) AS x, g.value FROM (SELECT DISTINCT layer FROM g) l CROSS JOIN range(25) y(y) CROSS JOIN range(20) x(x) LEFT JOIN g ON g.layer = l.layer AND g.y = y.y AND g.x = x.x)"
_MEAN = "SELECT a.layer, a.y, a.x, {keep}coalesce(any_value(a.{v}), avg(b.{v})) AS {o} FROM {s} a LEFT JOIN {s} b ON a.layer = b.layer AND abs(a.y - b.y) <= {r} AND abs(a.x - b.x) <= {r} GROUP BY a.layer, a.y, a.x"


@query(_ALL + " SELECT layer, y, x, round(f, 4) AS filled FROM (" + _MEAN.format(keep="", v="value", o="f", s="c", r=1) + ")")
def spatial_mean_fill_3x3(t: Tables) -> DataFrame:
    return cleaning.spatial_mean(_cells(t), ["layer"], "y", "x", "value", 3).select("layer", "y", "x", F.round("filled", 4).alias("filled"))


@query(_ALL + ", d AS (" + _MEAN.format(keep="", v="value", o="f", s="c", r=1) + ") SELECT layer, y, x, round(f5, 6) AS filled FROM (" + _MEAN.format(keep="", v="f", o="f5", s="d", r=2) + ")")
def spatial_mean_fill_5x5_staged(t: Tables) -> DataFrame:
    a = cleaning.spatial_mean(_cells(t), ["layer"], "y", "x", "value", 3, "f3")
    return cleaning.spatial_mean(a, ["layer"], "y", "x", "f3", 5).select("layer", "y", "x", F.round("filled", 6).alias("filled"))


@query(
    _ALL
    + """, t AS (SELECT layer, y, x, value, coalesce(value, (lag(value) OVER w + lead(value) OVER w) / 2, lag(value) OVER w, lead(value) OVER w) AS tf FROM c WINDOW w AS (PARTITION BY y, x ORDER BY layer)),
 d AS ("""
    + _MEAN.format(keep="any_value(a.value) AS value, any_value(a.tf) AS tf, ", v="tf", o="f", s="t", r=1)
    + """), n AS (SELECT a.layer, a.y, a.x, arg_min(b.f, ((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x), b.y, b.x)) AS near FROM d a JOIN d b ON a.layer = b.layer AND b.f IS NOT NULL WHERE a.f IS NULL GROUP BY ALL)
SELECT layer, y, x, round(coalesce(f, near), 6) AS filled, CASE WHEN value IS NOT NULL THEN 'observed' WHEN tf IS NOT NULL THEN 'temporal' WHEN f IS NOT NULL THEN 'spatial_3' WHEN near IS NOT NULL THEN 'interpolated' END AS source FROM d LEFT JOIN n USING (layer, y, x)"""
)
def fill_chain(t: Tables) -> DataFrame:
    """Gaps from the layers before and after, then from windows of three, then from the nearest cell, with the source of each value."""
    d = filling.chain(_cells(t), [], "layer", "y", "x", "value", (3,), windows=(3,), method="nearest")
    return d.select("layer", "y", "x", F.round("filled", 6).alias("filled"), "source")


@query(_ALL + ", d AS (" + _MEAN.format(keep="", v="value", o="f", s="c", r=1) + "), d5 AS (" + _MEAN.format(keep="", v="f", o="f5", s="d", r=2) + "), d7 AS (" + _MEAN.format(keep="", v="f5", o="f7", s="d5", r=3) + ") SELECT layer, y, x, round(f9, 6) AS filled FROM (" + _MEAN.format(keep="", v="f7", o="f9", s="d7", r=4) + ")")
def spatial_mean_fill_all_stages(t: Tables) -> DataFrame:
    """Windows of 3, 5, 7 and 9, each over what the one before filled."""
    d, v = _cells(t), "value"
    for size in (3, 5, 7, 9):
        d, v = cleaning.spatial_mean(d, ["layer"], "y", "x", v, size, f"f{size}"), f"f{size}"
    return d.select("layer", "y", "x", F.round(v, 6).alias("filled"))


@query(_ALL + """, g2 AS (SELECT layer, y, x, CASE WHEN (y * 7 + x * 5) % 6 = 0 THEN value END AS value FROM c), h AS (SELECT a.layer, a.y, a.x, b.y AS oy, b.x AS ox, b.value AS v, sqrt((a.y - b.y) * (a.y - b.y) * 4 + (a.x - b.x) * (a.x - b.x)) AS h FROM g2 a JOIN g2 b ON a.layer = b.layer AND b.value IS NOT NULL WHERE a.value IS NULL),
n AS (SELECT layer, y, x, arg_min(v, (h, oy, ox)) AS near FROM h WHERE h <= 6 GROUP BY layer, y, x)
SELECT g2.layer, g2.y, g2.x, round(coalesce(value, near), 6) AS filled FROM g2 LEFT JOIN n USING (layer, y, x)""")
def nearest_fill_anisotropic(t: Tables) -> DataFrame:
    """Gaps from the nearest observed cell within 6, a step in y being twice one in x."""
    d = _cells(t).withColumn("value", F.when((F.col("y") * 7 + F.col("x") * 5) % 6 == 0, F.col("value")))
    return cleaning.nearest_fill(d, ["layer"], "y", "x", "value", (2.0, 1.0), 6.0).select("layer", "y", "x", F.round("filled", 6).alias("filled"))


@query(_ALL + " SELECT a.layer, a.y, a.x, max(CASE WHEN b.value > 0.2 THEN 1 ELSE 0 END) AS masked FROM c a JOIN c b ON a.layer = b.layer AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY a.layer, a.y, a.x")
def mask_dilation(t: Tables) -> DataFrame:
    c = _cells(t).withColumn("flag", F.when(F.col("value") > 0.2, 1).otherwise(0))
    return cleaning.dilate(c, ["layer"], "y", "x", "flag", 3, "masked").select("layer", "y", "x", "masked")
