"""Further queries: partitioning, mosaics, tensors, diagnostics, selection proposals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import cleaning, order, stats, tiling, zonal
from .decisions import _VOTED, voted
from .matches import _POINTS, points
from .registry import Tables, query
from .samples import _SERIES, raster, series
from .shapes import _LONG, _MONTHS, _WIDE, monthly, wide


@query(f"{_POINTS}, c AS (SELECT vec_id, CAST(floor(x / 0.1) AS BIGINT) AS cell_x, CAST(floor(y / 0.1) AS BIGINT) AS cell_y, x, y FROM p) SELECT vec_id, cell_x, cell_y, CAST(floor((row_number() OVER (PARTITION BY cell_y, cell_x ORDER BY y, x, vec_id) - 1) / 20) AS BIGINT) AS batch FROM c")
def spatial_batches(t: Tables) -> DataFrame:
    return tiling.batches(points(t), "vec_id", "x", "y", 0.1, 20).select("vec_id", "cell_x", "cell_y", "batch")


@query(f"{_POINTS} SELECT vec_id, CAST(least(greatest(floor((x + 1) / 0.5), 0), 3) AS BIGINT) + 4 * CAST(least(greatest(floor((y + 1) / 0.6666666666666666), 0), 2) AS BIGINT) AS part FROM p")
def grid_partitions(t: Tables) -> DataFrame:
    from ..operators import joins

    rows, cols = tiling.grid_shape(12, 4.0, 3.0)
    col = joins.grid_cell(F.col("x"), F.lit(-1.0), F.lit(2.0 / cols), cols)
    row = joins.grid_cell(F.col("y"), F.lit(-1.0), F.lit(2.0 / rows), rows)
    return points(t).select("vec_id", (col + cols * row).alias("part"))


@query()
def tile_bisection(t: Tables) -> DataFrame:
    return tiling.tiles(points(t), "vec_id", "x", "y", 60).groupBy("tile").agg(F.count("*").alias("n"))


@query("SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, starts_with(url, 'https') AS secure FROM pages")
def url_parts(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), F.parse_url("url", F.lit("QUERY"), F.lit("page")).alias("page"), F.startswith("url", F.lit("https")).alias("secure"))


@query("WITH v AS (SELECT o_orderpriority AS k, median(o_totalprice) AS m FROM orders GROUP BY 1) SELECT k, round((count(*) FILTER (o_totalprice < m) + count(*) FILTER (o_totalprice <= m)) / 2.0 / count(*) * 100, 6) AS pct FROM orders, v GROUP BY k")
def percentile_of_median(t: Tables) -> DataFrame:
    m = t.orders.groupBy(F.col("o_orderpriority").alias("k")).agg(F.median("o_totalprice").alias("m"))
    j = t.orders.select("o_totalprice").crossJoin(F.broadcast(m))  # a row for each class
    return j.groupBy("k").agg(F.round((F.count_if(F.col("o_totalprice") < F.col("m")) + F.count_if(F.col("o_totalprice") <= F.col("m"))) / 2 / F.count("*") * 100, 6).alias("pct"))


@query("WITH v AS (SELECT vec_id, label AS tile, vec_id % 40 AS y, (vec_id * 7) % 30 AS x, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings) SELECT y, x, arg_min(z, (tile, vec_id)) AS z FROM v GROUP BY y, x")
def mosaic_first(t: Tables) -> DataFrame:
    v = t.embeddings.select("vec_id", F.col("label").alias("tile"), (F.col("vec_id") % 40).alias("y"), (F.col("vec_id") * 7 % 30).alias("x"), F.col("embedding")[2].cast("double").alias("z"))
    return v.groupBy("y", "x").agg(F.min_by("z", F.struct("tile", "vec_id")).alias("z"))


@query("""WITH v AS (SELECT vec_id, label AS layer, vec_id % 25 AS y, (vec_id // 25) % 20 AS x, CAST(embedding[1] AS DOUBLE) AS e FROM embeddings), g AS (SELECT layer, y, x, avg(e) AS value FROM v GROUP BY ALL)
SELECT coalesce(a.y, b.y) AS y, coalesce(a.x, b.x) AS x, round(a.value, 8) AS optical, round(b.value, 8) AS radar FROM (SELECT * FROM g WHERE layer = 1) a FULL JOIN (SELECT * FROM g WHERE layer = 2) b ON a.y = b.y AND a.x = b.x""")
def sensor_merge(t: Tables) -> DataFrame:
    g = raster(t)
    a, b = g.where("layer = 1").select("y", "x", F.round("value", 8).alias("optical")), g.where("layer = 2").select("y", "x", F.round("value", 8).alias("radar"))
    return a.join(b, ["y", "x"], "full_outer")


@query(_WIDE + ", m AS (SELECT median(v) AS m FROM (UNPIVOT (SELECT " + ", ".join(f'"q__{m}"' for m in _MONTHS) + " FROM w) ON COLUMNS(*) INTO NAME f VALUE v)) SELECT id, round(list_sum(list_transform([" + ", ".join(f'"q__{m}"' for m in _MONTHS) + "], lambda x, i: i * coalesce(x, m))), 4) AS checksum, CAST(12 AS BIGINT) AS steps FROM w, m")
def series_tensor(t: Tables) -> DataFrame:
    """Dated columns as one array a row, missing steps by the feature's median; a weighted sum stands for the array."""
    w = wide(t)
    cols = [f"q__{m}" for m in _MONTHS]
    m = w.unpivot(["id"], cols, "f", "v").agg(F.median("v").alias("m"))
    a = w.crossJoin(F.broadcast(m)).select("id", F.array(*[F.coalesce(F.col(c), F.col("m")) for c in cols]).alias("a"))  # one row
    return a.select("id", F.round(F.aggregate(F.transform("a", lambda x, i: (i + 1) * x), F.lit(0.0), lambda s, x: s + x), 4).alias("checksum"), F.size("a").cast("long").alias("steps"))


@query(_VOTED + ", d AS (SELECT y.*, CASE WHEN row % 3 = 0 THEN 'LOW' ELSE 'HIGH' END AS level FROM y) SELECT CASE WHEN truth = predicted THEN 'correct' ELSE 'wrong' END || '_' || lower(level) AS grp, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM d GROUP BY 1")
def confidence_diagnostics(t: Tables) -> DataFrame:
    d = voted(t).withColumn("level", F.when(F.col("row") % 3 == 0, "LOW").otherwise("HIGH"))
    g = d.groupBy(F.concat(F.when(F.col("truth") == F.col("predicted"), "correct").otherwise("wrong"), F.lit("_"), F.lower("level")).alias("grp")).agg(F.count("*").alias("n"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("_t")))).select("grp", "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"))  # one row


_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query()
def feature_selection_proposal(t: Tables) -> DataFrame:
    """Features by strength of association with the target; one that goes with a chosen stronger one (|r| >= 0.8) is redundant."""
    target = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    l = t.lineitem.select(*_FEATURES, target.alias("_t"))
    r = {(x["x"], x["y"]): abs(x["r"] or 0.0) for x in stats.pearson(l, [*_FEATURES, "_t"]).collect()}  # a row for each pair of columns
    chosen, out = [], []
    for i, f in enumerate(sorted(_FEATURES, key=lambda c: (-r[c, "_t"], c))):
        twin = next((c for c in chosen if r.get((c, f), r.get((f, c), 0.0)) >= 0.8), None)
        out.append((i + 1, f, round(r[f, "_t"], 6), "redundant" if twin else "selected"))
        chosen += [] if twin else [f]
    return t.spark.createDataFrame(out, "rank int, feature string, effect double, decision string")


@query("""WITH s AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3, median(l_extendedprice) AS m FROM lineitem)
SELECT count(*) AS n, count(*) FILTER (l_extendedprice < q1 - 0.5 * (q3 - q1) OR l_extendedprice > q3 + 0.5 * (q3 - q1)) AS nulled, round(avg(CASE WHEN l_extendedprice < q1 - 0.5 * (q3 - q1) OR l_extendedprice > q3 + 0.5 * (q3 - q1) THEN m ELSE l_extendedprice END), 4) AS mean_after FROM lineitem, s""")
def model_feature_cleaning(t: Tables) -> DataFrame:
    b = cleaning.fences(t.lineitem, [], "l_extendedprice", 0.5)
    m = zonal.quantiles(t.lineitem, [], "l_extendedprice", [0.5]).select(F.col("q")[0].alias("m"))
    d = t.lineitem.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(m))  # one row each
    out = (F.col("l_extendedprice") < F.col("lower")) | (F.col("l_extendedprice") > F.col("upper"))
    return d.agg(F.count("*").alias("n"), F.count_if(out).alias("nulled"), F.round(F.avg(F.when(out, F.col("m")).otherwise(F.col("l_extendedprice"))), 4).alias("mean_after"))


@query(f"{_POINTS} SELECT label, count(*) AS n, round(min(x), 6) AS minx, round(min(y), 6) AS miny, round(max(x), 6) AS maxx, round(max(y), 6) AS maxy FROM p GROUP BY label")
def geospatial_summary(t: Tables) -> DataFrame:
    return points(t).groupBy("label").agg(F.count("*").alias("n"), *[F.round(f(c), 6).alias(f"{k}{c}") for c in ("x", "y") for k, f in (("min", F.min), ("max", F.max))])


@query("SELECT conv_id, CAST(max(turn) AS BIGINT) AS last_turn, arg_min(role, turn) AS first_role, string_agg(role, '|' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def ordered_lists(t: Tables) -> DataFrame:
    g = t.conversations.groupBy("conv_id").agg(F.max("turn").alias("last_turn"), F.min_by("role", "turn").alias("first_role"), F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("a"))
    return g.select("conv_id", "last_turn", "first_role", F.array_join(F.transform("a", lambda x: x["role"]), "|").alias("roles"))


@query("SELECT o_orderkey, sha256(to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus})) AS sig FROM orders")
def row_signatures(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", scalar.signature(F.col("o_orderkey"), F.col("o_orderstatus")).alias("sig"))


@query(_SERIES + ", w AS (SELECT event_type, step, avg(value) AS v FROM series GROUP BY ALL), c AS (SELECT event_type, step, v, sum(v) OVER (PARTITION BY event_type ORDER BY step) AS run FROM w) SELECT event_type, step, round(v / sum(v) OVER (PARTITION BY event_type), 8) AS share, round(run / sum(v) OVER (PARTITION BY event_type), 8) AS running FROM c")
def cumulative_share(t: Tables) -> DataFrame:
    w = series(t).groupBy("event_type", "step").agg(F.avg("value").alias("v"))
    by = Window.partitionBy("event_type")
    return w.select("event_type", "step", F.round(F.col("v") / F.sum("v").over(by), 8).alias("share"), F.round(F.sum("v").over(by.orderBy("step")) / F.sum("v").over(by), 8).alias("running"))


@query(f"WITH l AS ({_LONG}) SELECT id, count(*) AS months, count(*) = 12 AS complete FROM l GROUP BY id")
def period_completeness(t: Tables) -> DataFrame:
    return monthly(t).groupBy("id").agg(F.count("*").alias("months"), (F.count("*") == 12).alias("complete"))


@query("WITH c AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY (o_orderkey * 48271) % 65537, o_orderkey) AS rn FROM orders) SELECT o_orderkey FROM c WHERE rn <= 50")
def capped_sample(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_orderstatus").orderBy(F.col("o_orderkey") * 48271 % 65537, "o_orderkey")
    return t.orders.withColumn("rn", F.row_number().over(w)).where("rn <= 50").select("o_orderkey")


@query()
def hash_sample(t: Tables) -> DataFrame:
    return order.hash_sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 500, 7)
