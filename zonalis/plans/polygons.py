"""Queries over polygons: geometries from the vectors' components, a raster from the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import polygons
from .registry import Tables, query

#: Directions of a polygon's eight corners.
_COS, _SIN = (1.0, 0.7, 0.0, -0.7, -1.0, -0.7, 0.0, 0.7), (0.0, 0.7, 1.0, 0.7, 0.0, -0.7, -1.0, -0.7)
_GRID = polygons.Grid(0.0, 48.0, 1.0, 1.0, 64, 48)


def shapes(t: Tables, crossed: bool = True) -> DataFrame:
    """vec_id, label, parts: stars of eight corners; every third has a hole, every fifth a second part, every eleventh crosses itself."""
    e = t.embeddings.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    e = e.select("vec_id", "label", "v", (32 + 60 * F.get("v", F.lit(0))).alias("cx"), (24 + 45 * F.get("v", F.lit(1))).alias("cy"))
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    corner = lambda k, r: at(F.col("cx") + r * _COS[k], F.col("cy") + r * _SIN[k])
    star = lambda ks: F.array(*[corner(k, 2 + 8 * F.abs(F.get("v", F.lit(k + 2)))) for k in (*ks, ks[0])])
    shell = F.when(F.lit(crossed) & (F.col("vec_id") % 11 == 0), star((0, 1, 5, 3, 4, 2, 6, 7))).otherwise(star(range(8)))
    hole = F.array(*[corner(k, F.lit(0.6)) for k in (0, 2, 4, 6, 0)])
    moved = lambda dx, dy: at(F.col("cx") + dx, F.col("cy") + dy)
    second = F.array(F.array(moved(20.0, 0.0), moved(23.0, 1.0), moved(21.0, 4.0), moved(20.0, 0.0)))
    first = F.when(F.col("vec_id") % 3 == 0, F.array(shell, hole)).otherwise(F.array(shell))
    return e.select("vec_id", "label", F.when(F.col("vec_id") % 5 == 0, F.array(first, second)).otherwise(F.array(first)).alias("parts"))


def _shapes(crossed: bool = True) -> str:
    """CTEs: e (vectors), c (corners: vec_id, part, ring, k, x, y), s (segments)."""
    order = "CASE WHEN e.vec_id % 11 = 0 THEN [0, 1, 5, 3, 4, 2, 6, 7, 0][k + 1] ELSE k % 8 END" if crossed else "k % 8"
    return f"""e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, 32 + 60 * CAST(embedding[1] AS DOUBLE) AS cx, 24 + 45 * CAST(embedding[2] AS DOUBLE) AS cy FROM embeddings),
a AS (SELECT vec_id, k, cx, cy, v, {order} AS d FROM e, range(9) r(k)),
c AS (SELECT vec_id, 0 AS part, 0 AS ring, k, cx + (2 + 8 * abs(v[d + 3])) * {list(_COS)}[d + 1] AS x, cy + (2 + 8 * abs(v[d + 3])) * {list(_SIN)}[d + 1] AS y FROM a
UNION ALL SELECT vec_id, 0, 1, k, cx + 0.6::DOUBLE * [1.0::DOUBLE, 0, -1, 0, 1][k + 1], cy + 0.6::DOUBLE * [0.0::DOUBLE, 1, 0, -1, 0][k + 1] FROM e, range(5) r(k) WHERE vec_id % 3 = 0
UNION ALL SELECT vec_id, 1, 0, k, cx + [20.0::DOUBLE, 23, 21, 20][k + 1], cy + [0.0::DOUBLE, 1, 4, 0][k + 1] FROM e, range(4) r(k) WHERE vec_id % 5 = 0),
s AS (SELECT * FROM (SELECT vec_id, part, ring, k, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM c WINDOW w AS (PARTITION BY vec_id, part, ring ORDER BY k)) WHERE x2 IS NOT NULL)"""


def raster(t: Tables) -> DataFrame:
    """row, col, value of the cells with line items."""
    return t.lineitem.groupBy((F.col("l_orderkey") % 48).alias("row"), (F.col("l_partkey") % 64).alias("col")).agg(F.avg("l_quantity").alias("value"))


_RASTER = "p AS (SELECT l_orderkey % 48 AS row, l_partkey % 64 AS col, avg(l_quantity) AS value FROM lineitem GROUP BY ALL)"
#: All cells whose centre an odd number of a part's borders lies right of.
_CENTRES = """g AS (SELECT r.r AS row, c.c AS col FROM range(48) r(r), range(64) c(c)), b AS (SELECT vec_id, part, min(least(x1, x2)) AS xa, max(greatest(x1, x2)) AS xb, min(least(48 - y1, 48 - y2)) AS ya, max(greatest(48 - y1, 48 - y2)) AS yb FROM s GROUP BY ALL),
m AS (SELECT vec_id, row, col FROM (SELECT b.vec_id, b.part, row, col FROM b JOIN g ON col + 0.5 BETWEEN xa AND xb AND row + 0.5 BETWEEN ya AND yb) q
JOIN s USING (vec_id, part) WHERE (48 - y1 <= row + 0.5) <> (48 - y2 <= row + 0.5) AND x1 + (row + 0.5 - (48 - y1)) * (x2 - x1) / ((48 - y2) - (48 - y1)) <= col + 0.5 GROUP BY vec_id, q.part, row, col HAVING count(*) % 2 = 1)"""


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 8) for n in names})


@query(f"""WITH {_shapes()}, {_RASTER}, {_CENTRES}, d AS (SELECT DISTINCT vec_id, row, col FROM m)
SELECT e.vec_id, count(d.row) AS pixels, count(p.value) AS count, round(avg(p.value), 8) AS mean, round(min(p.value), 8) AS min, round(median(p.value), 8) AS median FROM e LEFT JOIN d USING (vec_id) LEFT JOIN p USING (row, col) GROUP BY e.vec_id""")
def polygon_zonal_centres(t: Tables) -> DataFrame:
    """Statistics of the observed pixels whose centre is inside; holes, several parts, crossing shells, and geometries outside the raster."""
    return _rounded(polygons.zonal_statistics(shapes(t), ["vec_id"], _GRID, raster(t), "value", ["mean", "min", "median"]), "mean", "min", "median")


@query(f"""WITH {_shapes()}, {_RASTER}, {_CENTRES},
t AS (SELECT vec_id, row, x1, x2, y1, y2 FROM (SELECT vec_id, x1, x2, 48 - y1 AS y1, 48 - y2 AS y2 FROM s), range(48) r(row) WHERE row BETWEEN floor(least(y1, y2)) AND floor(greatest(y1, y2))),
u AS (SELECT vec_id, row, CASE WHEN y1 = y2 THEN x1 ELSE x1 + (greatest(least(y1, y2), row) - y1) * (x2 - x1) / (y2 - y1) END AS xa, CASE WHEN y1 = y2 THEN x2 ELSE x1 + (least(greatest(y1, y2), row + 1) - y1) * (x2 - x1) / (y2 - y1) END AS xb FROM t),
d AS (SELECT vec_id, row, col FROM m UNION SELECT vec_id, row, c.c FROM u, range(64) c(c) WHERE c.c BETWEEN floor(least(xa, xb)) AND floor(greatest(xa, xb)))
SELECT e.vec_id, count(d.row) AS pixels, count(p.value) AS count, round(avg(p.value), 8) AS mean, round(max(p.value), 8) AS max FROM e LEFT JOIN d USING (vec_id) LEFT JOIN p USING (row, col) GROUP BY e.vec_id""")
def polygon_zonal_touched(t: Tables) -> DataFrame:
    """The same over all pixels that a geometry touches."""
    return _rounded(polygons.zonal_statistics(shapes(t), ["vec_id"], _GRID, raster(t), "value", ["mean", "max"], touched=True), "mean", "max")


_AREAS = "ar AS (SELECT vec_id, part, ring, abs(sum((x1 - fx) * (y2 - fy) - (x2 - fx) * (y1 - fy))) / 2 AS a FROM (SELECT *, first_value(x1) OVER w AS fx, first_value(y1) OVER w AS fy FROM s WINDOW w AS (PARTITION BY vec_id, part, ring ORDER BY k)) GROUP BY ALL), pa AS (SELECT vec_id, part, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS a FROM ar GROUP BY ALL)"


@query(f"""WITH {_shapes(False)}, {_AREAS}, l AS (SELECT vec_id, sum(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)) AS l, min(x1) AS xmin, max(y1) AS ymax FROM s GROUP BY vec_id),
cr AS (SELECT vec_id, ring, sum(x1 * y2 - x2 * y1) AS two, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS mx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS my FROM s GROUP BY vec_id, part, ring),
ce AS (SELECT vec_id, sum(CASE WHEN ring = 0 THEN 1 ELSE -1 END * mx * sign(two)) / 6 AS mx, sum(CASE WHEN ring = 0 THEN 1 ELSE -1 END * my * sign(two)) / 6 AS my FROM cr GROUP BY vec_id), t AS (SELECT vec_id, sum(a) AS a, count(*) AS n FROM pa GROUP BY vec_id)
SELECT vec_id, n AS n_parts, round(a, 8) AS area, round(l, 8) AS perimeter, round(xmin, 8) AS xmin, round(ymax, 8) AS ymax, round(mx / a, 6) AS centroid_x, round(my / a, 6) AS centroid_y FROM t JOIN l USING (vec_id) JOIN ce USING (vec_id)""")
def polygon_measures(t: Tables) -> DataFrame:
    """Area, length, bounds and centroid after a round trip through well-known binary."""
    some = polygons.decode(polygons.encode(shapes(t, False)).drop("parts"), "wkb")
    p = F.col("parts")
    got = some.select("vec_id", F.size(p).cast("long").alias("n_parts"), polygons.area(p).alias("area"), polygons.perimeter(p).alias("perimeter"), polygons.bounds(p).alias("b"), polygons.centroid(p).alias("c"))
    return got.select("vec_id", "n_parts", F.round("area", 8).alias("area"), F.round("perimeter", 8).alias("perimeter"), F.round("b.xmin", 8).alias("xmin"), F.round("b.ymax", 8).alias("ymax"), F.round("c.x", 6).alias("centroid_x"), F.round("c.y", 6).alias("centroid_y"))


@query(f"WITH {_shapes(False)}, {_AREAS} SELECT vec_id, CAST(arg_min(part, (-a, part)) AS BIGINT) AS part, round(max(a), 8) AS area FROM pa GROUP BY vec_id")
def polygon_largest_part(t: Tables) -> DataFrame:
    """Which part is the largest, found by taking the geometry apart; and the area of what ``largest_part`` keeps."""
    parts = polygons.exploded(shapes(t, False)).withColumn("a", polygons.area(F.col("parts")))
    number = parts.groupBy("vec_id").agg(F.min_by("part", F.struct(-F.col("a"), "part")).cast("long").alias("part"))
    kept = shapes(t, False).select("vec_id", F.round(polygons.area(polygons.largest_part(F.col("parts"))), 8).alias("area"))
    return number.join(kept, "vec_id")


@query(f"""WITH {_shapes()}, o AS (SELECT vec_id, part, x1, y1, x2, y2, k, ring FROM s),
x AS (SELECT DISTINCT a.vec_id FROM o a JOIN o b ON a.vec_id = b.vec_id AND a.part = b.part AND (a.ring, a.k) < (b.ring, b.k)
WHERE sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) * sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) < 0
AND sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) * sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) < 0)
SELECT CASE WHEN vec_id % 13 = 0 THEN 'empty' WHEN vec_id % 17 = 0 THEN 'null' WHEN x.vec_id IS NOT NULL THEN 'self-intersection' ELSE 'valid' END AS problem, count(*) AS n FROM e LEFT JOIN x USING (vec_id) GROUP BY 1""")
def polygon_problems(t: Tables) -> DataFrame:
    """Geometries by what is wrong with them."""
    p = F.when(F.col("vec_id") % 13 == 0, F.array().cast(polygons.PARTS)).when(F.col("vec_id") % 17 == 0, F.lit(None)).otherwise(F.col("parts"))
    return polygons.with_problem(shapes(t).withColumn("parts", p)).groupBy(F.coalesce("problem", F.lit("valid")).alias("problem")).agg(F.count("*").alias("n"))


@query()
def polygon_repairs(t: Tables) -> DataFrame:
    """Crossed geometries repaired: parts and area of what an odd number of rings surrounds."""
    got = polygons.prepared(shapes(t), "vec_id")
    return got.select("vec_id", F.size("parts").cast("long").alias("parts"), F.round(polygons.area(F.col("parts")), 6).alias("area"))


@query(f"""WITH {_shapes(False)}, c2 AS (SELECT vec_id, part, (min(y) + max(y)) / 2 AS mid FROM c GROUP BY ALL),
li AS (SELECT vec_id, part, (max(y) FILTER (y <= mid) + min(y) FILTER (y > mid)) / 2 AS line FROM c JOIN c2 USING (vec_id, part) GROUP BY ALL),
h AS (SELECT vec_id, part, line, x1 + (line - y1) * (x2 - x1) / (y2 - y1) AS x FROM s JOIN li USING (vec_id, part) WHERE (y1 <= line) <> (y2 <= line)),
r AS (SELECT *, row_number() OVER w AS n, lead(x) OVER w AS nx FROM h WINDOW w AS (PARTITION BY vec_id, part ORDER BY x)),
b AS (SELECT vec_id, arg_max({{'x': (x + nx) / 2, 'y': line}}, (nx - x, -x)) AS p FROM r WHERE n % 2 = 1 GROUP BY vec_id),
o AS (SELECT vec_id, CASE WHEN p.x BETWEEN 0 AND 64 AND 48 - p.y BETWEEN 0 AND 48 THEN CAST(greatest(ceil((48 - p.y) / 8) - 1, 0) * 8 + greatest(ceil(p.x / 8) - 1, 0) AS BIGINT) END AS tile FROM b)
SELECT tile, count(*) AS n, min(vec_id) AS low FROM o GROUP BY tile""")
def polygon_tiles(t: Tables) -> DataFrame:
    """Geometries owned by each tile of 8 x 8, by an interior point."""
    point = polygons.interior_point(F.col("parts"))
    owned = shapes(t, False).select("vec_id", polygons.tile_of(point, 0.0, 48.0, 8.0, 8, 6).alias("tile"))
    return owned.groupBy("tile").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))


@query(f"""WITH {_shapes(False)}, q AS (SELECT DISTINCT vec_id, x, y FROM c WHERE ring = 0), d AS (SELECT a.vec_id, (b.x - a.x) / sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) AS dx, (b.y - a.y) / sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) AS dy, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_
FROM q a JOIN q b ON a.vec_id = b.vec_id AND (a.x, a.y) <> (b.x, b.y)),
f AS (SELECT d.vec_id, dx, dy, max(x * dx + y * dy) - min(x * dx + y * dy) AS w, max(y * dx - x * dy) - min(y * dx - x * dy) AS h FROM d JOIN q USING (vec_id) GROUP BY d.vec_id, ax, ay, bx, by_, dx, dy HAVING min((bx - ax) * (y - ay) - (by_ - ay) * (x - ax)) >= -1e-9),
n AS (SELECT vec_id, min(w * h) AS m FROM f GROUP BY vec_id),
g AS (SELECT vec_id, arg_min({{'l': greatest(w, h), 's': least(w, h)}}, greatest(w, h)) AS r FROM f JOIN n USING (vec_id) WHERE w * h <= m * (1 + 1e-9) GROUP BY vec_id) SELECT vec_id, round(r.l * r.s, 6) AS box_area, round(r.l / r.s, 5) AS elongation FROM g""")
def polygon_rectangles(t: Tables) -> DataFrame:
    """Area and elongation of the least rotated rectangle round each geometry."""
    got = polygons.with_rectangle(shapes(t, False))
    return got.select("vec_id", F.round(F.col("long_side") * F.col("short_side"), 6).alias("box_area"), F.round("elongation", 5).alias("elongation"))


@query("""WITH v AS (SELECT vec_id, [CAST(floor(8 * CAST(embedding[1] AS DOUBLE)) AS DOUBLE), CAST(floor(8 * CAST(embedding[2] AS DOUBLE)) AS DOUBLE)] AS o FROM embeddings)
SELECT vec_id, o[1] + 0.5 AS x, o[2] + 0.5 AS y, row_number() OVER (ORDER BY o[1], o[2], vec_id) AS at FROM v WHERE o IN (SELECT o FROM v GROUP BY o HAVING count(*) > 1)""")
def duplicate_geometries(t: Tables) -> DataFrame:
    """Squares that stand more than once, in the order of their points."""
    x, y = (F.floor(8 * F.get("embedding", F.lit(i)).cast("double")).cast("double") for i in (0, 1))
    at = lambda i, j: F.struct((F.col("x") + i).alias("x"), (F.col("y") + j).alias("y"))
    squares = t.embeddings.select("vec_id", x.alias("x"), y.alias("y")).select("vec_id", F.array(F.array(F.array(at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0)))).alias("parts"))
    got = polygons.duplicates(polygons.encode(squares), "vec_id", "wkb").select("vec_id", "x", "y")
    from ..operators import order

    return order.numbered(got, ["x", "y", "vec_id"], "at").select("vec_id", "x", "y", F.col("at").cast("long").alias("at"))
