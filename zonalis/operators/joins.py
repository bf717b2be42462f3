"""Joins beyond equality: as-of, interval, nearest, distance, grid, checked lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import shared
from .zonal import finite


def asof(left: DataFrame, right: DataFrame, by: list[str], time: str, values: list[str], direction: str = "backward", allow_exact: bool = True) -> DataFrame:
    """Each left row with the latest earlier (or next later) right row of its key.

    One union, one shuffle by key and a window: no range of the right side is
    copied, and both sides share the sort.
    """
    tag = (1 if allow_exact else -1) * (1 if direction == "backward" else -1)
    l = left.select(*left.columns, *[F.lit(None).cast(right.schema[v].dataType).alias(f"_r_{v}") for v in values], F.lit(tag).alias("_side"), F.lit(False).alias("_is"))
    r = right.select(*[F.col(c) if c in (*by, time) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns], *[F.col(v).alias(f"_r_{v}") for v in values], F.lit(0).alias("_side"), F.lit(True).alias("_is"))
    both = l.unionByName(r)
    w = Window.partitionBy(*by)
    hit = F.struct(*[F.col(f"_r_{v}").alias(v) for v in values])
    found = F.when(F.col("_is"), hit)
    # forward runs from the end: a frame that starts at the first row grows by a row, one that ends at the last is read anew for every row
    order = [F.col(c) if direction == "backward" else F.col(c).desc() for c in (time, "_side")]
    got = F.last(found, True).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_got", got).where(~F.col("_is")).select(*left.columns, *[F.col(f"_got.{v}").alias(v) for v in values])


def interval(left: DataFrame, right: DataFrame, at: str, start: str, end: str, bucket: float, by: list[str] | None = None, how: str = "inner", strict: bool = False) -> DataFrame:
    """Rows with start <= at < end: both sides meet on a bucket of the axis, so the join is by equality and shuffles once.

    ``strict``: a left row in no interval is an error when the plan runs, not dropped.
    """
    by = by or []
    if strict:
        got = interval(left, right.withColumn("_in", F.lit(True)), at, start, end, bucket, by, "left")
        said = F.concat(F.lit(f"{at} outside all intervals: "), F.coalesce(F.col(at).cast("string"), F.lit("null")))
        return got.where(F.when(F.col("_in").isNull(), F.raise_error(said).cast("boolean")).otherwise(F.lit(True))).drop("_in")
    l = left.withColumn("_b", F.floor(F.col(at) / bucket))
    r = right.withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket))))
    on = (l["_b"] == r["_b"]) & (l[at] >= r[start]) & (l[at] < r[end])
    for k in by:
        on = on & (l[k] == r[k])
    return l.join(r, on, how).drop(l["_b"]).drop(r["_b"])


def nearest_1d(left: DataFrame, right: DataFrame, left_id: str, at: str, right_id: str, right_at: str, by: list[str]) -> DataFrame:
    """The right row nearest on one axis within each key; ties take the smallest id.  Two as-of passes, no cross join."""
    r = right.groupBy(*by, F.col(right_at).alias("_x")).agg(F.min(right_id).alias("_id"))
    l = left.withColumnRenamed(at, "_at")
    back = asof(l.withColumn("_t", F.col("_at")), r.withColumnRenamed("_x", "_t").withColumn("_xb", F.col("_t")).withColumnRenamed("_id", "_ib"), by, "_t", ["_xb", "_ib"])
    both = asof(back, r.withColumnRenamed("_x", "_t").withColumn("_xf", F.col("_t")).withColumnRenamed("_id", "_if"), by, "_t", ["_xf", "_if"], "forward")
    db, df_ = F.col("_at") - F.col("_xb"), F.col("_xf") - F.col("_at")
    near = F.when(df_.isNull() | (db < df_), F.struct(db.alias("d"), F.col("_ib").alias("i")))
    near = near.when(db.isNull() | (df_ < db), F.struct(df_.alias("d"), F.col("_if").alias("i")))
    near = near.otherwise(F.struct(db.alias("d"), F.least("_ib", "_if").alias("i")))
    return both.withColumn("_n", near).select(*[c for c in left.columns if c != at], F.col("_at").alias(at), F.col("_n.i").alias(right_id), F.col("_n.d").alias("distance"))


def cells(x: str, y: str, size: float) -> list[Column]:
    return [F.floor(F.col(x) / size).cast("long").alias("_cx"), F.floor(F.col(y) / size).cast("long").alias("_cy")]


def _around(df: DataFrame) -> DataFrame:
    """Each row in its cell and the eight beside it."""
    beside = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    return df.select("*", beside.alias("_o")).withColumn("_cx", F.col("_cx") + F.col("_o.i")).withColumn("_cy", F.col("_cy") + F.col("_o.j")).drop("_o")


def _side(radius: float) -> float:
    """A cell's side for ``radius``: wider by a trifle, so that rounding parts no pair by two cells."""
    return radius * (1 + 2.0**-20)


def within(left: DataFrame, right: DataFrame, x: str, y: str, rx: str, ry: str, radius: float, by: list[str] | None = None) -> DataFrame:
    """Pairs at most ``radius`` apart (and equal in ``by``), with ``distance``: the right side is copied to the nine cells around it, the join is on cells."""
    l = left.select("*", *cells(x, y, _side(radius)))
    r = _around(right.select("*", *cells(rx, ry, _side(radius))))
    out = l.join(r, [*(by or []), "_cx", "_cy"]).withColumn("distance", F.hypot(F.col(x) - F.col(rx), F.col(y) - F.col(ry)))
    return out.where(F.col("distance") <= radius).drop("_cx", "_cy")


def idw(targets: DataFrame, donors: DataFrame, key: str, x: str, y: str, rx: str, ry: str, value: str, radius: float) -> DataFrame:
    """Inverse-distance mean of the donors within ``radius``; none gives null."""
    pairs = within(targets, donors, x, y, rx, ry, radius).withColumn("_w", 1 / F.greatest("distance", F.lit(1e-6)))
    got = pairs.groupBy(key).agg((F.sum(F.col(value) * F.col("_w")) / F.sum("_w")).alias("filled"), F.count("*").alias("donors"))
    return targets.select(key).join(got, key, "left")


def _places(right: DataFrame, by: list[str], rx: str, ry: str, row: Column, key: str | None) -> DataFrame:
    """A row for each place: ``_c``, its least ``row``; with ``key`` also the least of another key, so that whoever leaves out a key finds the other."""
    spot = [*by, rx, ry]
    if key is None:
        return right.groupBy(*spot).agg(F.array(F.struct(F.min(row).alias("r"))).alias("_c"))
    each = right.where(F.col(key).isNotNull()).groupBy(*spot, F.col(key).alias("_o")).agg(F.min(row).alias("_r"))
    two = each.withColumn("_k", F.row_number().over(Window.partitionBy(*spot).orderBy("_r"))).where("_k <= 2")
    return two.groupBy(*spot).agg(F.array_sort(F.collect_list(F.struct(F.col("_r").alias("r"), F.col("_o").alias("o")))).alias("_c"))


def nearest_2d(left: DataFrame, right: DataFrame, keys: list[str], x: str, y: str, rx: str, ry: str, ties: list[str], values: list[str], by: list[str] | None = None, most: float | None = None, other: tuple[str, str] | None = None, crowd: int = 16) -> DataFrame:
    """Each left row (unique by ``keys``) with ``values`` of the right row nearest to it, and ``distance``; of equal distances the least ``ties``.

    Right rows of one place are one.  The first radius is that of a disc for
    each place on average, halved while cells would pair more than ``crowd``
    places a row; rows without a neighbour try again with the radius doubled,
    so a far one costs no near one anything.  Beyond ``most`` (none: anywhere)
    the result is null, as it is for a row without finite coordinates.
    ``other`` (a left and a right column): only right rows that differ in it.
    """
    by = by or []
    placed = lambda d, a, b: d.where(finite(F.col(a).cast("double")).isNotNull() & finite(F.col(b).cast("double")).isNotNull())
    box = lambda d, a, b: d.agg(F.min(a).alias("a"), F.max(a).alias("b"), F.min(b).alias("c"), F.max(b).alias("d"), F.count("*").alias("n")).first()
    found = left.sparkSession.createDataFrame([], left.select(*keys).schema)
    row = F.struct(*[F.col(v).alias(f"_t{i}") for i, v in enumerate(ties)], *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    picked = F.get("_c", F.lit(0)) if other is None else F.get(F.filter("_c", lambda c: c["o"] != F.col("_own")), F.lit(0))
    near = F.struct("distance", F.col("_p.r").alias("r"))
    empty = right.limit(0).select(F.struct(F.lit(0.0).alias("distance"), row.alias("r")).alias("_b"))
    found = found.join(empty, F.lit(False), "left")
    own = [] if other is None else [F.col(other[0]).alias("_own")]
    rest = shared.stored(placed(left, x, y).select(*keys, *[c for c in by if c not in keys], *[c for c in (x, y) if c not in keys], *own), "targets")
    spots = shared.stored(_places(placed(right, rx, ry), by, rx, ry, row, other and other[1]), "places")
    p, q = box(rest, x, y), box(spots, rx, ry)
    if p["n"] and q["n"]:
        wide, high = max(p["b"], q["b"]) - min(p["a"], q["a"]), max(p["d"], q["d"]) - min(p["c"], q["c"])
        end = float((wide * wide + high * high) ** 0.5) * 1.000001 or 1.0
        end = end if most is None else min(end, most)
        far = max(abs(float(v)) for b in (p, q) for v in (b["a"], b["b"], b["c"], b["d"]))
        least = min(end, max(end / 2**40, far / 2**30))  # below, rounding would blur the cells
        radius = min(end, max(least, float(max(wide, 1e-9) * max(high, 1e-9) / q["n"]) ** 0.5))

        def pairs() -> float:
            """Pairs that the cells of this radius would meet."""
            count = lambda d, a, b, n: d.select(*by, *cells(a, b, _side(radius))).groupBy(*by, "_cx", "_cy").agg(F.count("*").alias(n))
            met = count(rest, x, y, "_l").join(_around(count(spots, rx, ry, "_r")), [*by, "_cx", "_cy"])
            return met.agg(F.sum(F.col("_l").cast("double") * F.col("_r"))).first()[0] or 0.0

        while radius > least and pairs() > crowd * (p["n"] + q["n"]):
            radius = max(least, radius / 2)
        while True:
            met = within(rest, spots, x, y, rx, ry, radius, by).withColumn("_p", picked).where("_p is not null")
            got = shared.stored(met.groupBy(*keys).agg(F.min(near).alias("_b")), "nearest")
            found = found.unionByName(got)
            rest = shared.stored(rest.join(got, keys, "left_anti"), "targets")
            if radius >= end or rest.isEmpty():
                break
            radius = min(end, radius * 2)
    return left.join(found, keys, "left").select(*left.columns, *[F.col(f"_b.r._v{i}").alias(v) for i, v in enumerate(values)], F.col("_b.distance").alias("distance"))


def unique_key(df: DataFrame, keys: list[str], what: str = "right side") -> DataFrame:
    """``df`` itself; a repeated key is an error when the plan runs (no job of its own, one window less than a check by count)."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{what}: key {keys} isn't unique")).cast("boolean")).otherwise(F.lit(True))).drop("_n")


def lookup(df: DataFrame, table: DataFrame, keys: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Many-to-one left join with a checked right key; unmatched rows take ``defaults``."""
    out = df.join(unique_key(table, keys), keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def grid_cell(x: Column, origin: Column, width: Column, n: int) -> Column:
    """Index of the cell of a point, clamped to the grid."""
    return F.least(F.greatest(F.floor((x - origin) / width), F.lit(0)), F.lit(n - 1)).cast("long")
