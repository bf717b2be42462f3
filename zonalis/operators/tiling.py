"""Partitioning of places: batches by cell, grids of n parts, bisection into tiles."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources import shared
from .zonal import finite


def batches(df: DataFrame, key: str, x: str, y: str, cell: float, most: int) -> DataFrame:
    """Adds cell_x, cell_y and batch: a cell's rows in order (y, x, key), cut every ``most`` rows.

    Rows of a cell are numbered within the cell only, so cells spread over tasks.
    """
    d = df.withColumn("cell_x", F.floor(F.col(x) / cell)).withColumn("cell_y", F.floor(F.col(y) / cell))
    n = F.row_number().over(Window.partitionBy("cell_y", "cell_x").orderBy(y, x, key))
    return d.withColumn("batch", F.floor((n - 1) / F.lit(most)))


def grid_shape(n: int, width: float, height: float) -> tuple[int, int]:
    """(rows, columns) with rows x columns = n whose cells are nearest to squares."""
    pairs = [(r, n // r) for r in range(1, n + 1) if n % r == 0]
    return min(pairs, key=lambda p: (abs(math.log((width / p[1]) / (height / p[0]))), p[0]))


def _bisected(x: np.ndarray, y: np.ndarray, tile: str, most: int) -> np.ndarray:
    """The tiles of one tile's rows."""
    out, open_ = np.empty(len(x), object), [(np.arange(len(x)), tile)]
    while open_:
        at, name = open_.pop()
        out[at] = name
        if len(at) <= most:
            continue
        with np.errstate(over="ignore"):
            w, h = np.ptp(x[at]), np.ptp(y[at])
        if w > 0 or h > 0:
            v = x[at] if w >= h else y[at]
            m = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
            low = v < m if m == v.max() else v <= m
            open_ += [(at[low], name + "0"), (at[~low], name + "1")]
    return out


def _medians(rows: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """tile, m: the exact lower median of v (n rows a tile, far more than ``accuracy``): a sketch brackets it, and only the rows in the bracket are ranked."""
    slack = 4.0 / accuracy
    span = rows.groupBy("tile").agg(F.percentile_approx("v", [0.5 - slack, 0.5 + slack], accuracy).alias("e"))
    span = shared.stored(span.select("tile", F.col("e")[0].alias("lo"), F.col("e")[1].alias("hi")), "brackets")
    near = rows.join(F.broadcast(span), "tile")  # a row for each large tile
    below = near.groupBy("tile").agg(F.count_if(F.col("v") < F.col("lo")).alias("below"))
    # equal values are one row
    inner = near.where(F.col("v").between(F.col("lo"), F.col("hi"))).groupBy("tile", "v").agg(F.count("*").alias("c"), F.first("n").alias("n")).join(below, "tile")
    upto = F.col("below") + F.sum("c").over(Window.partitionBy("tile").orderBy("v"))
    ranked = inner.withColumn("upto", upto).withColumn("want", F.floor((F.col("n") + 1) / 2))
    held = F.when((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("c") < F.col("want")), F.col("v"))
    m = ranked.groupBy("tile").agg(F.min(held).alias("m"))
    return m.select("tile", F.coalesce("m", F.raise_error(F.lit("no median in its bracket")).cast("double")).alias("m"))


def tiles(df: DataFrame, key: str, x: str, y: str, most: int, whole: int = 50_000) -> DataFrame:
    """key, tile: the longer side is halved at its lower median until no tile has more than ``most`` rows or extent.

    Rows up to the median are the first half; if it is the largest value, those
    below it are.  A row without a finite place has no tile.  Tiles of more than
    ``whole`` rows are halved level by level, each level written to the shared
    folder, so no plan holds an earlier one; a smaller tile is what a task holds.
    """
    whole = max(whole, most)
    place = F.col("x").isNotNull() & F.col("y").isNotNull()
    d = df.select(F.col(key).alias("k"), *[finite(F.col(c).cast("double")).alias(n) for c, n in ((x, "x"), (y, "y"))])
    d = shared.stored(d.withColumn("tile", F.when(place, "r")), "tiles")
    while True:
        g = d.where("tile is not null").groupBy("tile").agg(F.count("*").alias("n"), *[f(c).alias(a + c) for c in "xy" for a, f in (("l", F.min), ("h", F.max))])
        g = g.withColumn("w", F.col("hx") - F.col("lx")).withColumn("h", F.col("hy") - F.col("ly")).where((F.col("n") > most) & ((F.col("w") > 0) | (F.col("h") > 0)))
        by_x = F.col("w") >= F.col("h")
        g = shared.stored(g.select("tile", "n", by_x.alias("by_x"), F.when(by_x, F.col("hx")).otherwise(F.col("hy")).alias("top")), "open")
        large = g.where(F.col("n") > whole)
        if large.isEmpty():
            break
        v = F.when(F.col("by_x"), F.col("x")).otherwise(F.col("y"))
        cut = _medians(d.join(F.broadcast(large), "tile").select("tile", "n", v.alias("v")))  # a row for each large tile
        cut = shared.stored(cut.join(large, "tile"), "cuts")
        low = F.when(F.col("m") == F.col("top"), v < F.col("m")).otherwise(v <= F.col("m"))
        name = F.when(F.col("m").isNull(), F.col("tile")).otherwise(F.concat("tile", F.when(low, "0").otherwise("1")))
        d = shared.stored(d.join(F.broadcast(cut), "tile", "left").select("k", "x", "y", name.alias("tile")), "tiles")

    def run(t: pa.Table) -> pa.Table:
        names = _bisected(t["x"].to_numpy(), t["y"].to_numpy(), t["tile"][0].as_py(), most)
        return pa.table({"k": t["k"], "tile": pa.array(names, pa.string())})

    schema = StructType([d.schema["k"], StructField("tile", StringType())])
    small = d.join(g.select("tile"), "tile", "left_semi").select("k", "x", "y", "tile").groupBy("tile").applyInArrow(run, schema)
    rest = d.join(g.select("tile"), "tile", "left_anti").select("k", "tile")
    return small.union(rest).select(F.col("k").alias(key), "tile")
