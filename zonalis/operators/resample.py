"""Rasters onto another grid: each target cell looks up its few source cells by equality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .polygons import Grid


def _centres(spark, target: Grid) -> DataFrame:
    """row, col and the centre (x, y) of the target's cells."""
    cells = spark.range(target.rows * target.cols).select(F.expr(f"id div {target.cols}").alias("row"), (F.col("id") % target.cols).alias("col"))
    return cells.select("row", "col", (target.west + (F.col("col") + 0.5) * target.width).alias("x"), (target.north - (F.col("row") + 0.5) * target.height).alias("y"))


def resample(df: DataFrame, source: Grid, target: Grid, value: str, keys: list[str] | None = None, method: str = "bilinear", row: str = "row", col: str = "col") -> DataFrame:
    """``keys``, row, col, value of the target's cells that have an observed source.

    ``near`` takes the source cell that holds the centre; ``bilinear`` weighs the four
    nearest source centres, the weights renormalised over the observed ones.
    Centres outside the source have no value.  The work is one shuffle by
    source cell, and no layer is held whole.
    """
    if method not in ("bilinear", "near"):
        raise ValueError(f"unknown method {method!r}; known: bilinear, near")
    keys = keys or []
    fx, fy = (F.col("x") - source.west) / source.width, (F.lit(source.north) - F.col("y")) / source.height
    at = _centres(df.sparkSession, target).select("row", "col", fx.alias("fx"), fy.alias("fy")).where((F.col("fx") >= 0) & (F.col("fx") < source.cols) & (F.col("fy") >= 0) & (F.col("fy") < source.rows))
    if method == "near":
        some = at.select("row", "col", F.floor("fy").alias("_r"), F.floor("fx").alias("_c"), F.lit(1.0).alias("_w"))
    else:
        at = at.select("row", "col", F.floor(F.col("fy") - 0.5).alias("r"), F.floor(F.col("fx") - 0.5).alias("c"), (F.col("fy") - 0.5 - F.floor(F.col("fy") - 0.5)).alias("v"), (F.col("fx") - 0.5 - F.floor(F.col("fx") - 0.5)).alias("u"))
        corner = lambda i, j: F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c"), ((F.col("v") if i else 1 - F.col("v")) * (F.col("u") if j else 1 - F.col("u"))).alias("w"))
        some = at.select("row", "col", F.explode(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)])).alias("s")).select("row", "col", F.col("s.r").alias("_r"), F.col("s.c").alias("_c"), F.col("s.w").alias("_w")).where("_w > 0")
    cells = df.where(F.col(value).isNotNull()).select(*keys, F.col(row).cast("long").alias("_r"), F.col(col).cast("long").alias("_c"), F.col(value).cast("double").alias("_v"))
    met = some.join(cells, ["_r", "_c"])
    return met.groupBy(*keys, "row", "col").agg((F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias(value))
