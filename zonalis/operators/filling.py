"""The whole chain of fills of a stack of layers: in time, from windows, by interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import shared
from . import cleaning, joins, spatial

METHODS = ("nearest", "idw", "kriging")


def check_interpolation(method: str | None, distance: float | None, lags: int = 8) -> None:
    """ValueError unless ``method`` is none or known, distances are positive where given and given where needed (idw, kriging), and there is a lag."""
    if method is not None and method not in METHODS:
        raise ValueError(f"unknown interpolation {method!r}: one of {', '.join(METHODS)}")
    if distance is not None and not distance > 0:
        raise ValueError("an interpolation's distance is positive")
    if method in ("idw", "kriging") and distance is None:
        raise ValueError(f"{method} takes a distance")
    if lags < 1:
        raise ValueError("a variogram takes one lag at least")


def interpolate(df: DataFrame, layer: list[str], y: str, x: str, value: str, method: str, distance: float | None = None, spacing: tuple[float, float] = (1.0, 1.0), lags: int = 8, out: str = "filled") -> DataFrame:
    """Missing cells of each layer from its observed ones; what no observed cell reaches stays null.

    nearest: the nearest (ties: least y, then x), within ``distance`` if given;
    idw: the inverse-distance mean within ``distance``; kriging: ordinary
    kriging with a variogram of ``lags`` bins up to ``distance``, which holds a
    layer in a task.  ``spacing`` is the size of a step in y and x.
    """
    check_interpolation(method, distance, lags)
    if method == "nearest":
        return cleaning.nearest_fill(df, layer, y, x, value, spacing, distance, out).drop("_py", "_px")
    placed = df.withColumn("_py", F.col(y) * spacing[0]).withColumn("_px", F.col(x) * spacing[1])
    if method == "kriging":
        return spatial.krige(placed, layer, "_px", "_py", value, lags=lags, reach=distance).drop("_py", "_px").withColumnRenamed("filled", out)
    gaps = placed.where(F.col(value).isNull()).select(*layer, y, x, "_py", "_px")
    donors = placed.where(F.col(value).isNotNull()).select(*layer, F.col("_py").alias("_qy"), F.col("_px").alias("_qx"), F.col(value).alias("_v"))
    pairs = joins.within(gaps, donors, "_px", "_py", "_qx", "_qy", distance, layer).withColumn("_w", 1 / F.greatest("distance", F.lit(1e-6)))
    got = pairs.groupBy(*layer, y, x).agg((F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias("_near"))
    return df.join(got, [*layer, y, x], "left").withColumn(out, F.coalesce(value, "_near")).drop("_near")


def chain(df: DataFrame, keys: list[str], time: str, y: str, x: str, value: str, temporal: tuple[int, ...] = (3, 5), past_only: bool = False, windows: tuple[int, ...] = (3, 5, 7, 9), method: str | None = None, distance: float | None = None, spacing: tuple[float, float] = (1.0, 1.0), lags: int = 8) -> DataFrame:
    """Adds filled and source: observed, temporal, spatial_3 ... spatial_9, interpolated, or null where nothing reached.

    A cell is first filled from its own series within the ``temporal``
    windows, then from means of growing ``windows`` of its layer (each over
    what the one before filled), then by ``method`` from all that its layer
    has by then.  Observed values never change.  Each stage's rows are
    written, and once no cell is missing no further stage is planned.  ``df``
    has a row for each cell of each layer (``keys`` and ``time``); null keys
    are no layer of their own in the last stage.
    """
    check_interpolation(method, distance, lags)
    taken = {"filled", "source", "_f"} & set(df.columns)
    if taken:
        raise ValueError(f"columns of the result are there already: {sorted(taken)}")
    layer = [*keys, time]
    steps = [("temporal", lambda d: cleaning.fill_bounded(d, [*keys, y, x], time, "filled", temporal, past_only, "_f"))] if temporal else []
    steps += [(f"spatial_{w}", lambda d, w=w: cleaning.spatial_mean(d, layer, y, x, "filled", w, "_f")) for w in windows]
    if method:
        steps.append(("interpolated", lambda d: interpolate(d, layer, y, x, "filled", method, distance, spacing, lags, "_f")))
    d = df.withColumn("filled", F.col(value).cast("double")).withColumn("source", F.when(F.col(value).isNotNull(), "observed"))
    for name, fill in steps:
        if d.where("filled is null").isEmpty():
            break
        new = fill(d).withColumn("source", F.coalesce("source", F.when(F.col("_f").isNotNull(), name))).withColumn("filled", F.col("_f"))
        d = shared.stored(new.select(*df.columns, "filled", "source"), f"fill-{name}")
    return d
