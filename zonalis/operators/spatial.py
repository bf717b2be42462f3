"""Spatial operators: clusters within a distance, variograms, kriging, polygons, synthetic neighbours."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import shared
from . import joins, order
from .zonal import finite


def components(links: DataFrame) -> DataFrame:
    """node, label of every linked node: the smallest node of its connected component.

    Alternating large-star and small-star steps over ``links`` (a, b); each is
    written to the shared folder, so no plan holds an earlier one.
    """
    spread = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    edges = shared.stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = spread(edges)
    while state["n"]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v")))
        edges = shared.stored(small.distinct(), "edges")
        was, state = state, spread(edges)
        if state == was:
            break
    label = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return label.union(label.select(F.col("label").alias("node"), "label").distinct())


def _corner(side: float, prefix: str = "c") -> list[Column]:
    """The lower corner of the cell of (x, y), exact for a ``side`` that is a power of two; where doubles lie further apart, the place itself."""
    at = lambda v: F.when(F.abs(v) < side * 2.0**52, F.floor(F.col(v) / side) * F.lit(side)).otherwise(F.col(v))
    return [at("x").alias(f"{prefix}x"), at("y").alias(f"{prefix}y")]


def _boxes(spots: DataFrame, by: list[str]) -> DataFrame:
    """By cell: its least key a, places n, and w, the places furthest left, right, down and up."""
    p, q = F.struct("x", "y"), F.struct("y", "x")
    g = spots.groupBy(*by).agg(F.min("a").alias("a"), F.count("*").alias("n"), F.min(p).alias("l"), F.max(p).alias("r"), F.min(q).alias("d"), F.max(q).alias("u"))
    return g.select(*by, "a", "n", F.array(*[F.struct(f"{s}.x", f"{s}.y") for s in "lrdu"]).alias("w"))


def _apart(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def _judged(w: Column, v: Column, distance: float) -> tuple[Column, Column]:
    """Of two boxes, whether places of theirs surely are linked, and whether any can be; rounding is monotonic, so both are exact."""
    ends = [(w[i][c], w[i + 1][c], v[i][c], v[i + 1][c]) for i, c in ((0, "x"), (2, "y"))]
    least = _apart(*[F.greatest(c - b, a - d, F.lit(0.0)) for a, b, c, d in ends])
    most = _apart(*[F.greatest(d - a, b - c) for a, b, c, d in ends])
    seen = F.exists(w, lambda p: F.exists(v, lambda q: _apart(p["x"] - q["x"], p["y"] - q["y"]) <= distance))
    return (most <= distance) | seen, least <= distance


def clusters(points: DataFrame, key: str, x: str, y: str, distance: float, block: int = 4096) -> DataFrame:
    """key, cluster (its smallest key), size: connected components of the points at most ``distance`` apart.

    A cell's points all lie within the distance, so cells are what is linked:
    first by their boxes and outermost places, then, between cells of different
    components only, by all pairs of places.  Two cells of more than ``block``
    pairs are cut into quarters until their boxes decide or few pairs are left,
    so no crowd is multiplied out.  A repeated key is one node with several
    places; keys that are null or without a finite place are their own cluster.
    """
    if not distance > 0:
        raise ValueError("distance must be above nought")
    side = 2.0 ** math.floor(math.log2(distance / 1.4143))
    rows = points.select(F.col(key).alias("a"), finite(F.col(x).cast("double")).alias("x"), finite(F.col(y).cast("double")).alias("y"))
    rows = shared.stored(rows.select("a", "x", "y", *_corner(side)), "places")
    have = rows.where("a is not null and x is not null and y is not null")
    spots = shared.stored(have.groupBy("cx", "cy", "x", "y").agg(F.min("a").alias("a")), "spots")
    cells = shared.stored(_boxes(spots, ["cx", "cy"]), "cells")

    gap = lambda i: max(abs(i) - 1, 0) * side
    around = [(i, j) for i in range(4) for j in range(-3, 4) if (i, j) > (0, 0) and math.hypot(gap(i), gap(j)) <= distance]
    side_of = lambda d, s, a="a": d.select(F.col(a).alias(s), F.col("cx").alias(f"{s}x"), F.col("cy").alias(f"{s}y"), F.col("n").alias(f"{s}n"), F.col("w").alias(f"{s}w"))
    offset = F.explode(F.array(*[F.struct(F.lit(i * side).alias("x"), F.lit(j * side).alias("y")) for i, j in around]))
    left = side_of(cells, "a").select("*", offset.alias("o")).withColumn("bx", F.col("ax") + F.col("o.x")).withColumn("by", F.col("ay") + F.col("o.y")).drop("o")
    sure, can = _judged(F.col("aw"), F.col("bw"), distance)
    places = ["ax", "ay", "bx", "by", (F.col("an").cast("double") * F.col("bn")).alias("n")]
    pairs = shared.stored(left.join(side_of(cells, "b"), ["bx", "by"]).where(can).select("a", "b", *places, sure.alias("sure")), "pairs")
    moved = have.groupBy("a").agg(*[f(c).alias(f"{n}{c}") for n, f in (("l", F.min), ("h", F.max)) for c in ("cx", "cy")]).where("lcx <> hcx or lcy <> hcy")
    homes = have.join(moved.select("a"), "a", "left_semi").join(cells.select("cx", "cy", F.col("a").alias("node")), ["cx", "cy"])
    links = pairs.where("sure").select("a", "b").union(homes.select("a", F.col("node").alias("b")))
    label = shared.stored(components(links), "labels")

    of = lambda s: label.select(F.col("node").alias(s), F.col("label").alias(f"l{s}"))
    rest = pairs.where("not sure").join(of("a"), "a", "left").join(of("b"), "b", "left").withColumn("a", F.coalesce("la", "a")).withColumn("b", F.coalesce("lb", "b"))
    rest = shared.stored(rest.where("a <> b").select("a", "b", "ax", "ay", "bx", "by", "n"), "rest")
    more = []
    for level in range(41):  # at the last, places that halving hardly parts: all their pairs
        if rest.isEmpty():
            break
        few = rest if level == 40 else rest.where(F.col("n") <= block)
        p, q = (spots.select(*_corner(side, s), F.col("x").alias(f"{s}_x"), F.col("y").alias(f"{s}_y")) for s in "ab")
        tested = few.join(p, ["ax", "ay"]).join(q, ["bx", "by"]).where(_apart(F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")) <= distance)
        found = tested.select("a", "b")
        many = rest.where(F.col("n") > block)
        if level == 40 or many.isEmpty():
            more.append(shared.stored(found.distinct(), "found"))
            break
        touched = many.select(F.col("ax").alias("px"), F.col("ay").alias("py")).union(many.select("bx", "by")).distinct()
        inner = spots.select("a", "x", "y", *_corner(side, "p")).join(touched, ["px", "py"])
        side /= 2
        inner = shared.stored(_boxes(inner.select("a", "x", "y", "px", "py", *_corner(side)), ["px", "py", "cx", "cy"]), "quarters")
        p, q = (inner.select(F.col("px").alias(f"{s}x"), F.col("py").alias(f"{s}y"), F.struct("cx", "cy", "n", "w").alias(f"{s}q")) for s in "ab")
        both = many.select("a", "b", "ax", "ay", "bx", "by").join(p, ["ax", "ay"]).join(q, ["bx", "by"])
        sure, can = _judged(F.col("aq.w"), F.col("bq.w"), distance)
        quarters = [F.col(f"{s}q.c{c}").alias(f"{s}{c}") for s in "ab" for c in "xy"]
        both = shared.stored(both.where(can).select("a", "b", *quarters, (F.col("aq.n").cast("double") * F.col("bq.n")).alias("n"), sure.alias("sure")), "pairs")
        more.append(shared.stored(found.union(both.where("sure").select("a", "b")).distinct(), "found"))
        rest = shared.stored(both.where("not sure").drop("sure").join(more[-1], ["a", "b"], "left_anti"), "rest")

    lead = cells.select("cx", "cy", F.col("a").alias("node")).join(label, "node", "left").select("cx", "cy", F.coalesce("label", "node").alias("l"))
    if more:
        last = components(reduce(DataFrame.union, more))
        lead = lead.join(last.select(F.col("node").alias("l"), "label"), "l", "left").select("cx", "cy", F.coalesce("label", "l").alias("l"))
    alone = rows.where("a is null or x is null or y is null").select("a", F.lit(None).cast(rows.schema["a"].dataType).alias("l"))
    known = have.select("a", "cx", "cy").join(lead, ["cx", "cy"]).select("a", "l").union(alone)
    known = shared.stored(known.groupBy("a").agg(F.min("l").alias("l")).select("a", F.coalesce("l", "a").alias("l")), "clusters")
    size = known.groupBy("l").agg(F.count("*").alias("size")).withColumnRenamed("l", "m")
    return known.join(size, F.col("l").eqNullSafe(F.col("m"))).select(F.col("a").alias(key), F.col("l").alias("cluster"), "size")


def _morton(c: Column) -> Column:
    """31 bits with a nought before each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def _leaves(x: np.ndarray, y: np.ndarray, size: int = 256) -> list[np.ndarray]:
    """The points' indices in groups of at most ``size``, halved along the longer side."""
    todo, out = [np.arange(len(x))], []
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        c = x if np.ptp(x[at]) >= np.ptp(y[at]) else y
        at = at[np.argpartition(c[at], len(at) // 2)]
        todo += [at[: len(at) // 2], at[len(at) // 2 :]]
    return out


def _lag_sums(p: pd.DataFrame, q: pd.DataFrame, same: bool, lags: int, reach: float) -> pd.DataFrame:
    """By bin: pairs of a row of ``p`` and one of ``q``, sums of distances, pairs with both values and their squared differences.

    Rows are places with x, y, v, known (v is a value), n (points) and g (a
    repeated key's number or -1).  ``same``: ``q`` is ``p``, each pair counts
    once.  Boxes of groups tell which are out of reach and which pairs of
    groups lie in one bin; rounding is monotonic, so both are exact.
    """
    width = reach / lags
    count, known = np.zeros(lags, np.int64), np.zeros(lags, np.int64)
    far, semi = np.zeros(lags), np.zeros(lags)
    sides = []
    for d in (p,) if same else (p, q):
        cols = [d[c].to_numpy() for c in ("x", "y", "v", "known", "n", "g")]
        groups = [tuple(c[at] for c in cols) for at in _leaves(cols[0], cols[1])]
        plain = [bool(k.all() and (n == 1).all() and (g < 0).all()) for _, _, _, k, n, g in groups]
        box = np.array([(x.min(), x.max(), y.min(), y.max()) for x, y, *_ in groups])
        sides.append((groups, plain, box))
    (left, plain_l, bl), (right, plain_r, br) = sides[0], sides[-1]
    apart = lambda dx, dy: np.sqrt(dx * dx + dy * dy)

    for i, (xi, yi, vi, ki, ni, gi) in enumerate(left):
        a, b, c, d = bl[i]
        least = apart(np.maximum(np.maximum(br[:, 0] - b, a - br[:, 1]), 0), np.maximum(np.maximum(br[:, 2] - d, c - br[:, 3]), 0))
        most = apart(np.maximum(br[:, 1] - a, b - br[:, 0]), np.maximum(br[:, 3] - c, d - br[:, 2]))
        for j in np.nonzero(least <= reach)[0]:
            if same and j < i:
                continue
            xj, yj, vj, kj, nj, gj = right[j]
            h = apart(xi[:, None] - xj, yi[:, None] - yj)
            s = (vi[:, None] - vj) ** 2
            inner = same and i == j
            if not inner and plain_l[i] and plain_r[j]:
                low = min(int(least[j] / width), lags - 1)
                if most[j] <= reach and low == min(int(most[j] / width), lags - 1):
                    count[low] += h.size
                    known[low] += h.size
                    far[low] += h.sum()
                    semi[low] += s.sum()
                    continue
                w = u = None
            else:
                w = ni[:, None] * nj
                if inner:  # a place's points are pairs too, unless they are one key
                    w = np.triu(w, 1)
                    np.fill_diagonal(w, np.where(gi < 0, ni * (ni - 1) // 2, 0))
                w[(gi[:, None] == gj) & (gi[:, None] >= 0)] = 0
                u = w * (ki[:, None] & kj)
                s = np.where(u > 0, s, 0.0)
            at = np.minimum(h / width, lags - 1).astype(np.intp)
            at[h > reach] = lags
            at = at.ravel()
            if w is None:
                got = np.bincount(at, minlength=lags + 1)[:lags]
                count += got
                known += got
            elif float(ni.sum()) * float(nj.sum()) < 2.0**53:
                count += np.bincount(at, w.ravel(), lags + 1)[:lags].astype(np.int64)
                known += np.bincount(at, u.ravel(), lags + 1)[:lags].astype(np.int64)
            else:  # doubles would miscount
                count += np.array([w.ravel()[at == k].sum() for k in range(lags)])
                known += np.array([u.ravel()[at == k].sum() for k in range(lags)])
            far += np.bincount(at, (h if w is None else h * w).ravel(), lags + 1)[:lags]
            semi += np.bincount(at, (s if w is None else s * u).ravel(), lags + 1)[:lags]
    have = np.nonzero(count)[0]
    return pd.DataFrame({"bin": have, "pairs": count[have], "far": far[have], "known": known[have], "semi": semi[have]})


def variogram(points: DataFrame, key: str, x: str, y: str, value: str, lags: int, reach: float, block: int = 65536) -> DataFrame:
    """Lag bins up to ``reach``: pairs, mean distance, semivariance (of the pairs with both values) over all pairs of points of different keys.

    Equal points are one place with a count.  Places in the order of a curve
    are cut into blocks of equal size, however crowded, and a task takes two
    blocks whose boxes are in reach: what it holds is bounded, no pair is ever
    a row, and the time is that of the pairs in reach, shared evenly.
    """
    if lags < 1 or not reach > 0:
        raise ValueError("a variogram takes one lag at least and a reach above nought")
    v = F.col(value).cast("double")
    rows = points.select(F.col(key).alias("k"), finite(F.col(x).cast("double")).alias("x"), finite(F.col(y).cast("double")).alias("y"), F.coalesce(v, F.lit(0.0)).alias("v"), v.isNotNull().alias("known"))
    rows = rows.where("k is not null and x is not null and y is not null")
    again = shared.stored(rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k", F.monotonically_increasing_id().alias("g")), "keys")
    spots = rows.join(again, "k", "left").groupBy("x", "y", "v", "known", F.coalesce("g", F.lit(-1)).alias("g")).agg(F.count("*").alias("n"))
    spots = shared.stored(spots, "places")
    box = spots.agg(F.count("*").alias("n"), *[f(c).alias(f"{n}{c}") for c in "xy" for n, f in (("l", F.min), ("h", F.max))]).first()
    size = min(block, max(256, -(-box["n"] // 32)))  # few points make some hundred pairs of blocks too

    def share(c: str) -> Column:
        low, wide = box[f"l{c}"] or 0.0, (box[f"h{c}"] or 0.0) - (box[f"l{c}"] or 0.0)
        part = (F.col(c) - low) / wide if 0 < wide < math.inf else F.lit(0.0)
        return F.floor(F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0)) * (2.0**31 - 1)).cast("long")

    curve = spots.withColumn("c", _morton(share("x")).bitwiseOR(F.shiftleft(_morton(share("y")), 1)))
    dealt = order.numbered(curve, ["c", "x", "y", "v", "known", "g"], "i").withColumn("b", F.floor((F.col("i") - 1) / size)).drop("c", "i")
    dealt = shared.stored(dealt, "blocks")
    boxes = shared.stored(dealt.groupBy("b").agg(*[f(c).alias(f"{n}{c}") for c in "xy" for n, f in (("l", F.min), ("h", F.max))]), "boxes")
    gap = lambda c: F.greatest(F.col(f"q.l{c}") - F.col(f"p.h{c}"), F.col(f"p.l{c}") - F.col(f"q.h{c}"), F.lit(0.0))
    met = boxes.alias("p").crossJoin(boxes.alias("q")).where(F.col("p.b") <= F.col("q.b")).where(_apart(gap("x"), gap("y")) <= reach)  # a row a block
    met = shared.stored(met.select(F.col("p.b").alias("p"), F.col("q.b").alias("q")), "pairs")
    parts = max(1, min(met.count(), 8 * points.sparkSession.sparkContext.defaultParallelism))
    one = dealt.join(met.withColumnRenamed("p", "b").withColumn("p", F.col("b")), "b").withColumn("side", F.lit(0))
    two = dealt.join(met.where("p < q").withColumnRenamed("q", "b").withColumn("q", F.col("b")), "b").withColumn("side", F.lit(1))

    def summed(at: tuple, d: pd.DataFrame) -> pd.DataFrame:
        return _lag_sums(d[d["side"] == 0], d[d["side"] == 1], at[0] == at[1], lags, reach)

    both = one.drop("b").unionByName(two.drop("b")).repartition(parts, "p", "q")
    sums = both.groupBy("p", "q").applyInPandas(summed, "bin long, pairs long, far double, known long, semi double")
    bins = sums.groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("pairs", "far", "known", "semi")])
    return bins.select("bin", "pairs", (F.col("far") / F.col("pairs")).alias("lag"), F.when(F.col("known") > 0, F.col("semi") / F.col("known") / 2).alias("semivariance"))


#: Variogram models of lag, scale (sill or slope), reach (range or power) and nugget.
MODELS: dict[str, Callable[..., np.ndarray]] = {
    "linear": lambda h, s, r, n: s * h + n,
    "power": lambda h, s, r, n: s * h**r + n,
    "gaussian": lambda h, s, r, n: s * (1 - np.exp(-((h / (r * 4 / 7)) ** 2))) + n,
    "exponential": lambda h, s, r, n: s * (1 - np.exp(-h / (r / 3))) + n,
    "spherical": lambda h, s, r, n: np.where(h < r, s * (1.5 * h / r - 0.5 * (h / r) ** 3) + n, s + n),
}


def fit_variogram(lag: np.ndarray, semi: np.ndarray) -> tuple[str, tuple[float, float, float]]:
    """The model and parameters of least squared error: a grid over the reach, linear least squares for the rest (no negative part)."""
    best = (np.inf, "linear", (0.0, 1.0, 0.0))
    for name, f in MODELS.items():
        reaches = np.linspace(0.1, 1.9, 40) if name == "power" else np.linspace(lag.min(), 2 * lag.max(), 60)
        for r in reaches if name != "linear" else [1.0]:
            base = f(lag, 1.0, r, 0.0)
            for cols in (np.column_stack([base, np.ones_like(lag)]), base[:, None]):
                c = np.linalg.lstsq(cols, semi, rcond=None)[0]
                s, n = float(c[0]), float(c[1]) if len(c) > 1 else 0.0
                if s >= 0 and n >= 0 and (e := float(np.mean((f(lag, s, r, n) - semi) ** 2))) < best[0]:
                    best = (e, name, (s, float(r), n))
    return best[1], best[2]


def _lag_bins(x: np.ndarray, y: np.ndarray, v: np.ndarray, lags: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean distance and semivariance of the bins of ``variogram``, for the points of one layer."""
    i, j = np.triu_indices(len(v), 1)
    h, g = np.hypot(x[i] - x[j], y[i] - y[j]), (v[i] - v[j]) ** 2 / 2
    h, g = h[h <= reach], g[h <= reach]
    at = np.minimum(np.floor(h / (reach / lags)), lags - 1).astype(int)
    n = np.bincount(at, minlength=lags)
    have = n > 0
    return np.bincount(at, h, lags)[have] / n[have], np.bincount(at, g, lags)[have] / n[have]


def krige(cells: DataFrame, layer: list[str], x: str, y: str, value: str, model: str | None = None, params: tuple[float, float, float] | None = None, neighbours: int | None = None, lags: int = 8, reach: float = 8.0) -> DataFrame:
    """Ordinary kriging of the missing cells of each layer from all its observed cells, or from the nearest ``neighbours``.

    Without ``model`` and ``params`` each layer's variogram is fitted to its own
    cells, in ``lags`` bins up to ``reach``; a layer without a pair of observed
    cells in reach stays unfilled.  A layer is one Arrow group, so a layer is
    what a task must hold.
    """

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        have, miss = pdf[pdf[value].notna()], pdf[pdf[value].isna()]
        out = pdf.copy()
        out["filled"] = pdf[value]
        if len(have) < 2 or not len(miss):
            return out
        hx, hy, hv = (have[c].to_numpy(float) for c in (x, y, value))
        tx, ty = (miss[c].to_numpy(float) for c in (x, y))
        name, fitted = model, params
        if name is None or fitted is None:
            bins = _lag_bins(hx, hy, hv, lags, reach)
            if not len(bins[0]):
                return out
            name, fitted = fit_variogram(*bins)
        f = MODELS[name]

        def weighted(k: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
            n = len(k)
            a, b = np.ones((n + 1, n + 1)), np.ones((n + 1, len(px)))
            a[:n, :n] = f(np.hypot(hx[k][:, None] - hx[k], hy[k][:, None] - hy[k]), *fitted)
            np.fill_diagonal(a, 0.0)
            b[:n] = f(np.hypot(hx[k][:, None] - px, hy[k][:, None] - py), *fitted)
            return hv[k] @ np.linalg.lstsq(a, b, rcond=None)[0][:n]

        if neighbours is None or neighbours >= len(hv):
            out.loc[miss.index, "filled"] = weighted(np.arange(len(hv)), tx, ty)
        else:
            for i, px, py in zip(miss.index, tx, ty):
                k = np.argsort(np.hypot(hx - px, hy - py), kind="stable")[:neighbours]
                out.loc[i, "filled"] = float(weighted(k, np.array([px]), np.array([py]))[0])
        return out

    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in cells.schema) + ", filled double"
    return cells.groupBy(*layer).applyInPandas(solve, schema)


def in_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a ring (array of structs x, y) or on its border, by crossings; native, so it stays in the JVM.

    A point is on the border where it is an edge's end, or within an edge's
    box and the edge's cross product with it is nought as computed.
    """
    n = F.size(ring)

    def touches(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, 1).otherwise(i + 1))
        boxed = x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        return boxed & ((b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"]))

    def crosses(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, 1).otherwise(i + 1))
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] == a["y"], 1e-300).otherwise(b["y"] - a["y"]) + a["x"])

    sides = F.sequence(F.lit(1), n)
    return F.exists(sides, touches) | (F.size(F.filter(sides, crosses)) % 2 == 1)


def ring_metrics(ring: Column) -> tuple[Column, Column]:
    """Area (shoelace) and perimeter of a ring."""
    n = F.size(ring)
    ends = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, F.when(i == n, 1).otherwise(i + 1)).alias("b")))
    area = F.abs(F.aggregate(ends, F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2
    return area, F.aggregate(ends, F.lit(0.0), lambda s, e: s + F.hypot(e["a"]["x"] - e["b"]["x"], e["a"]["y"] - e["b"]["y"]))


def points_in_polygons(points: DataFrame, polygons: DataFrame, x: str, y: str, poly_id: str, ring: str, cell: float) -> DataFrame:
    """Each point with the smallest id of the polygons that hold it, border included, null if none: candidates by cells of the polygons' boxes."""
    xs, ys = F.transform(F.col(ring), lambda p: p["x"]), F.transform(F.col(ring), lambda p: p["y"])
    span = lambda v: F.sequence(F.floor(F.array_min(v) / cell), F.floor(F.array_max(v) / cell))
    q = polygons.select(poly_id, ring, F.explode(span(xs)).alias("_cx"), span(ys).alias("_ys")).select(poly_id, ring, "_cx", F.explode("_ys").alias("_cy"))
    p = points.select(x, y, *joins.cells(x, y, cell))
    hit = p.join(q, ["_cx", "_cy"]).where(in_polygon(F.col(x), F.col(y), F.col(ring)))
    first = hit.groupBy(x, y).agg(F.min(poly_id).alias(poly_id))
    return points.join(first, [x, y], "left")


def synthetic(minority: DataFrame, key: str, x: str, y: str, radius: float, seed: int = 0) -> DataFrame:
    """One new point for each point with a neighbour: between it and its nearest, at a share drawn by hash."""
    q = minority.select(F.col(key).alias("_b"), F.col(x).alias("_x2"), F.col(y).alias("_y2"))
    rows = minority.select(key, x, y).distinct()
    best = joins.nearest_2d(rows, q, [key, x, y], x, y, "_x2", "_y2", ["_b"], ["_x2", "_y2"], most=radius, other=(key, "_b")).where("distance is not null")
    u = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1000003)) / F.lit(1000003.0)
    return best.select(key, (F.col(x) + (F.col("_x2") - F.col(x)) * u).alias(x), (F.col(y) + (F.col("_y2") - F.col(y)) * u).alias(y))
