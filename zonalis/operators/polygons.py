"""Polygons: decoding, checks, repair, measures, interior points, and their pixels as scan-line runs.

A geometry travels as ``parts``: an array of polygons, each an array of closed
rings (the shell first), each an array of points.  Measures, interior points
and runs are column expressions; well-known binary, checks and repair work on one
geometry at a time in Arrow batches.  A geometry is never turned into a list of
its pixels: it becomes runs (row, first column, last column), and pixels meet
the runs by row and block of columns.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import zonal

POINT = "struct<x: double, y: double>"
PARTS = f"array<array<array<{POINT}>>>"
_RING = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
_PARTS = pa.list_(pa.list_(_RING))
#: Codes of well-known binary (fixed values of the format).
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
Rings = list[np.ndarray]


# --- well-known binary -----------------------------------------------------------------------------


def read_wkb(data: bytes) -> tuple[str, list[Rings]]:
    """Kind and polygonal parts (rings as n x 2 arrays); other parts are left out.  Heights and measures are skipped."""

    def geometry(at: int) -> tuple[str, list[Rings], int]:
        end = "<" if data[at] else ">"
        (code,) = struct.unpack_from(end + "I", data, at + 1)
        at += 9 if code & 0x20000000 else 5  # with a reference system's number
        width = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
        code &= 0xFFFFFFF
        width += {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
        kind, count = KINDS[code % 1000], lambda p: struct.unpack_from(end + "I", data, p)[0]

        def points(p: int, n: int) -> tuple[np.ndarray, int]:
            return np.frombuffer(data, end + "f8", n * width, p).reshape(n, width)[:, :2].astype(np.float64), p + 8 * n * width

        if kind == "Point":
            return kind, [], at + 8 * width
        n, at, parts = count(at), at + 4, []
        if kind == "LineString":
            return kind, [], points(at, n)[1]
        for _ in range(n):
            if kind == "Polygon":
                ring, at = points(at + 4, count(at))
                parts.append(ring)
            else:
                _, some, at = geometry(at)
                parts += some
        return kind, ([parts] if parts else []) if kind == "Polygon" else parts, at

    kind, parts, _ = geometry(0)
    return kind, parts


def write_wkb(parts: list[Rings]) -> bytes:
    """A Polygon of one part, else a MultiPolygon."""
    one = lambda rings: struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings)
    return one(parts[0]) if len(parts) == 1 else struct.pack("<BII", 1, 6, len(parts)) + b"".join(map(one, parts))


def _to_arrow(rows: list[list[Rings] | None]) -> pa.Array:
    return pa.array([None if p is None else [[[{"x": x, "y": y} for x, y in r.tolist()] for r in rings] for rings in p] for p in rows], _PARTS)


def _from_arrow(column: pa.Array) -> list[list[Rings] | None]:
    return [None if p is None else [[np.array([(q["x"], q["y"]) for q in r], np.float64).reshape(-1, 2) for r in rings or []] for rings in p] for p in column.to_pylist()]


def _each(df: DataFrame, column: str, added: dict[str, str], make: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``df`` with columns that ``make`` gets from one column's batch; Arrow moves the others untouched."""
    kept = [c for c in df.columns if c not in added]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(c, T.DataType.fromDDL(t)) for c, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *make(b.column(column))], names=[*kept, *added])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, wkb: str, kind: str = "kind", parts: str = "parts") -> DataFrame:
    """Adds ``kind`` (null for null, ``unreadable`` for bytes that are no geometry) and ``parts`` (the polygonal ones; null for null or unreadable)."""

    def make(column: pa.Array) -> list[pa.Array]:
        kinds, out = [], []
        for x in column.to_pylist():
            try:
                k, p = (None, None) if x is None else read_wkb(bytes(x))
            except (struct.error, KeyError, ValueError, IndexError):
                k, p = "unreadable", None
            kinds.append(k)
            out.append(p)
        return [pa.array(kinds, pa.string()), _to_arrow(out)]

    return _each(df, wkb, {kind: "string", parts: PARTS}, make)


def encode(df: DataFrame, parts: str = "parts", wkb: str = "wkb") -> DataFrame:
    """Adds the well-known binary of ``parts``."""
    return _each(df, parts, {wkb: "binary"}, lambda c: [pa.array([None if p is None else write_wkb(p) for p in _from_arrow(c)], pa.binary())])


# --- checks and repair -----------------------------------------------------------------------------


def _segments(rings: Rings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, ring and place in it of every segment of some length."""
    a, b = np.concatenate([r[:-1] for r in rings]), np.concatenate([r[1:] for r in rings])
    ring = np.repeat(np.arange(len(rings)), [len(r) - 1 for r in rings])
    some = (a != b).any(axis=1)
    a, b, ring = a[some], b[some], ring[some]
    return a, b, ring, np.arange(len(a)) - np.searchsorted(ring, ring)


def _side(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    return np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))


def _meeting(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A sweep along x: each segment with the later ones whose boxes meet its own and whose ends it doesn't keep on one side."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.argsort(low[:, 0], kind="stable")
    a, b, low, high = a[order], b[order], low[order], high[order]
    stop = np.searchsorted(low[:, 0], high[:, 0], "right")
    for i in range(len(a)):
        j = np.arange(i + 1, stop[i])
        j = j[(low[j, 1] <= high[i, 1]) & (high[j, 1] >= low[i, 1])]
        if len(j):
            s, t = _side(a[i], b[i], a[j]) * _side(a[i], b[i], b[j]), _side(a[j], b[j], a[i]) * _side(a[j], b[j], b[i])
            j = j[(s <= 0) & (t <= 0)]
            if len(j):
                yield int(order[i]), order[j]


def _within(point: np.ndarray, ring: np.ndarray) -> bool:
    x, y, u, v = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    over = (y <= point[1]) != (v <= point[1])
    return bool((over & (x + (point[1] - y) * (u - x) / np.where(over, v - y, 1) > point[0])).sum() % 2)


def problem(parts: list[Rings] | None) -> str | None:
    """What keeps a geometry from being valid; None if nothing does."""
    if parts is None:
        return "null"
    rings = [r for p in parts for r in p]
    if not rings or not any(len(r) for r in rings):
        return "empty"
    if not all(np.isfinite(r).all() for r in rings):
        return "not finite"
    if any(len(r) < 4 for r in rings):
        return "too few points"
    if any((r[0] != r[-1]).any() for r in rings):
        return "open ring"
    a, b, ring, place = _segments(rings)
    count = np.bincount(ring, minlength=len(rings))
    if (count < 3).any():
        return "too few points"
    shell = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    for i, j in _meeting(a, b):
        for k in j.tolist():
            ends = {tuple(a[i]), tuple(b[i])} & {tuple(a[k]), tuple(b[k])}
            flat = _side(a[i], b[i], a[k]) == 0 and _side(a[i], b[i], b[k]) == 0
            touch = bool(ends) or 0 in (_side(a[i], b[i], a[k]), _side(a[i], b[i], b[k]), _side(a[k], b[k], a[i]), _side(a[k], b[k], b[i]))
            if flat:  # on one line: more than a point in common is an overlap
                d = b[i] - a[i]
                t = sorted(float(((p - a[i]) @ d) / (d @ d)) for p in (a[k], b[k]))
                if min(t[1], 1) - max(t[0], 0) > 0:
                    return "self-intersection"
                if not ends:
                    continue
            if ring[i] == ring[k]:
                apart = (place[k] - place[i]) % count[ring[i]]
                if not (ends and apart in (1, count[ring[i]] - 1)):
                    return "self-intersection"
            elif not touch:
                return "self-intersection"
    for i in range(len(rings)):
        for j in range(len(rings)):
            if i == j:
                continue
            inner = [p for p in rings[i][:-1] if not any((q == p).all() for q in rings[j])][:1]
            if inner:
                into = _within(inner[0], rings[j])
                first_i, first_j = i == np.searchsorted(shell, shell[i]), j == np.searchsorted(shell, shell[j])
                if shell[i] == shell[j]:
                    if first_j and not into:
                        return "hole outside shell"
                    if not first_i and not first_j and into:
                        return "nested holes"
                elif first_i and first_j and into and not any(_within(inner[0], h) for h in parts[shell[j]][1:]):
                    return "nested shells"
    return None


def _area(ring: np.ndarray) -> float:
    d = ring - ring[0]
    return float((d[:-1, 0] * d[1:, 1] - d[1:, 0] * d[:-1, 1]).sum() / 2)


def repaired(parts: list[Rings] | None) -> list[Rings] | None:
    """The points that an odd number of the geometry's rings surrounds, as a valid geometry; None if there are none.

    Rings are cut where they meet; pieces that coincide in pairs cancel; every
    piece left then has the region on one side alone, and turning as sharply
    as possible at each corner strings them together to simple rings.
    """
    if not parts:
        return None
    rings = [np.vstack([r, r[:1]]) if len(r) and (r[0] != r[-1]).any() else r for p in parts for r in p]
    rings = [r for r in rings if len(r) >= 4 and np.isfinite(r).all()]
    if not rings:
        return None
    a, b, *_ = _segments(rings)
    cuts: list[list[np.ndarray]] = [[a[i], b[i]] for i in range(len(a))]
    # a crossing that falls, but for rounding, on a corner or on another crossing is that point
    grain = float(max(np.abs(a).max(), 1e-300)) * 1e-11
    near: dict[tuple[int, int], np.ndarray] = {}

    def point(q: np.ndarray) -> np.ndarray:
        x, y = (int(v) for v in np.round(q / grain))
        for u in (x, x - 1, x + 1):
            for v in (y, y - 1, y + 1):
                if (u, v) in near:
                    return near[u, v]
        near[x, y] = q
        return q

    for q in a:
        near[tuple(int(v) for v in np.round(q / grain))] = q
    for i, j in _meeting(a, b):
        for k in j.tolist():
            d, e, w = b[i] - a[i], b[k] - a[k], a[k] - a[i]
            cross = d[0] * e[1] - d[1] * e[0]
            if cross:
                p = point(a[i] + d * ((w[0] * e[1] - w[1] * e[0]) / cross))
                cuts[i].append(p)
                cuts[k].append(p)
            else:
                cuts[i] += [a[k], b[k]]
                cuts[k] += [a[i], b[i]]
    odd: set[tuple] = set()
    for i, points in enumerate(cuts):
        d = b[i] - a[i]
        on = sorted({(float((p - a[i]) @ d / (d @ d)), *p.tolist()) for p in points})
        on = [q[1:] for q in on if -1e-9 <= q[0] <= 1 + 1e-9]
        for p, q in zip(on, on[1:]):
            if p != q:
                odd ^= {(min(p, q), max(p, q))}
    if not odd:
        return None
    s, t = (np.array([e[i] for e in odd]) for i in (0, 1))
    # the side of the region: crossings of a ray from the middle of each piece, upwards or to the right
    out: dict[tuple, list[tuple]] = {}
    for p, q in zip(s, t):
        mid, d = (p + q) / 2, q - p
        x = 1 - (abs(d[0]) <= abs(d[1]))  # count along the axis that the piece runs less along
        c, o = (0, 1) if x == 0 else (1, 0)
        over = (s[:, o] <= mid[o]) != (t[:, o] <= mid[o])
        at = s[:, c] + (mid[o] - s[:, o]) * (t[:, c] - s[:, c]) / np.where(over, t[:, o] - s[:, o], 1)
        own = (s == p).all(axis=1) & (t == q).all(axis=1)
        inside = bool((over & ~own & (at > mid[c])).sum() % 2)  # just beyond the piece, along +c
        left = (-d[1], d[0])[c] > 0  # +c is on the left of p -> q
        frm, to = (tuple(p), tuple(q)) if inside == left else (tuple(q), tuple(p))
        out.setdefault(frm, []).append(to)
    found = []
    while out:
        start = next(iter(out))
        ring, seen, came = [start], {start: 0}, None
        while True:
            here = ring[-1]
            ways = out[here]
            if came is not None and len(ways) > 1:  # the sharpest turn to the left keeps rings simple
                back = np.arctan2(came[1] - here[1], came[0] - here[0])
                ways.sort(key=lambda w: (back - np.arctan2(w[1] - here[1], w[0] - here[0])) % (2 * np.pi))
            nxt = ways.pop(0)
            if not ways:
                del out[here]
            came = here
            k = seen.get(nxt)
            if k is not None:  # a closed ring: hand it over, go on from its corner
                found.append(np.array([*ring[k:], nxt]))
                for q in ring[k + 1 :]:
                    del seen[q]
                ring = ring[: k + 1]
                if k == 0:
                    break
                came = ring[-2]
            else:
                seen[nxt] = len(ring)
                ring.append(nxt)
    shells = sorted((r for r in found if _area(r) > 0), key=_area)
    polygons = [[r] for r in shells]
    for hole in (r for r in found if _area(r) < 0):
        mid = (hole[0] + hole[1]) / 2
        home = next((p for p in polygons if _within(mid, p[0])), None)
        if home is not None:
            home.append(hole)
    return polygons or None


def with_problem(df: DataFrame, parts: str = "parts", out: str = "problem") -> DataFrame:
    """Adds why ``parts`` are no valid geometry: null, empty, not finite, too few points, open ring, self-intersection, hole outside shell, nested holes, nested shells; null where they are."""
    return _each(df, parts, {out: "string"}, lambda c: [pa.array([problem(p) for p in _from_arrow(c)], pa.string())])


def repair(df: DataFrame, parts: str = "parts") -> DataFrame:
    """``parts`` made valid where they are not; null where nothing with an area is left."""
    return _each(df, parts, {parts: PARTS}, lambda c: [_to_arrow([p if problem(p) is None else repaired(p) for p in _from_arrow(c)])])


def prepared(df: DataFrame, id_: str, parts: str = "parts") -> DataFrame:
    """Repaired rows that have an area, ids as strings; a repeated or null id is an error when the plan runs."""
    some = repair(df.withColumn(id_, F.col(id_).cast("string")), parts).where(F.col(parts).isNotNull())
    n = F.count("*").over(Window.partitionBy(id_))
    bad = F.col(id_).isNull() | (n > 1)
    return some.withColumn("_ok", F.when(bad, F.raise_error(F.concat(F.lit(f"{id_} must be unique and not null: "), F.coalesce(id_, F.lit("null")))).cast("boolean")).otherwise(F.lit(True))).where("_ok").drop("_ok")


# --- parts and measures, as expressions ------------------------------------------------------------


def _edges(ring: Column) -> Column:
    """The segments of a ring."""
    return F.transform(F.when(F.size(ring) > 1, F.sequence(F.lit(1), F.size(ring) - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.get(ring, i - 1).alias("a"), F.get(ring, i).alias("b")))


def _let(x: Column, of: Callable[[Column], Column]) -> Column:
    """``of(x)`` with ``x`` computed once."""
    return F.get(F.transform(F.array(x), of), F.lit(0))


def _total(items: Column, of: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda s, e: s + of(e))


def ring_area(ring: Column) -> Column:
    """Positive for rings that turn to the left; measured from the ring's first point."""
    o = F.get(ring, F.lit(0))
    return _total(_edges(ring), lambda e: (e["a"]["x"] - o["x"]) * (e["b"]["y"] - o["y"]) - (e["b"]["x"] - o["x"]) * (e["a"]["y"] - o["y"])) / 2


def part_area(rings: Column) -> Column:
    """The shell's area less the holes'."""
    return 2 * F.abs(ring_area(F.get(rings, F.lit(0)))) - _total(rings, lambda r: F.abs(ring_area(r)))


def area(parts: Column) -> Column:
    return _total(parts, part_area)


def perimeter(parts: Column) -> Column:
    """Length of all rings."""
    return _total(F.flatten(parts), lambda r: _total(_edges(r), lambda e: F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"])))


def bounds(parts: Column) -> Column:
    """struct xmin, ymin, xmax, ymax."""
    p = F.flatten(F.flatten(parts))
    x, y = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
    return F.struct(F.array_min(x).alias("xmin"), F.array_min(y).alias("ymin"), F.array_max(x).alias("xmax"), F.array_max(y).alias("ymax"))


def centroid(parts: Column) -> Column:
    """struct x, y of the area; null without one."""
    o = F.get(F.get(F.get(parts, F.lit(0)), F.lit(0)), F.lit(0))

    def moment(c: str) -> Column:
        def ring(r: Column) -> Column:
            cross = lambda e: (e["a"]["x"] - o["x"]) * (e["b"]["y"] - o["y"]) - (e["b"]["x"] - o["x"]) * (e["a"]["y"] - o["y"])
            return _total(_edges(r), lambda e: (e["a"][c] + e["b"][c] - 2 * o[c]) * cross(e)) / 6 * F.signum(ring_area(r))

        return _total(parts, lambda rings: 2 * ring(F.get(rings, F.lit(0))) - _total(rings, ring))

    a = area(parts)
    return F.when(a > 0, F.struct((o["x"] + moment("x") / a).alias("x"), (o["y"] + moment("y") / a).alias("y")))


def largest_part(parts: Column) -> Column:
    """``parts`` with the part of most area alone (the first of equal ones)."""
    key = F.transform(parts, lambda p, i: F.struct(part_area(p).alias("a"), (-i).alias("i")))
    return F.when(F.size(parts) > 0, F.array(F.get(parts, -F.array_max(key)["i"]))).otherwise(parts)


def exploded(df: DataFrame, parts: str = "parts") -> DataFrame:
    """A row for each part, with its number; rows without parts stay, with null."""
    return df.select("*", F.posexplode_outer(parts).alias("part", "_p")).withColumn(parts, F.when(F.col("_p").isNotNull(), F.array("_p"))).drop("_p")


def interior_point(parts: Column) -> Column:
    """struct x, y inside the geometry: the middle of the widest stretch that a horizontal line has in common with a part.

    A part's line runs halfway between the vertices next below and above the
    middle of its box, so it meets no vertex.
    """

    def stretches(met: Column, line: Column) -> Column:
        pairs = F.when(F.size(met) > 1, F.sequence(F.lit(0), F.floor(F.size(met) / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(pairs, lambda k: F.struct((F.get(met, 2 * k + 1) - F.get(met, 2 * k)).alias("w"), (-F.get(met, 2 * k)).alias("left"), ((F.get(met, 2 * k) + F.get(met, 2 * k + 1)) / 2).alias("x"), line.alias("y")))

    def crossed(rings: Column, line: Column) -> Column:
        edges = F.filter(F.flatten(F.transform(rings, _edges)), lambda e: (e["a"]["y"] <= line) != (e["b"]["y"] <= line))
        met = F.array_sort(F.transform(edges, lambda e: e["a"]["x"] + (line - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"]) / (e["b"]["y"] - e["a"]["y"])))
        return _let(met, lambda m: stretches(m, line))

    def part(rings: Column) -> Column:
        ys = F.transform(F.flatten(rings), lambda q: q["y"])
        line = lambda y, mid: (F.array_max(F.filter(y, lambda v: v <= mid)) + F.array_min(F.filter(y, lambda v: v > mid))) / 2
        return _let(_let(ys, lambda y: _let((F.array_min(y) + F.array_max(y)) / 2, lambda mid: line(y, mid))), lambda at: crossed(rings, at))

    best = F.array_max(F.flatten(F.transform(parts, part)))  # the widest, then the leftmost
    return _let(best, lambda p: F.when(p.isNotNull(), F.struct(p["x"].alias("x"), p["y"].alias("y"))))


def contains(parts: Column, point: Column) -> Column:
    """Whether a point is inside by the crossings of a ray to the right; borders on the left and below count as inside."""
    edges = F.flatten(F.transform(F.flatten(parts), _edges))
    hits = F.filter(edges, lambda e: ((e["a"]["y"] <= point["y"]) != (e["b"]["y"] <= point["y"])) & (e["a"]["x"] + (point["y"] - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"]) / (e["b"]["y"] - e["a"]["y"]) > point["x"]))
    return F.size(hits) % 2 == 1


def to_point(parts: Column) -> Column:
    """The centroid where it lies inside, else an interior point."""
    c = centroid(parts)
    return F.when(c.isNotNull() & contains(parts, c), c).otherwise(interior_point(parts))


def duplicates(df: DataFrame, id_: str, wkb: str, parts: str = "parts") -> DataFrame:
    """The rows whose geometry stands more than once, with a point of it, by x, y and id."""
    key = F.sha2(wkb, 256)  # groups move a digest, not the geometry
    n = df.where(F.col(wkb).isNotNull()).groupBy(key.alias("_k")).agg(F.count("*").alias("_n")).where("_n > 1")
    some = df.withColumn("_k", key).join(n, "_k").withColumn("_p", to_point(F.col(parts)))
    return some.select(*df.columns, F.col("_p.x").alias("x"), F.col("_p.y").alias("y")).orderBy("x", "y", id_)


def _hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull, to the left."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def chain(rows) -> list:
        out: list = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    rows = p.tolist()
    return np.array(chain(rows) + chain(rows[::-1]))


def least_rectangle(points: np.ndarray) -> tuple[float, float]:
    """Long and short side of the rectangle of least area around the points; one of its sides lies on a side of the hull.

    Of rectangles whose areas differ by rounding alone, the one of the least long side.
    """
    hull = _hull(points)
    if len(hull) < 3:
        return (float(np.hypot(*(hull[-1] - hull[0]))) if len(hull) else 0.0), 0.0
    d = np.roll(hull, -1, axis=0) - hull
    d /= np.hypot(d[:, 0], d[:, 1])[:, None]
    # for a hull side's direction: the extents along it and across it, block by block
    sides = []
    for k in range(0, len(d), 256):
        along, across = hull @ d[k : k + 256].T, hull @ np.stack([-d[k : k + 256, 1], d[k : k + 256, 0]])
        sides.append(np.sort([np.ptp(along, axis=0), np.ptp(across, axis=0)], axis=0))
    short, long = np.concatenate(sides, axis=1)
    near = np.flatnonzero(short * long <= (short * long).min() * (1 + 1e-9))
    i = near[np.argmin(long[near])]
    return float(long[i]), float(short[i])


def with_rectangle(df: DataFrame, parts: str = "parts") -> DataFrame:
    """Adds ``long_side`` and ``short_side`` of the least rotated rectangle, and ``elongation`` (null without a short side)."""

    def make(column: pa.Array) -> list[pa.Array]:
        got = [None if not p else least_rectangle(np.concatenate([q[0] for q in p])) for p in _from_arrow(column)]
        return [pa.array([g and g[i] for g in got], pa.float64()) for i in (0, 1)]

    out = _each(df, parts, {"long_side": "double", "short_side": "double"}, make)
    return out.withColumn("elongation", F.when(F.col("short_side") > 0, F.col("long_side") / F.col("short_side")))


def tile_of(point: Column, west: float, north: float, width: float, cols: int, rows: int) -> Column:
    """The tile (row-major from the north-west, from 0) that owns a point: on a shared edge the lower one; null outside all."""
    x, y = (point["x"] - west) / width, (north - point["y"]) / width
    at = lambda v: F.greatest(F.ceil(v) - 1, F.lit(0)).cast("long")
    return F.when((x >= 0) & (x <= cols) & (y >= 0) & (y <= rows), at(y) * cols + at(x))


# --- pixels ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Grid:
    """A raster: its upper left corner, the size of a pixel, columns and rows (downwards)."""

    west: float
    north: float
    width: float
    height: float
    cols: int
    rows: int


def runs(df: DataFrame, ids: list[str], grid: Grid, parts: str = "parts", touched: bool = False) -> DataFrame:
    """``ids``, row, first, last: the geometry's pixels as runs of columns that neither meet nor overlap.

    By default the pixels whose centre is inside (a centre on a border counts
    with the pixels right of it and above); ``touched`` adds those that a
    border passes through.  Work and shuffles grow with borders times rows, not with areas.
    """
    px, py = lambda p: (p["x"] - grid.west) / grid.width, lambda p: (grid.north - p["y"]) / grid.height
    rings = df.select(*ids, F.posexplode(parts).alias("part", "_rings")).select(*ids, "part", F.explode("_rings").alias("_ring"))
    edges = rings.select(*ids, "part", F.explode(_edges(F.col("_ring"))).alias("e")).select(*ids, "part", px(F.col("e.a")).alias("x1"), py(F.col("e.a")).alias("y1"), px(F.col("e.b")).alias("x2"), py(F.col("e.b")).alias("y2"))
    edges = edges.withColumn("top", F.least("y1", "y2")).withColumn("low", F.greatest("y1", "y2"))
    x_at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))

    def by_row(first: Column, last: Column) -> DataFrame:
        a, b = F.greatest(first.cast("long"), F.lit(0)), F.least(last.cast("long"), F.lit(grid.rows - 1))
        return edges.withColumn("_a", a).withColumn("_b", b).where("_a <= _b").select("*", F.explode(F.sequence("_a", "_b")).alias("row"))

    inside = lambda d: d.select(*ids, "row", F.greatest("first", F.lit(0)).alias("first"), F.least("last", F.lit(grid.cols - 1)).alias("last")).where("first <= last")
    centres = by_row(F.ceil(F.col("top") - 0.5), F.ceil(F.col("low") - 0.5) - 1)
    line = Window.partitionBy(*ids, "part", "row").orderBy("x")
    met = centres.select(*ids, "part", "row", x_at(F.col("row") + 0.5).alias("x")).withColumn("k", F.row_number().over(line)).withColumn("to", F.lead("x").over(line))
    out = inside(met.where("k % 2 = 1").select(*ids, "row", F.ceil(F.col("x") - 0.5).cast("long").alias("first"), (F.ceil(F.col("to") - 0.5) - 1).cast("long").alias("last")))
    if touched:
        passed = by_row(F.floor("top"), F.floor("low"))
        a, b = x_at(F.greatest(F.col("top"), F.col("row").cast("double"))), x_at(F.least(F.col("low"), F.col("row") + 1.0))
        flat = F.col("y1") == F.col("y2")
        ends = F.when(flat, F.struct(F.least("x1", "x2").alias("a"), F.greatest("x1", "x2").alias("b"))).otherwise(F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))
        out = out.unionByName(inside(passed.withColumn("s", ends).select(*ids, "row", F.floor("s.a").cast("long").alias("first"), F.floor("s.b").cast("long").alias("last"))))
    order = Window.partitionBy(*ids, "row").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum((F.coalesce(reach, F.lit(-2)) + 1 < F.col("first")).cast("int")).over(order)
    return out.withColumn("_r", reach).withColumn("_g", group).groupBy(*ids, "row", "_g").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_g")


def pixels_of(runs_: DataFrame, ids: list[str], pixels: DataFrame, row: str = "row", col: str = "col", block: int = 64) -> DataFrame:
    """The pixels (columns of ``pixels``) inside each geometry's runs: rows meet by row and block of columns."""
    cut = runs_.select(*ids, F.col("row").alias("_row"), "first", "last", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor(F.col("last") / block))).alias("_block"))
    some = pixels.withColumn("_row", F.col(row).cast("long")).withColumn("_block", F.floor(F.col(col) / block))
    return some.join(cut, ["_row", "_block"]).where(F.col(col).between(F.col("first"), F.col("last"))).drop("_row", "_block", "first", "last")


def zonal_statistics(df: DataFrame, ids: list[str], grid: Grid, pixels: DataFrame, value: str, stats: list[str], parts: str = "parts", touched: bool = False) -> DataFrame:
    """A row per geometry: ``pixels`` (of its selection, observed or not), ``count`` (finite values) and ``stats``.

    A geometry outside the raster, or without parts, has an empty selection: noughts and nulls.
    """
    from ..sources import shared

    cells = shared.stored(runs(df, ids, grid, parts, touched), "runs")
    sizes = cells.groupBy(*ids).agg(F.sum(F.col("last") - F.col("first") + 1).alias("pixels"))
    got = zonal.pooled(pixels_of(cells, ids, pixels), ids, value, ["count", *stats])
    out = df.select(*ids).join(sizes, ids, "left").join(got, ids, "left")
    return out.withColumn("pixels", F.coalesce("pixels", F.lit(0).cast("long"))).withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
