"""Polygons against plain versions: decoding, checks, repair, interior points, rectangles, pixel runs."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.operators import polygons as P

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
BOW = [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]
ring = lambda points: np.array(points, np.float64)
part = lambda *rings: [ring(r) for r in rings]
shift = lambda points, x, y: [(a + x, b + y) for a, b in points]


def frame(spark, rows):
    """id, parts of plain lists."""
    return spark.createDataFrame([(i, None if p is None else [[[(float(x), float(y)) for x, y in r] for r in q] for q in p]) for i, p in rows], f"id string, parts {P.PARTS}")


def inside(point, parts):
    """Even-odd over all rings."""
    odd = False
    for r in (r for p in parts for r in p):
        for (x, y), (u, v) in zip(r[:-1], r[1:]):
            if (y <= point[1]) != (v <= point[1]) and x + (point[1] - y) * (u - x) / (v - y) > point[0]:
                odd = not odd
    return odd


def star(rng, n, cx=0.0, cy=0.0, least=1.0, most=3.0):
    at = sorted(rng.random() * 2 * math.pi for _ in range(n))
    out = [(cx + (r := rng.uniform(least, most)) * math.cos(a), cy + r * math.sin(a)) for a in at]
    return out + out[:1]


# --- decoding --------------------------------------------------------------------------------------


def wkb(kind, body, end="<", flags=0):
    return struct.pack(end + "BI", 1 if end == "<" else 0, kind | flags) + body


def points(pts, end="<", extra=0):
    return struct.pack(end + "I", len(pts)) + b"".join(struct.pack(f"{end}{2 + extra}d", *p, *[9.0] * extra) for p in pts)


def test_well_known_binary(spark):
    poly = lambda end, extra=0, kind=3, flags=0, srid=b"": wkb(kind, srid + struct.pack(end + "I", 2) + points(SQUARE, end, extra) + points(HOLE, end, extra), end, flags)
    multi = wkb(6, struct.pack("<I", 2) + poly("<") + poly(">"))
    mixed = wkb(7, struct.pack("<I", 4) + wkb(1, struct.pack("<2d", 1, 2)) + poly("<") + wkb(2, points(BOW)) + multi)
    rows = [
        ("a", poly("<")), ("b", poly(">")), ("c", poly("<", 1, 1003)), ("d", poly("<", 2, 3003)), ("e", poly("<", 1, 3, 0x80000000)), ("f", poly("<", 0, 3, 0x20000000, struct.pack("<I", 4326))), ("g", multi), ("h", mixed),
        ("i", wkb(1, struct.pack("<2d", 1, 2))), ("j", wkb(3, struct.pack("<I", 0))), ("k", None), ("l", b"\x01\x03"), ("m", b""), ("n", wkb(99, b"")),
    ]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in rows], "id string, wkb binary")
    got = {r.id: (r.kind, None if r.parts is None else [[[tuple(q) for q in x] for x in p] for p in r.parts]) for r in P.decode(df, "wkb").collect()}
    one = [SQUARE, HOLE]
    assert all(got[i] == ("Polygon", [one]) for i in "abcdef")
    assert got["g"] == ("MultiPolygon", [one, one]) and got["h"] == ("GeometryCollection", [one, one, one])
    assert got["i"] == ("Point", []) and got["j"] == ("Polygon", []) and got["k"] == (None, None)
    assert got["l"] == got["m"] == got["n"] == ("unreadable", None)
    again = P.decode(P.encode(P.decode(df, "wkb").where("size(parts) > 0").drop("wkb")), "wkb")
    assert {r.id: len(r.parts) for r in again.collect()} == {**{i: 1 for i in "abcdef"}, "g": 2, "h": 3}


# --- checks and repair -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "parts, want",
    [
        (None, "null"), ([], "empty"), ([[]], "empty"), ([part(SQUARE)], None), ([part(SQUARE, HOLE)], None), ([part(BOW)], "self-intersection"), ([part(SQUARE[:-1])], "open ring"), ([part(SQUARE[:2] + SQUARE[:1])], "too few points"),
        ([part([(0, 0), (1, 0), (1, 0), (0, 0)])], "too few points"), ([part([(0, 0), (1, math.nan), (1, 1), (0, 0)])], "not finite"), ([part(SQUARE, shift(HOLE, 9, 9))], "hole outside shell"), ([part(SQUARE, shift(HOLE, 2.5, 0))], "self-intersection"),
        ([part(SQUARE, [(0.5, 0.5), (0.5, 3.5), (3.5, 3.5), (3.5, 0.5), (0.5, 0.5)], HOLE)], "nested holes"), ([part(SQUARE), part(HOLE)], "nested shells"), ([part(SQUARE), part(shift(SQUARE, 9, 0))], None), ([part(SQUARE), part(shift(SQUARE, 4, 4))], None),
        ([part(SQUARE), part(shift(SQUARE, 4, 0))], "self-intersection"), ([part(SQUARE, HOLE), part([(1.2, 1.2), (1.8, 1.2), (1.8, 1.8), (1.2, 1.2)])], None), ([part([(0, 0), (4, 0), (2, 0), (2, 3), (0, 0)])], "self-intersection"),
        ([part([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)])], "self-intersection"), ([part(SQUARE, [(0, 0), (1, 2), (2, 1), (0, 0)])], None),
    ],
)
def test_problems(parts, want):
    assert P.problem(parts) == want


def test_repair_keeps_what_an_odd_number_of_rings_surrounds():
    rng = random.Random(4)
    cases = [[part(BOW)], [part(SQUARE), part(shift(SQUARE, 2, 2))], [part(SQUARE), part(shift(SQUARE, 4, 0))], [part(SQUARE), part(SQUARE), part(HOLE)], [part([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)])], [part([(0, 0), (4, 0), (2, 0), (2, 3), (0, 0)])], [part(SQUARE[:-1])]]
    for _ in range(60):
        n = rng.randint(4, 14)
        r = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(n)]
        if rng.random() < 0.4:  # whole numbers: corners and borders coincide
            r = [(float(round(x)), float(round(y))) for x, y in r]
        cases.append([part(r + r[:1])] + ([part(shift(SQUARE, 2, 3), shift(HOLE, 2, 3))] if rng.random() < 0.5 else []))
    for parts in cases:
        got = P.repaired(parts)
        closed = [[r if (r[0] == r[-1]).all() else np.vstack([r, r[:1]]) for r in p] for p in parts]
        for _ in range(200):
            at = (rng.uniform(-1, 10), rng.uniform(-1, 10))
            assert inside(at, closed) == bool(got and inside(at, got))
        if got:
            assert P.problem(got) is None, (parts, got)
    assert sum(abs(P._area(p[0])) for p in P.repaired([part(BOW)])) == pytest.approx(8)
    assert P.repaired([part([(0, 0), (4, 0), (0, 0), (4, 0), (0, 0)])]) is None and P.repaired(None) is None and P.repaired([]) is None


def test_preparation(spark):
    rows = [("1", [[SQUARE, HOLE]]), ("2", [[BOW]]), ("3", []), ("4", None)]
    got = {r.id: r for r in P.prepared(frame(spark, rows), "id").withColumn("a", P.area(F.col("parts"))).collect()}
    assert sorted(got) == ["1", "2"] and got["1"].a == 15 and got["2"].a == pytest.approx(8) and len(got["2"].parts) == 2
    for bad in ([("1", [[SQUARE]]), ("1", [[SQUARE]])], [(None, [[SQUARE]])]):
        with pytest.raises(Exception, match="unique"):
            P.prepared(frame(spark, bad), "id").collect()


# --- measures, points, rectangles ------------------------------------------------------------------


def test_measures_and_points(spark):
    u = [(0, 0), (9, 0), (9, 9), (6, 9), (6, 2), (3, 2), (3, 9), (0, 9), (0, 0)]  # the centroid lies outside
    rows = [("s", [[SQUARE, HOLE]]), ("u", [[u]]), ("two", [[HOLE], [shift(SQUARE, 10, 0)]]), ("cw", [[SQUARE[::-1]]]), ("none", []), ("null", None)]
    df = frame(spark, rows).withColumns({"a": P.area(F.col("parts")), "l": P.perimeter(F.col("parts")), "c": P.centroid(F.col("parts")), "p": P.to_point(F.col("parts")), "i": P.interior_point(F.col("parts")), "b": P.largest_part(F.col("parts"))})
    got = {r.id: r for r in df.collect()}
    assert (got["s"].a, got["s"].l) == (15, 20) and tuple(got["s"].c) == pytest.approx(((32 - 1.5) / 15, (32 - 1.5) / 15))
    assert not inside(tuple(got["u"].c), [part(u)]) and inside(tuple(got["u"].p), [part(u)])
    assert got["two"].a == 17 and [tuple(q) for q in got["two"].b[0][0]] == shift(SQUARE, 10, 0) and tuple(got["cw"].c) == (2, 2)
    assert got["none"].p is None and got["null"].p is None and got["none"].a == 0 and got["null"].a is None and got["null"].b is None
    rng = random.Random(8)
    stars = [(str(k), [[star(rng, rng.randint(3, 12)), [(x * 0.2, y * 0.2) for x, y in star(rng, 4, least=0.5, most=1)]]]) for k in range(40)]
    for r in frame(spark, stars).select("parts", P.interior_point(F.col("parts")).alias("p")).collect():
        assert inside(tuple(r.p), [[[tuple(q) for q in x] for x in p] for p in r.parts])


def test_tiles_own_points_once(spark):
    at = [(0.0, 10.0), (5.0, 5.0), (5.0, 10.0), (10.0, 0.0), (5.1, 4.9), (10.1, 3.0), (-0.1, 3.0)]
    df = spark.createDataFrame([(p,) for p in at], f"p {P.POINT}")
    assert [r[0] for r in df.select(P.tile_of(F.col("p"), 0.0, 10.0, 5.0, 2, 2)).collect()] == [0, 0, 0, 3, 3, None, None]


def test_least_rectangles():
    rng = np.random.default_rng(2)
    for n in (3, 4, 7, 40, 600):
        p = rng.normal(size=(n, 2)) * (3, 1)
        long, short = P.least_rectangle(p)
        best = math.inf
        for a in p if n < 50 else []:
            for b in p:
                if (d := np.hypot(*(b - a))) > 0:
                    u = (b - a) / d
                    best = min(best, np.ptp(p @ u) * np.ptp(p @ np.array([-u[1], u[0]])))
        turned = min(np.ptp(p @ np.array([math.cos(t), math.sin(t)])) * np.ptp(p @ np.array([-math.sin(t), math.cos(t)])) for t in np.linspace(0, math.pi / 2, 2000))
        assert long * short <= turned * (1 + 1e-9) and (n >= 50 or long * short == pytest.approx(best))
        assert n < 50 or long * short == pytest.approx(turned, rel=1e-2)
    assert P.least_rectangle(ring([(0, 0), (3, 4)])) == (5, 0) and P.least_rectangle(ring([(1, 1)])) == (0, 0)


# --- pixels ----------------------------------------------------------------------------------------


def plain_pixels(parts, grid, touched):
    out = set()
    px = [[[((x - grid.west) / grid.width, (grid.north - y) / grid.height) for x, y in r] for r in p] for p in parts]
    for r in range(grid.rows):
        for c in range(grid.cols):
            if any(inside((c + 0.5, r + 0.5), [p]) for p in px):
                out.add((r, c))
    if touched:  # a fine walk along the borders
        for p in (p for q in px for p in q):
            for (x, y), (u, v) in zip(p[:-1], p[1:]):
                for t in np.linspace(0, 1, 4001):
                    c, r = math.floor(x + t * (u - x)), math.floor(y + t * (v - y))
                    if 0 <= r < grid.rows and 0 <= c < grid.cols:
                        out.add((r, c))
    return out


@pytest.mark.parametrize("touched", [False, True])
def test_runs_equal_pixel_tests(spark, touched):
    grid, rng = P.Grid(-10.0, 12.0, 0.7, 1.1, 30, 19), random.Random(6)
    rows = [(str(k), [[star(rng, rng.randint(3, 9), rng.uniform(-9, 9), rng.uniform(-7, 11), 0.3, 6)]]) for k in range(12)]
    rows += [("hole", [[shift(SQUARE, 0.05, 0.05), shift(HOLE, 0.05, 0.05)]]), ("parts", [[shift(SQUARE, -9.03, 2.02)], [shift(SQUARE, -7.03, 3.02)]]), ("far", [[shift(SQUARE, 90, 0)]]), ("none", []), ("null", None)]
    got, seen = {}, {}
    for r in P.runs(frame(spark, rows), ["id"], grid, touched=touched).collect():
        assert r.first <= r.last
        seen.setdefault((r.id, r.row), []).append((r.first, r.last))
        got.setdefault(r.id, set()).update((r.row, c) for c in range(r.first, r.last + 1))
    for spans in seen.values():  # runs of a row leave a gap
        spans.sort()
        assert all(b[0] > a[1] + 1 for a, b in zip(spans, spans[1:]))
    for k, parts in rows:
        want, have = plain_pixels(parts or [], grid, touched), got.get(k, set())
        assert want <= have if touched else want == have
        assert len(have - want) <= 2  # the walk's steps may pass a corner by


def test_zonal_statistics(spark):
    grid = P.Grid(0.0, 10.0, 1.0, 1.0, 10, 10)
    df = frame(spark, [("a", [[[(0, 10), (3, 10), (3, 8), (0, 8), (0, 10)]]]), ("b", [[[(50, 50), (51, 50), (51, 51), (50, 50)]]]), ("c", None)])
    pixels = spark.createDataFrame([(r, c, float(10 * r + c) if (r, c) != (1, 1) else float("nan")) for r in range(3) for c in range(5) if (r, c) != (0, 2)], "row int, col int, v double")
    got = {r.id: r for r in P.zonal_statistics(df, ["id"], grid, pixels, "v", ["mean", "max", "sd"]).collect()}
    assert (got["a"].pixels, got["a"]["count"], got["a"].mean, got["a"].max) == (6, 4, (0 + 1 + 10 + 12) / 4, 12)
    assert all((got[k].pixels, got[k]["count"], got[k].mean) == (0, 0, None) for k in "bc")


def test_a_wide_polygon_stays_runs(spark):
    """A million pixels are a thousand runs."""
    big = frame(spark, [("big", [[[(0, 0), (1000, 0), (1000, 1000), (0, 1000), (0, 0)]]])])
    got = P.runs(big, ["id"], P.Grid(0.0, 1000.0, 1.0, 1.0, 1000, 1000))
    assert got.agg(F.count("*"), F.sum(F.col("last") - F.col("first") + 1)).first()[:] == (1000, 1_000_000)
