"""The chain of fills and the interpolations against plain computations."""

import random

import pytest

from zonalis.operators import filling


def cube(seed, gaps):
    rng = random.Random(seed)
    return {(t, y, x): None if rng.random() < gaps or (t < 3 and y < 4 and x < 4) else float(rng.randint(0, 40)) for t in range(4) for y in range(6) for x in range(7)}


def plain(c, windows):
    out = {k: (v, "observed" if v is not None else None) for k, v in c.items()}
    for (t, y, x), v in c.items():
        if v is None:
            p, q = c.get((t - 1, y, x)), c.get((t + 1, y, x))
            f = (p + q) / 2 if p is not None and q is not None else p if p is not None else q
            out[t, y, x] = (f, None if f is None else "temporal")
    for w in windows:
        old, r = dict(out), w // 2
        for (t, y, x), (v, _) in old.items():
            near = [old[t, b, a][0] for b in range(max(0, y - r), min(6, y + r + 1)) for a in range(max(0, x - r), min(7, x + r + 1))] if v is None else []
            near = [n for n in near if n is not None]
            if near:
                out[t, y, x] = (sum(near) / len(near), f"spatial_{w}")
    return out


def last(out, reach, how):
    res = dict(out)
    for (t, y, x), (v, _) in out.items():
        if v is None:
            near = [(((y - b) ** 2 + (x - a) ** 2) ** 0.5, b, a, n) for (u, b, a), (n, _) in out.items() if u == t and n is not None]
            near = [n for n in near if reach is None or n[0] <= reach]
            if near:
                res[t, y, x] = (min(near)[3] if how == "nearest" else sum(n[3] / n[0] for n in near) / sum(1 / n[0] for n in near), "interpolated")
    return res


@pytest.mark.parametrize("method,reach", [("nearest", None), ("nearest", 1.0), ("idw", 2.5), (None, None)])
def test_chain_equals_plain_fills(spark, method, reach):
    c = cube(3, 0.55)
    df = spark.createDataFrame([(*k, v, "n") for k, v in c.items()], "t int, y int, x int, v double, note string")
    got = filling.chain(df, [], "t", "y", "x", "v", (3,), windows=(3,), method=method, distance=reach).collect()
    want = plain(c, (3,))
    want = last(want, reach, method) if method else want
    assert {(r.t, r.y, r.x): (r.filled, r.source) for r in got} == {k: (pytest.approx(v) if v is not None else None, s) for k, (v, s) in want.items()}
    assert all(r.v == c[r.t, r.y, r.x] and r.note == "n" for r in got)
    if method is None:
        assert any(r.source is None for r in got)


def test_kriging_of_a_ramp(spark):
    rows = [(0, y, x, None if (y, x) in ((2, 2), (4, 3)) else float(2 * x + y)) for y in range(6) for x in range(6)]
    got = filling.interpolate(spark.createDataFrame(rows, "t int, y int, x int, v double"), ["t"], "y", "x", "v", "kriging", 4.0, lags=4).collect()
    assert {(r.y, r.x): r.filled for r in got}[2, 2] == pytest.approx(6, abs=0.3)


def test_chain_stops_and_checks(spark):
    full = spark.createDataFrame([(0, 0, 0, 1.0), (1, 0, 0, 2.0)], "t int, y int, x int, v double")
    assert [r.source for r in filling.chain(full, [], "t", "y", "x", "v", method="nearest").collect()] == ["observed"] * 2
    assert filling.chain(full.where("false"), [], "t", "y", "x", "v", method="nearest").count() == 0
    none = full.selectExpr("t", "y", "x", "cast(null as double) v")
    assert [r.filled for r in filling.chain(none, [], "t", "y", "x", "v", windows=(3,), method="nearest").collect()] == [None, None]
    for bad in (("cubic", 1.0, 8), ("idw", None, 8), ("nearest", -1.0, 8), ("kriging", 2.0, 0)):
        with pytest.raises(ValueError):
            filling.check_interpolation(*bad)
    with pytest.raises(ValueError):
        filling.chain(full.withColumnRenamed("v", "filled"), [], "t", "y", "x", "filled")
