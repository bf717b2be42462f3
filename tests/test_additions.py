"""Normality tests, resampling, calibration, publishing, cubes and strict intervals against plain versions."""

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.functions import special
from zonalis.operators import calibration, joins, normality, resample
from zonalis.operators.polygons import Grid
from zonalis.sources import cubes, publish

#: Weights of eleven men, with the results that are published for them.
WEIGHTS = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


# --- normality -------------------------------------------------------------------------------------


def test_normal_quantiles(spark):
    p = [1e-300, 1e-20, 1e-9, 0.001, 0.0749, 0.075, 0.3, 0.5, 0.51, 0.925, 0.93, 0.99, 1 - 1e-9, 0.0, 1.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").select(special.normal_quantile_column(F.col("p"))).collect()]
    assert got[-2:] == [None, None]
    assert got[:-2] == pytest.approx([NormalDist().inv_cdf(x) for x in p[:-2]], rel=1e-13, abs=1e-15)


def test_published_normality_results(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(WEIGHTS)] + [(99, None), (98, float("nan"))], "id long, v double")
    got = normality.tests(df, "v", "id")
    assert got["sample_size"] == 11 and got["normality_hint"] == "likely_not_normal"
    assert got["shapiro_statistic"] == pytest.approx(0.78881, abs=2e-5) and got["shapiro_pvalue"] == pytest.approx(0.006704, abs=5e-6)
    assert normality.skew_z(*_moments(WEIGHTS)[:1], 11) == pytest.approx(2.7788579769903414) and normality.kurtosis_z(_moments(WEIGHTS)[1], 11) == pytest.approx(2.3048235214240873)
    assert got["dagostino_statistic"] == pytest.approx(13.034263121192582) and got["dagostino_pvalue"] == pytest.approx(math.exp(-13.034263121192582 / 2))


def _moments(x):
    m = sum(x) / len(x)
    m2, m3, m4 = (sum((v - m) ** k for v in x) / len(x) for k in (2, 3, 4))
    return m3 / m2**1.5, m4 / m2**2


@pytest.mark.parametrize("n", [3, 4, 5, 6, 9, 40, 700])
def test_statistics_equal_plain_sums(spark, n):
    rng = random.Random(n)
    x = [rng.gauss(3, 2) if n < 700 else rng.expovariate(1) for _ in range(n)]
    got = normality.tests(spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id long, v double"), "v", None, None)
    s, mean = sorted(x), sum(x) / n
    m = [NormalDist().inv_cdf((i + 1 - 0.375) / (n + 0.25)) for i in range(n)]
    mm, u = sum(v * v for v in m), 1 / math.sqrt(n)
    a = list(m)
    last = m[-1] / math.sqrt(mm) + 0.221157 * u - 0.147981 * u**2 - 2.071190 * u**3 + 4.434685 * u**4 - 2.706056 * u**5
    before = m[-2] / math.sqrt(mm) + 0.042981 * u - 0.293762 * u**2 - 1.752461 * u**3 + 5.682633 * u**4 - 3.582633 * u**5
    if n == 3:
        a = [-math.sqrt(0.5), 0, math.sqrt(0.5)]
    elif n <= 5:
        e = (mm - 2 * m[-1] ** 2) / (1 - 2 * last**2)
        a = [-last, *(v / math.sqrt(e) for v in m[1:-1]), last]
    else:
        e = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * before**2)
        a = [-last, -before, *(v / math.sqrt(e) for v in m[2:-2]), before, last]
    w = sum(c * v for c, v in zip(a, s)) ** 2 / sum((v - mean) ** 2 for v in s)
    assert got["shapiro_statistic"] == pytest.approx(w) and 0 <= got["shapiro_pvalue"] <= 1
    if n < 8:
        assert got["anderson_statistic"] is None
        return
    sd = math.sqrt(sum((v - mean) ** 2 for v in s) / (n - 1))
    cdf = [NormalDist().cdf((v - mean) / sd) for v in s]
    a2 = -n - sum((2 * i + 1) * (math.log(cdf[i]) + math.log(1 - cdf[n - 1 - i])) for i in range(n)) / n
    assert got["anderson_statistic"] == pytest.approx(a2)
    assert (got["normality_hint"] == "likely_normal") == (n < 700) and (got["anderson_pvalue"] > 0.02) == (n < 700)


def test_columns_without_a_test(spark):
    df = spark.createDataFrame([(i, 5.0, None, float(i)) for i in range(20)], "id long, same double, none double, some double")
    got = {r["column"]: r for r in normality.table(df, ["same", "none", "some"], "id", 12).collect()}
    assert got["same"].shapiro_statistic is None and got["none"].sample_size == 0 and got["some"].sample_size == 12 and got["some"].shapiro_statistic > 0.8
    assert [normality.anderson_p(x, 10**9) for x in (0.1, 0.631, 9.0)] == pytest.approx([0.15, 0.1, 0.01])


# --- rasters ---------------------------------------------------------------------------------------


def test_bilinear_keeps_a_ramp(spark):
    source, target = Grid(0.0, 100.0, 10.0, 10.0, 10, 10), Grid(-5.0, 103.0, 4.0, 4.0, 30, 28)
    ramp = [(k, r, c, 2.0 * (10 * c + 5) - 3.0 * (100 - 10 * r - 5) + k) for k in (1, 2) for r in range(10) for c in range(10)]
    df = spark.createDataFrame(ramp, "k long, row long, col long, v double")
    got = {(x.k, x.row, x.col): x.v for x in resample.resample(df, source, target, "v", ["k"]).collect()}
    for k, r, c in [(1, 10, 10), (2, 10, 10), (2, 13, 7)]:  # inside, the ramp itself
        assert got[k, r, c] == pytest.approx(2.0 * (-5 + 4 * c + 2) - 3.0 * (103 - 4 * r - 2) + k)
    assert (1, 0, 0) not in got and (1, 10, 27) not in got  # centres outside
    near = {(x.row, x.col): x.v for x in resample.resample(df.where("k = 1"), source, target, "v", method="near").collect()}
    assert near[2, 3] == 2.0 * 5 - 3.0 * 95 + 1 and len(near) == 25 * 25
    with pytest.raises(ValueError, match="method"):
        resample.resample(df, source, target, "v", method="cubic")


def test_gaps_share_their_weight(spark):
    source, target = Grid(0.0, 2.0, 1.0, 1.0, 2, 2), Grid(0.75, 1.25, 0.5, 0.5, 1, 1)
    full = [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 4.0), (1, 1, 8.0)]
    for gone in range(5):
        rows = [(r, c, None if i == gone else v) for i, (r, c, v) in enumerate(full)]
        got = resample.resample(spark.createDataFrame(rows, "row long, col long, v double"), source, target, "v").collect()
        kept = [v for _, _, v in rows if v is not None]
        assert got[0].v == pytest.approx(sum(kept) / len(kept))
    none = spark.createDataFrame([(0, 0, None)], "row long, col long, v double")
    assert resample.resample(none, source, target, "v").count() == 0


def test_intervals_can_be_strict(spark):
    left = spark.createDataFrame([(1, 5.0), (2, 9.0)], "id long, t double")
    right = spark.createDataFrame([(0.0, 5.0, "a"), (5.0, 9.0, "b")], "s double, e double, name string")
    assert [(r.id, r.name) for r in joins.interval(left, right, "t", "s", "e", 5.0).collect()] == [(1, "b")]
    assert [(r.id, r.name) for r in joins.interval(left.where("id = 1"), right, "t", "s", "e", 5.0, strict=True).select("id", "name").collect()] == [(1, "b")]
    with pytest.raises(Exception, match="outside all intervals: 9.0"):
        joins.interval(left, right, "t", "s", "e", 5.0, strict=True).collect()


# --- calibration -----------------------------------------------------------------------------------


def plain_platt(score, hit):
    n1, n0 = sum(hit), len(hit) - sum(hit)
    t = np.where(hit, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    s, a, b = np.array(score), 0.0, math.log((n0 + 1) / (n1 + 1))
    f = lambda a, b: float(np.sum(t * (a * s + b) + np.logaddexp(0, -(a * s + b))))
    for _ in range(2000):  # descent with backtracking, nothing of Newton
        p = 1 / (1 + np.exp(a * s + b))
        g, step = np.array([np.sum((t - p) * s), np.sum(t - p)]), 1.0
        scale = np.array([1 / (np.sum(s * s) / 4 + 1e-9), 4 / len(s)])
        while f(*(np.array([a, b]) - step * scale * g)) > f(a, b) and step > 1e-12:
            step /= 2
        a, b = np.array([a, b]) - step * scale * g
    return a, b


def test_sigmoids_equal_plain_descent(spark):
    rng, rows = random.Random(2), []
    for i in range(240):
        c = "abc"[min(2, int(rng.random() * 3.5))]
        rows += [(i, k, rng.gauss(1.2 if k == c else -0.4, 1), k == c) for k in "abc"]
    df = spark.createDataFrame(rows, "row long, class string, score double, hit boolean")
    got = calibration.sigmoids(df)
    for k in "abc":
        want = plain_platt([r[2] for r in rows if r[1] == k], [r[3] for r in rows if r[1] == k])
        assert got[k] == pytest.approx(want, abs=1e-6)
    p = {(r.row, r["class"]): r.p for r in calibration.probabilities(df.drop("hit"), got).collect()}
    for i in range(0, 240, 17):
        s = {k: 1 / (1 + math.exp(got[k][0] * v + got[k][1])) for r, k, v, _ in rows if r == i}
        assert [p[i, k] for k in "abc"] == pytest.approx([s[k] / sum(s.values()) for k in "abc"])


def test_calibration_of_hard_cases(spark):
    apart = [(i, k, 5.0 if (k == "a") == (i < 10) else -5.0, (k == "a") == (i < 10)) for i in range(20) for k in "ab"]  # without error
    got = calibration.sigmoids(spark.createDataFrame(apart, "row long, class string, score double, hit boolean"))
    assert all(1 / (1 + math.exp(a * 5 + b)) == pytest.approx(11 / 12, abs=1e-6) for a, b in got.values())
    lone = spark.createDataFrame([(0, "a", 900.0, True), (0, "b", -900.0, False), (1, "a", 1.0, False), (1, "b", 2.0, True)], "row long, class string, score double, hit boolean")
    assert calibration.sigmoids(lone) is None and calibration.sigmoids(lone.limit(0)) is None
    p = {(r.row, r["class"]): r.p for r in calibration.probabilities(lone.drop("hit"), None).collect()}
    assert p[0, "a"] == 1 and p[1, "b"] == pytest.approx(math.e / (1 + math.e))
    zero = calibration.probabilities(lone.drop("hit"), {"a": (0.0, 1000.0), "b": (0.0, 1000.0)}).collect()
    assert all(r.p == 0.5 for r in zero)


# --- publishing ------------------------------------------------------------------------------------


def test_publish_once_and_resume(spark, tmp_path):
    path, source, made = f"{tmp_path}/out", spark.range(10), []

    def make():
        made.append(1)
        return source.select(F.col("id"), (F.col("id") * 2).alias("v"))

    run = lambda **o: publish.publish(spark, path, ["id"], make, [source], source, **o)
    report = lambda d: d.agg(F.count("*").alias("n"))
    with pytest.raises(publish.NotPublished):
        publish.published(spark, path)
    assert run(report=report).count() == 10 and run().agg(F.sum("v")).first()[0] == 90 and len(made) == 1
    m = publish.manifest(spark, path)
    assert m["rows"] == 10 and spark.read.parquet(f"{path}/{m['report']}").first().n == 10
    with pytest.raises(FileExistsError):
        run(options={"k": 2})
    run(options={"k": 2}, overwrite=True)
    assert len(made) == 2 and publish.published(spark, path).count() == 10 and publish.manifest(spark, path)["data"] != m["data"]
    assert not (tmp_path / "out" / m["data"]).exists() and not [f for f in (tmp_path / "out").iterdir() if f.name.endswith(".partial")]


def test_a_run_that_dies_leaves_nothing_readable(spark, tmp_path, monkeypatch):
    path, source = f"{tmp_path}/out", spark.range(10)
    monkeypatch.setattr(publish, "_write", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, path, ["id"], lambda: source, [source])
    with pytest.raises(publish.NotPublished):
        publish.published(spark, path)
    monkeypatch.undo()
    assert publish.publish(spark, path, ["id"], lambda: source, [source]).count() == 10


@pytest.mark.parametrize("rows, said", [([0, 1], "lost \\[2\\]"), ([0, 1, 2, 2], "repeated \\[2\\]"), ([0, 1, 2, 3], "unexpected \\[3\\]")])
def test_keys_must_match(spark, tmp_path, rows, said):
    with pytest.raises(ValueError, match=said):
        publish.publish(spark, f"{tmp_path}/out", ["id"], lambda: spark.createDataFrame([(i,) for i in rows], "id long"), [], spark.range(3))
    with pytest.raises(publish.NotPublished):
        publish.published(spark, f"{tmp_path}/out")


def test_parts_are_merged_whole(spark, tmp_path):
    for k in range(3):
        publish.publish(spark, f"{tmp_path}/p{k}", ["id"], lambda k=k: spark.range(4 * k, 4 * k + 4))
    paths = {k: f"{tmp_path}/p{k}" for k in range(3)}
    assert publish.merged(spark, paths, spark.range(12), ["id"]).groupBy("partition_number").count().count() == 3
    with pytest.raises(ValueError, match="lost"):
        publish.merged(spark, paths, spark.range(13), ["id"])
    m = publish.manifest(spark, paths[0])
    spark.range(1).write.mode("append").parquet(f"{paths[0]}/{m['data']}")  # tampered with
    with pytest.raises(ValueError, match="other keys"):
        publish.published(spark, paths[0])


# --- cubes -----------------------------------------------------------------------------------------


def test_cube_round_trip(spark, tmp_path):
    rng = random.Random(9)
    rows = [(p, v, y, x, None if rng.random() < 0.2 else float(np.float32(rng.random())), rng.random() < 0.5, rng.random() < 0.5) for p in ("20240101", "20240201") for v in ("NDVI", "B04") for y in range(-3, 20) for x in range(13) if (y, x) != (5, 5)]
    schema = "period string, variable string, y long, x long, cleaned float, observed boolean, temporal boolean"
    cubes.write(spark.createDataFrame(rows, schema), f"{tmp_path}/cube", 8)
    got = sorted(tuple(r) for r in cubes.read(spark, f"{tmp_path}/cube").select(*[c.split()[0] for c in schema.split(", ")]).collect())
    assert got == sorted(r for r in rows if r[4] is not None)
    some = cubes.read(spark, f"{tmp_path}/cube", ["20240201"], ["B04"], (2, 9), (5, 11), missing=True).collect()
    assert {(r.y, r.x) for r in some} == {(y, x) for y in range(2, 9) for x in range(5, 11)}
    want = {(y, x): (v, o, t) for p, n, y, x, v, o, t in rows if (p, n) == ("20240201", "B04")}
    assert all((r.cleaned, r.observed, r.temporal) == want.get((r.y, r.x), (None, False, False)) for r in some)


def test_cube_reads_only_its_chunks(spark, tmp_path):
    df = spark.range(64 * 64).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("period"), F.lit("v").alias("variable"), F.expr("id div 64").alias("y"), (F.col("id") % 64).alias("x"), F.lit(1.0).alias("cleaned"))
    cubes.write(df, f"{tmp_path}/cube", 16)
    whole = cubes.chunks(spark, f"{tmp_path}/cube")
    some = cubes.chunks(spark, f"{tmp_path}/cube", ["a"], None, (16, 33), (0, 16))
    assert whole.count() == 32 and sorted((r.cy, r.cx) for r in some.collect()) == [(1, 0), (2, 0)]
    plan = some._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "GreaterThanOrEqual(cy,1)" in plan


def test_cube_names(spark):
    df = spark.createDataFrame([("2024", 1, 2, 0.5, 0.25)], "Time string, LAT int, Lon int, ndvi double, b04 double")
    assert sorted(tuple(r) for r in cubes.long_form(df, ["NDVI", "B04"]).collect()) == [("2024", "B04", 1, 2, 0.25), ("2024", "NDVI", 1, 2, 0.5)]
    long = spark.createDataFrame([("2024", 1, 2, "ndvi", 0.5), ("2024", 1, 2, "other", 1.0)], "temporal string, northing int, easting int, band string, value double")
    assert [tuple(r) for r in cubes.long_form(long, ["NDVI"], "band").collect()] == [("2024", "NDVI", 1, 2, 0.5)]
    with pytest.raises(ValueError, match="t dimension"):
        cubes.long_form(df.withColumnRenamed("Time", "when"), ["NDVI"])
    with pytest.raises(ValueError, match="neither"):
        cubes.long_form(df, ["EVI"])
