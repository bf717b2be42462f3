"""Points on the borders of polygons."""

import itertools

from zonalis.operators import spatial


def test_points_on_borders_and_corners(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    wedge = [(2.0, 0.0), (6.0, 4.0), (2.0, 4.0)]
    zones = spark.createDataFrame([(2, square), (1, wedge)], "zone int, ring array<struct<x:double,y:double>>")
    at = [(i / 2, j / 2) for i, j in itertools.product(range(-1, 14), range(-1, 10))]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(at)] + [(999, None, 1.0)], "id int, x double, y double")
    got = {r.id: r.zone for r in spatial.points_in_polygons(df, zones, "x", "y", "zone", "ring", 0.7).collect()}

    def want(x, y):
        if x >= 2 and y <= 4 and y >= x - 2:
            return 1  # the smaller id where both touch
        return 2 if 0 <= x <= 2 and 0 <= y <= 2 else None

    assert got == {**{k: want(*p) for k, p in enumerate(at)}, 999: None}
