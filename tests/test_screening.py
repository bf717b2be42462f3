"""Contracts and options by hand-computed cases; the queries are held against their SQL elsewhere."""

import pytest

from zonalis.operators import screening as s


def test_contract(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "id int, y string")
    got = {tuple(r) for r in s.contract_violations(df, "id", "y", 2).collect()}
    assert got == {("id_not_unique", "", 1), ("class_too_small", "b", 1)}
    one = spark.createDataFrame([(1, "a"), (2, "a")], "id int, y string")
    assert [tuple(r) for r in s.contract_violations(one, "id", "y", 2).collect()] == [("one_class", "", 1)]
    assert s.contract_violations(one.where("y is null"), "id", "y", 2).first()["rule"] == "no_labelled_row"
    with pytest.raises(ValueError):
        s.require_columns(df, ["z"])


def test_options():
    assert s.period("10d") == "10D" and s.period("Monthly") == "1M"
    assert s.fill_windows([3, 5], [3, 5]) == ([3, 5], [3, 5]) and s.fill_windows(None, None) == ([], [])
    assert s.memory_mb("1.5g") == 1536 and s.memory_mb("512MiB") == 512
    for f, x in ((s.period, "0D"), (s.period, "W"), (s.memory_mb, "x"), (s.memory_mb, "0g")):
        with pytest.raises(ValueError):
            f(x)
    for a in (([5, 3], []), ([4], []), ([], [5])):
        with pytest.raises(ValueError):
            s.fill_windows(*a)
    with pytest.raises(ValueError):
        s.cleaning_options(low=0.8)
    assert s.cleaning_options()["multiplier"] == 1.5


def test_chunk_order_keeps_rows(spark):
    df = spark.range(1000).selectExpr("id", "id % 37 AS r", "id % 23 AS c")
    out = s.chunk_order(df, "r", "c", 8, ["id"])
    assert sorted(x["id"] for x in out.collect()) == list(range(1000))
