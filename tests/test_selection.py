"""Associations and the proposal against plain computations."""

import collections
import math
import random

import pytest

from zonalis.operators import selection


def mean_ranks(v):
    at = collections.defaultdict(list)
    for i, x in enumerate(sorted(v)):
        at[x].append(i + 1)
    return [sum(at[x]) / len(at[x]) for x in v]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        y = "abc"[i % 3]
        near = (i % 3) + rng.gauss(0, 0.5)
        rows.append((y, near, 2 * near + (0.01 if i % 2 else 0), None if i % 4 == 0 else rng.random(), 1.0, y if rng.random() < 0.7 else "z", rng.choice("pq"), None))
    return spark.createDataFrame(rows, "y string, near double, twin double, noise double, flat double, code string, coin string, hollow double")


def test_associations_with_classes(spark, table):
    got = {r.feature: r for r in selection.associations(table, "y", ["near", "twin", "noise", "hollow"], ["code", "coin"], True).collect()}
    rows = table.collect()
    for c in ("near", "noise"):
        v = [(r.y, r[c]) for r in rows if r[c] is not None]
        n, sums, sizes = len(v), collections.Counter(), collections.Counter()
        for (y, _), k in zip(v, mean_ranks([x for _, x in v])):
            sums[y] += k
            sizes[y] += 1
        h = 12 / (n * (n + 1)) * sum(sums[y] ** 2 / sizes[y] for y in sums) - 3 * (n + 1)
        assert got[c].effect_size == pytest.approx(max(0, (h - 2) / (n - 3)), abs=1e-9)
        assert got[c].p == pytest.approx(math.exp(-h / 2), rel=1e-6)  # the tail of chi-square with two degrees
        assert got[c].rows_used == n
    ps = sorted((got[c].p, c) for c in ("near", "twin", "noise"))
    assert got[ps[2][1]].q == pytest.approx(ps[2][0]) and got[ps[1][1]].q == pytest.approx(min(ps[2][0], ps[1][0] * 3 / 2))
    assert got["noise"].missing_percent == 25 and got["noise"].rank == 3 and not got["noise"].significant
    assert (got["hollow"].effect_size, got["hollow"].p, got["hollow"].strength, got["hollow"].rank) == (None, None, "unavailable", 4)
    assert got["code"].method == selection.CRAMER and got["code"].significant and got["code"].rank == 1 and got["coin"].rank == 2


def test_associations_with_a_number(spark, table):
    got = {r.feature: r for r in selection.associations(table, "near", ["twin", "noise"], ["code"], False).collect()}
    rows = [r for r in table.collect() if r.noise is not None]
    a, b = mean_ranks([r.noise for r in rows]), mean_ranks([r.near for r in rows])
    m = (len(rows) + 1) / 2
    rho = sum((x - m) * (y - m) for x, y in zip(a, b)) / math.sqrt(sum((x - m) ** 2 for x in a) * sum((y - m) ** 2 for y in b))
    assert got["noise"].direction == pytest.approx(rho) and got["noise"].effect_size == pytest.approx(abs(rho)) and 0.05 < got["noise"].p <= 1
    assert got["twin"].strength == "strong" and got["code"].method == selection.KRUSKAL


def test_proposal_order_and_reasons(spark, table):
    found = selection.associations(table, "y", ["near", "twin", "noise", "flat"], ["code", "coin"], True)
    flags = spark.createDataFrame([("flat", "constant"), ("coin", "id_like")], "column_name string, flag string")
    got = {r.feature: r for r in selection.proposal(found, flags, selection.redundancy(table)).collect()}
    first = "near" if {r.feature: r for r in found.collect()}["near"].rank == 1 else "twin"
    other = "twin" if first == "near" else "near"
    assert got[first].action == "use" and got["code"].action == "use" and got[first].position <= 2
    assert (got[other].action, got[other].redundant_with) == ("review", first) and got[other].redundancy > 0.9
    assert got["flat"].reason == "quality: constant" and got["noise"].action == "exclude"
    assert [r.position for r in got.values()] == list(range(1, 7))
    few = {r.feature: r for r in selection.proposal(found, flags, selection.redundancy(table), excluded=[first], most=1).collect()}
    assert few[first].reason == "excluded by name" and sorted(f for f in few if few[f].action == "use") in ([other], ["code"])
    assert [few[f].reason for f in (other, "code")].count("beyond the shortlist") == 1


def test_empty_table(spark, table):
    got = selection.associations(table.where("false"), "y", ["near"], ["code"], True).collect()
    assert all(r.effect_size is None and r.q is None and r.missing_percent == 0 for r in got) and len(got) == 2
