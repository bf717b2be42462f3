"""Holdouts and folds over places against brute force and plain recounts."""

import collections
import itertools
import random

import pytest

from zonalis.operators import holdout


def covered(take, strata, scale):
    """Regions that the rows taken from cells of two rows or more meet."""
    cells = collections.Counter()
    for (_, *cell), n in strata.items():
        cells[tuple(cell)] += n
    return len({(x // scale, y // scale) for (_, x, y), n in take.items() if n and cells[x, y] > 1})


@pytest.mark.parametrize("seed", range(60))
def test_allocation_covers_as_much_as_any_at_every_scale(seed):
    rng = random.Random(seed)
    strata = {}
    for _ in range(rng.randint(3, 7)):
        strata[rng.choice("ab" if seed % 2 else "abc"), rng.randint(0, 5), rng.randint(0, 5)] = rng.choice([1, 1, 2, 3])
    for c in {s[0] for s in strata}:
        strata[c, 0, 0] = strata.get((c, 0, 0), 0) + 2
    share = rng.choice([0.2, 0.3, 0.5])
    got = holdout.allocation(strata, share)
    totals = collections.Counter()
    for s, n in strata.items():
        totals[s[0]] += n
    quota = holdout._quotas(dict(totals), share)
    assert all(0 <= got[s] <= strata[s] for s in got)
    by_class = collections.Counter()
    for s, n in got.items():
        by_class[s[0]] += n
    assert by_class == quota and all(0 < quota[c] < totals[c] for c in totals)
    names = sorted(strata)
    best = collections.Counter()
    scales = holdout._scales(sorted({s[1:] for s in strata}))
    for takes in itertools.product(*[range(strata[s] + 1) for s in names]):
        sums = collections.Counter()
        for s, n in zip(names, takes):
            sums[s[0]] += n
        if sums == quota:
            for scale in scales:
                best[scale] = max(best[scale], covered(dict(zip(names, takes)), strata, scale))
    assert {s: covered(got, strata, s) for s in scales} == dict(best)


def test_quotas_are_whole_and_keep_every_class():
    assert holdout._quotas({"a": 2, "b": 98}, 0.2) == {"a": 1, "b": 19}
    assert holdout._quotas({"a": 2, "b": 2}, 0.9) == {"a": 1, "b": 1}
    assert sum(holdout._quotas({c: 3 * c + 2 for c in range(9)}, 0.3).values()) == 38
    assert holdout._dealt(10**15, {"a": 3 * 10**15, "b": 10**15, "c": 0}) == {"a": 75 * 10**13, "b": 25 * 10**13, "c": 0}


def test_coverage_holdout(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("aab"), None if i % 23 == 0 else rng.randint(0, 9), rng.randint(0, 9), "x") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, t string, x int, y int, test2 string")
    got = holdout.coverage_holdout(df, "id", "t", "x", "y", 0.2, 3).collect()
    again = holdout.coverage_holdout(df.repartition(7), "id", "t", "x", "y", 0.2, 3).where("test").select("id").collect()
    assert {r.id for r in got if r.test} == {r.id for r in again}
    assert sorted(r.id for r in got) == list(range(600)) and sum(r.test for r in got) == 120
    strata = collections.Counter((r[1], r[2], r[3]) for r in rows)
    want = {s: n for s, n in holdout.allocation(dict(strata), 0.2).items() if n}
    assert collections.Counter((r.t, r.x, r.y) for r in got if r.test) == want
    c = {r.scale: r for r in holdout.coverage(spark.createDataFrame(got), "x", "y", "test", [1, 2, 4]).collect()}
    assert all(r.in_test + r.in_train == r.bound for s, r in c.items() if s > 1)
    for bad in ([(1, "a", 0, 0)], [(1, "a", 0, 0), (2, None, 0, 0)], [(1, "a", -1, 0), (2, "a", 0, 0)]):
        with pytest.raises(ValueError):
            holdout.coverage_holdout(spark.createDataFrame(bad, "id long, t string, x int, y int"), "id", "t", "x", "y", 0.5)
    with pytest.raises(ValueError):
        holdout.coverage_holdout(df, "id", "t", "x", "y", 0.2, most_strata=5)


def test_grouped_holdout_keeps_groups_whole(spark):
    rng = random.Random(1)
    rows = [(i, None if i % 31 == 0 else f"g{rng.randint(0, 24)}", rng.choice("aaab")) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g string, t string")
    got = holdout.grouped_holdout(df, "g", "t", 0.2).collect()
    assert sorted(r.id for r in got) == list(range(900))
    parts = collections.defaultdict(set)
    for r in got:
        parts[r.g].add(r.test)
    assert all(len(p) == 1 for p in parts.values()) and 120 <= sum(r.test for r in got) <= 240
    with pytest.raises(ValueError):
        holdout.grouped_holdout(df.where("g = 'g1'"), "g", "t", 0.2)
    alone = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "y"), (4, "b", "y")], "id long, g string, t string")
    with pytest.raises(ValueError):
        holdout.grouped_holdout(alone, "g", "t", 0.5)


def test_scores_equal_a_plain_recount(spark):
    rng = random.Random(2)
    rows = [(i % 4, "abcd"[0 if i % 4 == 0 else rng.randint(0, 2)] if i != 7 else "d") for i in range(101)]
    got = {r.fold: r for r in holdout.holdout_scores(spark.createDataFrame(rows, "fold int, t string"), "t", 0.3).collect()}
    n, classes = len(rows), collections.Counter(t for _, t in rows)
    for f in range(4):
        here = collections.Counter(t for g, t in rows if g == f)
        m = sum(here.values())
        missing = sum(not here[c] for c in classes) + sum(here[c] == classes[c] for c in classes)
        drift = sum(abs(here[c] / m - classes[c] / n) for c in classes) / len(classes)
        assert got[f].missing == missing and got[f].n == m
        assert got[f].drift == pytest.approx(drift) and got[f].score == pytest.approx(10 * missing + drift + abs(m / n - 0.3))


def test_balanced_and_overlapping_folds(spark):
    rows = [(i, i % 40 if i < 400 else 40 + i % 3, "ab"[i % 2]) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, g long, t string")
    sizes = collections.Counter(r.fold for r in holdout.balanced_folds(df, "g", "t", 3).collect())
    assert sorted(sizes) == [0, 1, 2] and max(sizes.values()) - min(sizes.values()) <= 20
    got = holdout.overlapping_folds(df, "id", "t", 5).collect()
    per = collections.Counter(r.fold for r in got)
    assert set(per.values()) == {200} and len({r.id for r in got}) < 1000
    with pytest.raises(ValueError):
        holdout.balanced_folds(df.where("g < 2"), "g", "t", 3)
