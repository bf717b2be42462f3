"""Holdouts and folds over places: whole groups scored by balance, and single rows that cover the most regions."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import learning, order

#: (class, cell column, cell row) of a stratum; the last two may be null.
Stratum = tuple


def _balance(counts: DataFrame, target: str) -> DataFrame:
    """fold, n, present, only_here, drift, share_of_rows from a row (fold, class, n) each.

    A class that a fold lacks adds its whole share to the drift, so the sum
    over the classes that are there, less their shares, plus one, is the sum
    over all: no table of folds by classes is needed.
    """
    total = counts.agg(F.sum("n").alias("_all"), F.count_distinct(F.coalesce(F.col(target).cast("string"), F.lit("\0"))).alias("_classes"))
    d = counts.withColumn("_c", F.sum("n").over(Window.partitionBy(target))).withColumn("_f", F.sum("n").over(Window.partitionBy("fold"))).crossJoin(F.broadcast(total))  # one row
    share = F.col("_c") / F.col("_all")
    return d.groupBy("fold").agg(
        F.max("_f").alias("n"),
        (F.max("_classes") - F.count("*")).alias("lacking"),
        F.count_if(F.col("n") == F.col("_c")).alias("only_here"),
        ((F.sum(F.abs(F.col("n") / F.col("_f") - share) - share) + 1) / F.max("_classes")).alias("drift"),
        (F.max("_f") / F.max("_all")).alias("part"),
    )


def grouped_folds(df: DataFrame, group: str, target: str, k: int, by: str = "class") -> DataFrame:
    """Adds fold: whole groups dealt to ``k`` folds to and fro, the same whatever the partitioning.

    ``by="class"``: groups in the order of their commonest class (ties: the
    least), then size; ``by="size"``: of size alone.  Rows without a group are
    one group, rows without a class a class.  Groups are numbered globally:
    there may be as many as rows.
    """
    n = df.groupBy(F.col(group).alias("_g"), F.col(target).alias("_t")).agg(F.count("*").alias("_n"))
    g = n.groupBy("_g").agg(F.sum("_n").alias("_s"), F.min(F.struct((-F.col("_n")).alias("n"), F.col("_t").alias("t")))["t"].alias("_major")).withColumn("_s", -F.col("_s"))
    at = order.numbered(g, ["_major", "_s", "_g"] if by == "class" else ["_s", "_g"], "_at")
    turn, place = F.floor((F.col("_at") - 1) / k), (F.col("_at") - 1) % k
    dealt = at.select("_g", F.when(turn % 2 == 0, place).otherwise(k - 1 - place).cast("int").alias("fold"))
    return df.join(dealt, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")


def balanced_folds(df: DataFrame, group: str, target: str, k: int) -> DataFrame:
    """``grouped_folds`` of whichever dealing has the least largest error of size (then the sum of squares, then of class shares).

    A dealing that leaves a fold's training rows without some class is none; ValueError if both do.
    """
    best = None
    for by in ("size", "class"):
        d = grouped_folds(df, group, target, k, by)
        b = _balance(d.groupBy("fold", target).agg(F.count("*").alias("n")), target)
        e = F.abs(F.col("part") - F.lit(1.0 / k))
        got = b.agg(F.max(e).alias("e"), F.sum(e * e).alias("q"), F.sum("drift").alias("d"), F.sum("only_here").alias("o"), F.count("*").alias("k")).first()
        if got["k"] == k and not got["o"]:
            score = (round(got["e"], 12), round(got["q"], 12), got["d"])
            best = min(best, (score, by, d), key=lambda x: x[:2]) if best else (score, by, d)
    if best is None:
        raise ValueError("no dealing of the groups keeps every class in every fold's training rows")
    return best[2]


def holdout_scores(df: DataFrame, target: str, share: float) -> DataFrame:
    """fold, n, missing, drift, size, score of holding each fold out.

    missing: classes that the fold lacks and classes that only it has; drift:
    the mean over all classes of how far its share is from the whole's; size:
    how far its part of the rows is from ``share``; score: 10 missing + drift + size.
    """
    b = _balance(df.groupBy("fold", target).agg(F.count("*").alias("n")), target)
    b = b.withColumn("missing", F.col("lacking") + F.col("only_here")).withColumn("size", F.abs(F.col("part") - F.lit(float(share))))
    return b.select("fold", "n", "missing", "drift", "size", (10.0 * F.col("missing") + F.col("drift") + F.col("size")).alias("score"), "only_here")


def grouped_holdout(df: DataFrame, group: str, target: str, share: float) -> DataFrame:
    """Adds ``test``: the whole groups of the fold of least score (ties: the first).

    There are round(1 / share) folds, at least two and at most one for each
    group.  ValueError for a share outside (0, 1), fewer than two groups, or a
    choice that leaves training without some class.
    """
    if not 0 < share < 1:
        raise ValueError("the share held out lies strictly between 0 and 1")
    groups = df.select(group).distinct().limit(k := max(2, round(1 / share))).count()
    if groups < 2:
        raise ValueError("a holdout of whole groups takes two groups at least")
    d = grouped_folds(df, group, target, min(k, groups))
    best = holdout_scores(d, target, share).orderBy(F.round("score", 12), "fold").first()
    if best["only_here"]:
        raise ValueError(f"training would lack {best['only_here']} classes")
    return d.withColumn("test", F.col("fold") == best["fold"]).drop("fold")


def overlapping_folds(df: DataFrame, key: str, target: str, k: int, seed: int = 0) -> DataFrame:
    """(fold, key): ``k`` stratified validation draws of a k-th of the rows each, independent of one another, so folds share rows."""
    out = None
    for i in range(k):
        d = learning.folds(df, key, target, k, seed + i).where("fold = 0").select(F.lit(i).alias("fold"), key)
        out = d if out is None else out.unionByName(d)
    return out


def _quotas(totals: dict, share: float) -> dict:
    """Rows of each class to hold out: in proportion, at least one and all but one at most."""
    n = sum(totals.values())
    whole = min(max(-int(-share * n // 1), len(totals)), n - len(totals))
    q = {c: min(max(whole * m // n, 1), m - 1) for c, m in totals.items()}
    short = lambda c: (whole * totals[c] - q[c] * n, str(c))
    while sum(q.values()) < whole:
        q[max((c for c in q if q[c] < totals[c] - 1), key=short)] += 1
    while sum(q.values()) > whole:
        q[min((c for c in q if q[c] > 1), key=short)] -= 1
    return q


def _dealt(n: int, rooms: dict) -> dict:
    """``n``, or all there is, over the rooms in proportion; the remainder by the largest fraction."""
    whole = sum(rooms.values())
    n = min(n, whole)
    out = {s: n * r // whole for s, r in rooms.items()} if whole else {}
    rest = sorted(out, key=lambda s: (-(n * rooms[s] % whole), str(s)))[: n - sum(out.values())]
    return {s: m + (s in set(rest)) for s, m in out.items()}


def _scales(cells: list[tuple[int, int]]) -> list[int]:
    """Sides of the regions in cells, coarsest first: doubled while there are two regions at least."""
    scales = [1]
    while cells and 2 * scales[-1] <= max(max(c) for c in cells) and len({(x // (2 * scales[-1]), y // (2 * scales[-1])) for x, y in cells}) > 1:
        scales.append(2 * scales[-1])
    return scales[::-1]


def allocation(strata: dict[Stratum, int], share: float) -> dict[Stratum, int]:
    """Rows of each stratum to hold out, so that they meet as many regions as the classes' quotas allow, at every scale at once.

    Regions of one scale and classes are matched along augmenting paths, each
    class up to its quota; a class stands for one row of it in the region.
    The matching of a scale is where that of the next finer one begins: a
    path never uncovers a region, so each scale keeps its own maximum.  The
    rows are sought in cells of two rows or more, where training keeps one:
    the maximum is that over all choices of such rows.  Regions of single
    rows alone then take what quotas allow, coarsest first.  What is left of
    the quotas is spread in proportion over rows whose cell keeps a row for
    training, then over the others.
    """
    totals: dict = defaultdict(int)
    in_cell: dict = defaultdict(int)
    for (c, x, y), n in strata.items():
        totals[c] += n
        in_cell[x, y] += n
    quota = _quotas(dict(totals), share)
    left, chosen = dict(quota), []  # chosen: strata that give one row each
    known = sorted({(x, y) for _, x, y in strata if x is not None and y is not None})
    scales = _scales(known)
    for scale in scales:
        region = lambda s: (s[1] // scale, s[2] // scale)  # noqa: B023, E731
        offers: dict = defaultdict(dict)  # region -> class -> its stratum in the fullest cell
        for s in strata:
            if s[1] is not None and s[2] is not None and in_cell[s[1:]] > 1:
                at = offers[region(s)].get(s[0])
                if at is None or (in_cell[s[1:]], s[1:]) > (in_cell[at[1:]], at[1:]):
                    offers[region(s)][s[0]] = s
        given = {region(s): s for s in chosen}
        holds: dict = defaultdict(set)
        for r, s in given.items():
            holds[s[0]].add(r)
        dead: set = set()  # classes from which no free class can be reached any more
        for r in sorted(offers):
            if r in given or not set(offers[r]) - dead or not any(left.values()):
                continue
            came: dict = {c: None for c in sorted(offers[r], key=lambda c: (-left[c], str(c))) if c not in dead}
            todo, end = list(came), None
            for c in todo:
                if left[c]:
                    end = c
                    break
                for other in sorted(holds[c]):
                    for d in offers[other]:
                        if d not in came and d not in dead:
                            came[d] = (c, other)
                            todo.append(d)
            if end is None:
                dead |= set(todo)
                continue
            left[end] -= 1
            while came[end] is not None:  # each region on the path takes the next class and frees its own
                before, other = came[end]
                holds[before].discard(other)
                holds[end].add(other)
                given[other] = offers[other][end]
                end = before
            holds[end].add(r)
            given[r] = offers[r][end]
        chosen = list(given.values())
    take, left_in = defaultdict(int), dict(in_cell)
    for s in chosen:
        take[s] += 1
        left_in[s[1:]] -= 1
    for scale in scales[:-1]:  # regions of single rows
        held = {(x // scale, y // scale) for c, x, y in take if x is not None}
        lone: dict = defaultdict(list)
        for s in strata:
            if s[1] is not None and s[2] is not None and (s[1] // scale, s[2] // scale) not in held:
                lone[s[1] // scale, s[2] // scale].append(s)
        for r in sorted(lone):
            fit = [s for s in lone[r] if left[s[0]] and in_cell[s[1:]] == 1]
            if fit and len(lone[r]) > 1:
                s = max(fit, key=lambda s: (left[s[0]], str(s)))
                take[s] += 1
                left[s[0]] -= 1
                left_in[s[1:]] -= 1
    for spare in (1, 0):
        for c in sorted(left, key=str):
            rooms = {s: max(min(n - take[s], left_in[s[1:]] - spare), 0) for s, n in strata.items() if s[0] == c}
            for s, n in _dealt(left[c], rooms).items():
                take[s] += n
                left_in[s[1:]] -= n
                left[c] -= n
    return dict(take)


def coverage_holdout(df: DataFrame, key: str, target: str, column: str, row: str, share: float, seed: int = 0, most_strata: int = 200_000) -> DataFrame:
    """Adds ``test``: rows held out by ``allocation`` of counts by class and cell; rows of a stratum are drawn by hash.

    ``column`` and ``row`` are whole numbers from nought, null where the place
    is unknown: such rows fill quotas only.  The counts, one for each class
    and occupied cell, are all that reaches the driver; their number is set by
    the grid, not by the rows, and more than ``most_strata`` is a ValueError,
    as are a null class and one of fewer than two rows.  Rows are numbered
    globally, so no task holds a stratum.
    """
    if not 0 < share < 1:
        raise ValueError("the share held out lies strictly between 0 and 1")
    counts = df.groupBy(F.col(target).alias("c"), F.col(column).cast("long").alias("x"), F.col(row).cast("long").alias("y")).agg(F.count("*").alias("n"))
    strata = {(r["c"], r["x"], r["y"]): r["n"] for r in counts.limit(most_strata + 1).collect()}
    if len(strata) > most_strata:
        raise ValueError(f"more than {most_strata} classes by cells: take larger cells")
    totals: dict = defaultdict(int)
    for s, n in strata.items():
        totals[s[0]] += n
    if not strata or None in totals or min(totals.values()) < 2:
        raise ValueError("every row needs a class, and every class two rows")
    if any(v is not None and v < 0 for s in strata for v in s[1:]):
        raise ValueError("cells are numbered from nought")
    take = [(*s, n) for s, n in allocation(strata, share).items() if n]
    taken = df.sparkSession.createDataFrame(take, counts.schema).withColumnRenamed("n", "_take")
    by = [F.col(target), F.col(column).cast("long"), F.col(row).cast("long")]
    ranked = df.withColumns({"_c": by[0], "_x": by[1], "_y": by[2], "_h": F.xxhash64(key, F.lit(seed))})
    ranked = order.numbered(ranked, ["_c", "_x", "_y", "_h", key], "_at")
    first = ranked.groupBy("_c", "_x", "_y").agg(F.min("_at").alias("_first"))
    same = lambda a, b: a[0].eqNullSafe(b[0]) & a[1].eqNullSafe(b[1]) & a[2].eqNullSafe(b[2])
    columns = lambda d, *names: [d[c] for c in names]
    due = first.join(taken, same(columns(first, "_c", "_x", "_y"), columns(taken, "c", "x", "y"))).select(F.col("_c").alias("_c2"), F.col("_x").alias("_x2"), F.col("_y").alias("_y2"), "_first", "_take")
    met = ranked.join(F.broadcast(due), same(columns(ranked, "_c", "_x", "_y"), columns(due, "_c2", "_x2", "_y2")), "left")  # at most most_strata rows
    return met.select(*[ranked[c] for c in df.columns], F.coalesce(F.col("_at") - F.col("_first") < F.col("_take"), F.lit(False)).alias("test"))


def coverage(df: DataFrame, column: str, row: str, test: str, scales: list[int]) -> DataFrame:
    """scale, regions, in_test, in_train, bound: occupied regions of each scale, those that either part meets, and the most that both can (one a row, two a region)."""
    d = df.where(F.col(column).isNotNull() & F.col(row).isNotNull()).groupBy(F.col(column).alias("x"), F.col(row).alias("y")).agg(F.count("*").alias("n"), F.count_if(F.col(test)).alias("t"))
    d = d.withColumn("scale", F.explode(F.array(*[F.lit(int(s)) for s in scales])))
    r = d.groupBy("scale", F.floor(F.col("x") / F.col("scale")).alias("x"), F.floor(F.col("y") / F.col("scale")).alias("y")).agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    return r.groupBy("scale").agg(F.count("*").alias("regions"), F.count_if(F.col("t") > 0).alias("in_test"), F.count_if(F.col("t") < F.col("n")).alias("in_train"), F.sum(F.least(F.col("n"), F.lit(2))).alias("bound"))
