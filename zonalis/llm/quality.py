"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source.

Statistics of each whole text become four transformed numbers (word length,
symbols, repeated lines, repeated words).  For each group of language and
source an MCD estimate is sought: from two starts, concentration steps take
the mean and covariance of the ``share`` of rows that lie nearest and measure
all rows anew; the start of least determinant wins.  A row is rejected if its
squared Mahalanobis distance is above ``cutoff``.

A covariance gets ``FLOORS`` squared on its diagonal, for the nearest rows are
often equal in a number and their plain determinant is nought.  The nearest
share is cut at a bin of a fine histogram of the distances: exact counts,
bounded memory, and no group in one task.  A group of fewer than ``least``
rows is judged by its language, a small language by all rows; null is a
language and a source like any other.

DataFrame operations only.  Null and empty texts have no word and fail the
base rules, as does any text of fewer than 50 words or with more than half its
words in repeated three-word windows; failed rows take no part in the
estimates.  Repeated rows and null ids are kept.  An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_text, stored

BLANKS = r"[\x20\x09-\x0D]+"
DIMS = 4
#: Least spread of each transformed number: log word length, asinh of 20 x symbols a word, share of repeated lines, share of repeated words.
FLOORS = (0.1, 0.3, 0.1, 0.12)
#: 0.999999 quantile of chi-square with four degrees of freedom.
CUTOFF = 33.377
#: Makes the covariance of the nearest three quarters of a normal sample consistent: 0.75 / P(chi-square(6) < 0.75 quantile of chi-square(4)).
CONSISTENCY = 1.489
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
#: Largest table of estimates, in rows, that is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep``, then n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each whole text."""
    text = F.coalesce(as_text("text"), F.lit(""))
    df = docs.select(*keep, text.alias("_t"))
    df = df.select(*keep, "_t", F.filter(F.split("_t", BLANKS), lambda w: w != "").alias("_w"), F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    df = df.select(
        *keep, "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
    )
    base = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    w = F.col("_w")
    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    df = df.select(*base, windows.alias("_h"))
    pairs = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    df = df.select(*base, pairs.alias("_s"))
    s = F.col("_s")
    twice = F.filter(s, lambda e, i: F.get(s, i - 1)["x"].eqNullSafe(e["x"]) | F.get(s, i + 1)["x"].eqNullSafe(e["x"]))
    df = df.select(*base, F.array_sort(F.transform(twice, lambda e: e["i"])).alias("_p"))
    p = F.col("_p")
    # each window adds its words up to the next one's first
    covered = F.aggregate(F.transform(p, lambda a, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - a, F.lit(3)))), F.lit(0), lambda x, y: x + y)
    return df.select(*base, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def transformed() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.asinh(F.lit(20.0) * F.col("n_symbols") / n),
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        F.col("n_repeat_words") / n,
    ]


def _join(rows: DataFrame, table: DataFrame, small: bool, on: list[str]) -> DataFrame:
    return rows.join(F.broadcast(table) if small else table, on)


def _distance(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and d2: forward substitution with the Cholesky factor's columns l_ij."""
    for i in range(DIMS):
        z = F.col(f"y{i}") - F.col(f"m{i}")
        for j in range(i):
            z = z - F.col(f"l{i}{j}") * F.col(f"z{j}")
        df = df.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, DIMS)), F.col("z0") * F.col("z0"))
    return df.select(*keep, d2.alias("d2"))


def _factor(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Means and Cholesky factor of the floored covariance from the columns n, s_i and s_ij; ``det``: the log determinant."""
    df = moments
    for i in range(DIMS):
        df = df.withColumn(f"m{i}", F.col(f"s{i}") / F.col("n"))
    for i, j in _PAIRS:
        c = F.greatest(F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"), F.lit(0.0)) if i == j else F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
        df = df.withColumn(f"c{i}{j}", c * CONSISTENCY + (FLOORS[i] ** 2 if i == j else 0.0))
    for j in range(DIMS):
        left = sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        df = df.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - left, F.lit(1e-9))))
        for i in range(j + 1, DIMS):
            left = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            df = df.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - left) / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(DIMS)), F.lit(0.0))
    return df.select(*keys, *[f"m{i}" for i in range(DIMS)], *[f"l{i}{j}" for i, j in _PAIRS], det.alias("det"))


def _starts(rows: DataFrame) -> DataFrame:
    """Medians as means; spreads from quartiles (start 0) or the floors alone (start 1).  Quantiles come from histograms, exact counts of fine bins."""
    dims = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.round(F.col(f"y{i}") / (FLOORS[i] / 20)).cast("long").alias("b")) for i in range(DIMS)])).alias("e")
    bins = rows.select("g", dims).groupBy("g", "e.i", "e.b").agg(F.count("*").alias("c"))
    by = Window.partitionBy("g", "i")
    bins = bins.withColumn("below", F.sum("c").over(by.orderBy("b"))).withColumn("n", F.sum("c").over(by))
    quant = bins.groupBy("g", "i").agg(*[F.min(F.when(F.col("below") >= F.col("n") * q, F.col("b"))).alias(a) for a, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))])
    out = quant.groupBy("g").agg(*[F.max(F.when(F.col("i") == i, F.col(q)) * (FLOORS[i] / 20)).alias(f"{q}_{i}") for i in range(DIMS) for q in ("q1", "q2", "q3")])
    out = out.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))
    spread = [F.when(F.col("start") == 0, F.greatest((F.col(f"q3_{i}") - F.col(f"q1_{i}")) / 1.349, F.lit(FLOORS[i]))).otherwise(F.lit(FLOORS[i])) for i in range(DIMS)]
    return out.select("g", "start", *[F.col(f"q2_{i}").alias(f"m{i}") for i in range(DIMS)], *[(spread[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in _PAIRS], F.lit(0.0).alias("det"))


def estimates(rows: DataFrame, small: bool, share: float = 0.75, steps: int = 4) -> DataFrame:
    """MCD of each group: ``rows`` (g, y0..y3) -> g, means and Cholesky factor."""
    ys = [f"y{i}" for i in range(DIMS)]
    params = stored(_starts(rows), "mcd")
    for _ in range(steps):
        near = _distance(_join(rows, params, small, ["g"]), ["g", "start", *ys]).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-4) * 16).cast("int"))
        bins = near.groupBy("g", "start", "bin").agg(F.count("*").alias("c"))
        by = Window.partitionBy("g", "start")
        bins = bins.withColumn("below", F.sum("c").over(by.orderBy("bin"))).withColumn("n", F.sum("c").over(by))
        cut = bins.groupBy("g", "start").agg(F.min(F.when(F.col("below") >= F.ceil(F.col("n") * share), F.col("bin"))).alias("cut"))
        inner = _join(near, stored(cut, "cut"), small, ["g", "start"]).where("bin <= cut")
        moments = inner.groupBy("g", "start").agg(F.count("*").alias("n"), *[F.sum(y).alias(f"s{i}") for i, y in enumerate(ys)], *[F.sum(F.col(ys[i]) * F.col(ys[j])).alias(f"s{i}{j}") for i, j in _PAIRS])
        params = stored(_factor(moments, ["g", "start"]), "mcd")
    best = params.groupBy("g").agg(F.min_by(F.struct(*[c for c in params.columns if c not in ("g", "start")]), F.struct("det", "start")).alias("p"))
    return best.select("g", "p.*").drop("det")


def quality(docs: DataFrame, share: float = 0.75, cutoff: float = CUTOFF, least: int = 200, steps: int = 4) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, d2, group_level, kept."""
    slim = docs.select("doc_id", "text", as_text("lang").alias("lang"), as_text("source").alias("source"))
    stats = statistics(slim, "doc_id", "lang", "source")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed).select("*", *[y.alias(f"y{i}") for i, y in enumerate(transformed())])
    stats = stored(stats, "statistics")
    levels = [F.struct(F.lit(2).alias("level"), F.col("lang").alias("a"), F.col("source").alias("b")), F.struct(F.lit(1).alias("level"), F.col("lang").alias("a"), F.lit(None).cast("string").alias("b")), F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))]
    keys = [F.to_json(k, {"ignoreNullFields": "false"}) for k in levels]
    ys = [f"y{i}" for i in range(DIMS)]
    fit = stats.where("not base_failed").select(F.explode(F.array(*keys)).alias("g"), *ys)
    sizes = stored(fit.groupBy("g").agg(F.count("*").alias("n")).where((F.col("n") >= least) | F.col("g").startswith('{"level":0')), "groups")
    small = sizes.count() <= BROADCAST_ROWS
    rows = _join(fit, sizes.select("g"), small, ["g"])
    params = stored(estimates(rows, small, share, steps), "estimates")
    # each document by its narrowest group that has an estimate; all rows are one group and need no look-up
    stats = stats.withColumn("g0", keys[2])
    for i, k in enumerate(keys[:2]):
        known = params.select(F.col("g").alias(f"g{2 - i}"), F.lit(True).alias(f"has{2 - i}"))
        stats = stats.withColumn(f"g{2 - i}", k)
        stats = stats.join(F.broadcast(known) if small else known, f"g{2 - i}", "left")
    level = F.when(F.col("has2"), 2).when(F.col("has1"), 1).otherwise(0)
    stats = stats.withColumn("group_level", level).withColumn("g", F.when(F.col("has2"), F.col("g2")).when(F.col("has1"), F.col("g1")).otherwise(F.col("g0")))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    joined = stats.join(F.broadcast(params) if small else params, "g", "left")
    out = _distance(joined, [*cols, "group_level"])
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True)))
