"""Input contracts, row masks, evidence labels and counts for reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import order, zonal

#: Least effect for each label, largest first.
EFFECTS = {"kruskal_epsilon_squared": [(0.14, "large"), (0.06, "moderate"), (0.01, "small")], None: [(0.5, "strong"), (0.3, "moderate"), (0.1, "weak")]}
#: Notes by whether the effect and its adjusted p-value hold.
NOTES = {
    (True, True): "priority candidate; validate with cross-validation and redundancy checks",
    (True, False): "meaningful effect; statistical evidence is limited",
    (False, True): "statistically detectable but weak univariate effect",
    (False, False): "limited univariate evidence",
}
#: Period units and their aliases.
PERIOD_UNITS = {"DAY": "1D", "DAILY": "1D", "MONTH": "1M", "MONTHLY": "1M", "YEAR": "1Y", "YEARLY": "1Y", "ANNUAL": "1Y"}


# --- contracts ---------------------------------------------------------------------------------------


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def contract_violations(df: DataFrame, id_column: str, target: str, folds: int) -> DataFrame:
    """rule, detail, n: what keeps ``df`` from being trained on; no row if nothing does.

    Repeated or null ids, no labelled row, one class only, classes of fewer
    rows than folds.  Two aggregations by key; nothing else moves.
    """
    ids = df.groupBy(id_column).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(id_column).isNull())
    repeated = ids.agg(F.count("*").alias("n")).where("n > 0").select(F.lit("id_not_unique").alias("rule"), F.lit("").alias("detail"), "n")
    classes = df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("detail")).agg(F.count("*").alias("n"))
    small = classes.where(F.col("n") < folds).select(F.lit("class_too_small").alias("rule"), "detail", "n")
    few = classes.agg(F.count("*").alias("n")).where("n < 2").select(F.when(F.col("n") == 0, "no_labelled_row").otherwise("one_class").alias("rule"), F.lit("").alias("detail"), "n")
    return repeated.unionByName(small).unionByName(few)


def period(text: str) -> str:
    """A period as number and unit: ``[1-9][0-9]*`` then D, M or Y, or an alias."""
    value = text.strip().upper()
    value = PERIOD_UNITS.get(value, value)
    if not re.fullmatch(r"[1-9][0-9]*[DMY]", value):
        raise ValueError(f"not a period: {text!r}")
    return value


def fill_windows(temporal: list[int] | None, spatial: list[int] | None) -> tuple[list[int], list[int]]:
    """Temporal windows rise strictly and are odd from 3; spatial ones are the first of 3, 5, 7, 9."""
    temporal, spatial = list(temporal or []), list(spatial or [])
    if any(w < 3 or w % 2 == 0 for w in temporal) or any(b <= a for a, b in zip(temporal, temporal[1:])):
        raise ValueError(f"temporal windows must be odd, 3 at least, and rise: {temporal}")
    if spatial != [3, 5, 7, 9][: len(spatial)]:
        raise ValueError(f"spatial windows must begin 3, 5, 7, 9: {spatial}")
    return temporal, spatial


def cleaning_options(low: float = 0.25, high: float = 0.75, multiplier: float = 1.5, least_pixels: int = 1, fraction: float = 0.0) -> dict[str, float]:
    """The options of a cleaning run, if they are in range."""
    checks = {"quantiles 0 <= low < high <= 1": 0 <= low < high <= 1, "multiplier >= 0": multiplier >= 0, "least_pixels >= 1": least_pixels >= 1, "0 <= fraction <= 1": 0 <= fraction <= 1}
    wrong = [k for k, ok in checks.items() if not ok]
    if wrong:
        raise ValueError("; ".join(wrong))
    return {"low": low, "high": high, "multiplier": multiplier, "least_pixels": least_pixels, "fraction": fraction}


def memory_mb(text: str) -> int:
    """``512m``, ``4G``, ``1.5g`` as whole megabytes."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([mg])i?b?\s*", text, re.I)
    if not m or float(m[1]) == 0:
        raise ValueError(f"not a memory size: {text!r}")
    return int(float(m[1]) * (1024 if m[2].lower() == "g" else 1))


# --- masks -------------------------------------------------------------------------------------------


def training_mask(target: str, excluded: str) -> Column:
    return F.col(target).isNotNull() & ~F.coalesce(F.col(excluded), F.lit(False))


def flag_null_rows(df: DataFrame, features: list[str], out: str = "has_null") -> DataFrame:
    """Rows with a null in any feature; a feature that is null in all rows doesn't count."""
    filled = df.agg(*[(F.count(c) > 0).alias(c) for c in features])  # one row
    rule = F.lit(False)
    for c in features:
        rule = rule | (F.col(c).isNull() & F.col(f"_f.{c}"))
    return df.crossJoin(F.broadcast(filled.select(F.struct(*features).alias("_f")))).withColumn(out, rule).drop("_f")


def flag_outlier_rows(df: DataFrame, flag: str, out: str = "excluded") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(flag).cast("boolean"), F.lit(False)) if flag in df.columns else F.lit(False))


def active_features(df: DataFrame, features: list[str]) -> DataFrame:
    """column_name, non_null, n_distinct, active: neither empty nor constant; one aggregation."""
    row = df.agg(*[F.count(c).alias(f"n_{c}") for c in features], *[F.count_distinct(c).alias(f"d_{c}") for c in features])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("non_null"), F.col(f"d_{c}").alias("n_distinct")) for c in features])).alias("e")).select("e.*")
    return long.withColumn("active", F.col("n_distinct") > 1)


def excluded_targets(target: str, values: list[str]) -> Column:
    """Equal to one of ``values`` as text or, where both are numbers, as a number."""
    text = F.trim(F.col(target).cast("string"))
    numbers = []
    for v in values:
        try:
            numbers.append(float(v))
        except ValueError:
            continue
    rule = text.isin(*values) if values else F.lit(False)
    return F.coalesce(rule | (text.try_cast("double").isin(*numbers) if numbers else F.lit(False)), F.lit(False))


# --- labels ------------------------------------------------------------------------------------------


def effect_label(method: Column, effect: Column) -> Column:
    def label(steps: list[tuple[float, str]]) -> Column:
        out = F.when(F.lit(False), "")
        for least, name in steps:
            out = out.when(effect >= least, name)
        return out.otherwise("negligible")

    known = F.when(effect.isNull() | F.isnan(effect) | (F.abs(effect) == float("inf")), "unavailable")
    for m in EFFECTS:
        if m is not None:
            known = known.when(method == m, label(EFFECTS[m]))
    return known.otherwise(label(EFFECTS[None]))


def selection_note(label: Column, q: Column, alpha: float = 0.05) -> Column:
    strong, holds = label.isin("strong", "large", "moderate"), F.coalesce(~F.isnan(q) & (q <= alpha), F.lit(False))
    return F.when(strong & holds, NOTES[True, True]).when(strong, NOTES[True, False]).when(holds, NOTES[False, True]).otherwise(NOTES[False, False])


def vif_label(v: Column) -> Column:
    return F.when(v.isNull() | F.isnan(v), "not_available").when(v >= 10, "high_multicollinearity").when(v >= 5, "moderate_multicollinearity").otherwise("low_multicollinearity")


def safe_percent(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.when(F.coalesce(whole, F.lit(0)) == 0, 0.0).otherwise(F.round(100 * part / whole, digits))


# --- counts for reports ------------------------------------------------------------------------------


def value_flags(df: DataFrame, columns: list[str], quasi: float = 0.95, rare: float = 0.5) -> DataFrame:
    """column_name, flag, ratio: quasi-constant columns, and columns of five values or more of which ``rare`` are rare.

    All columns in one aggregation by column and value; a frequent value is
    pre-aggregated where it is read.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("e")).select("e.*")
    counts = long.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    known = F.col("v").isNotNull()
    sums = counts.groupBy("column_name").agg(F.sum("n").alias("rows"), F.sum(F.when(known, F.col("n"))).alias("non_null"), F.count(F.when(known, 1)).alias("n_values"), F.max(F.when(known, F.col("n"))).alias("top"))
    sums = sums.withColumn("least", F.greatest(F.lit(1), F.floor(F.lit(0.01) * F.col("rows"))))
    seldom = counts.where(known).join(F.broadcast(sums.select("column_name", "least")), "column_name").where("n <= least").groupBy("column_name").agg(F.count("*").alias("seldom"))  # a row for each column
    all_ = sums.join(F.broadcast(seldom), "column_name", "left")
    constant = F.when((F.col("n_values") > 1) & (F.col("top") / F.col("non_null") >= quasi), F.struct(F.lit("quasi_constant").alias("flag"), (F.col("top") / F.col("non_null")).alias("ratio")))
    heavy = F.coalesce(F.col("seldom"), F.lit(0)) / F.col("n_values")
    rares = F.when((F.col("n_values") >= 5) & (heavy >= rare), F.struct(F.lit("rare_category_heavy").alias("flag"), heavy.alias("ratio")))
    return all_.select("column_name", F.explode(F.array_compact(F.array(constant, rares))).alias("e")).select("column_name", "e.flag", "e.ratio")


def model_ranking(scores: DataFrame, model: str, score: str, last: str | None = None) -> DataFrame:
    """model, mean, std, ranking (mean less std), rank: by ranking, then mean, then name; ``last`` is put at the end."""
    out = scores.groupBy(model).agg(F.avg(score).alias("mean_score"), F.coalesce(F.stddev_pop(score), F.lit(0.0)).alias("std_score")).withColumn("ranking", F.col("mean_score") - F.col("std_score"))
    order = [F.col(model).eqNullSafe(F.lit(last)), F.desc("ranking"), F.desc("mean_score"), F.col(model)]
    return out.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # a row for each model


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """bin, lower, upper, n: equal widths from least to greatest, the greatest in the last; empty bins too."""
    edge = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col(column) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(0)
    counts = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(edge)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))  # one row of bounds
    frame = edge.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counts, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * width).alias("lower"), (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"))


def box_plot(df: DataFrame, by: str, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, and the whiskers: the outermost values within ``reach`` interquartile ranges."""
    q = zonal.quantiles(df, [by], column, [0.25, 0.5, 0.75]).select(by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    low, high = F.col("q1") - reach * (F.col("q3") - F.col("q1")), F.col("q3") + reach * (F.col("q3") - F.col("q1"))
    met = df.join(F.broadcast(q), by)  # a row for each group of a plot
    inner = F.col(column).between(low, high)
    ends = met.groupBy(by).agg(F.min(F.when(inner, F.col(column))).alias("whisker_low"), F.max(F.when(inner, F.col(column))).alias("whisker_high"), F.count_if(~inner).alias("n_outside"))
    return q.join(ends, by)


def flows(df: DataFrame, stages: list[str], top: int = 10, other: str = "Other") -> DataFrame:
    """step, source, target, n between adjacent stages; labels beyond a stage's ``top`` (ties by label) as ``other``."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("stage"), F.col(c).cast("string").alias("label")) for i, c in enumerate(stages)])).alias("e")).select("e.*")
    ranked = long.groupBy("stage", "label").agg(F.count("*").alias("n")).withColumn("k", F.row_number().over(Window.partitionBy("stage").orderBy(F.desc("n"), "label")))
    kept = ranked.where(F.col("k") <= top).select("stage", "label")
    out = df.select(*[F.col(c).cast("string").alias(f"s{i}") for i, c in enumerate(stages)])
    for i in range(len(stages)):
        names = kept.where(F.col("stage") == i).select(F.col("label").alias(f"s{i}"), F.lit(True).alias(f"_k{i}"))
        out = out.join(F.broadcast(names), f"s{i}", "left").withColumn(f"s{i}", F.when(F.col(f"_k{i}"), F.col(f"s{i}")).otherwise(other)).drop(f"_k{i}")  # ``top`` rows
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.col(f"s{i}").alias("source"), F.col(f"s{i + 1}").alias("target")) for i in range(len(stages) - 1)])
    return out.select(F.explode(steps).alias("e")).groupBy("e.step", "e.source", "e.target").agg(F.count("*").alias("n"))


def ecdf(df: DataFrame, by: str, value: str) -> DataFrame:
    """by, value, share of the group's values at most that; from counts of equal values over a global order, so no task holds a group."""
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    at = order.running(counts, [by, value], F.col("n"), "_before")
    group = at.groupBy(F.col(by).alias("_k")).agg(F.min("_before").alias("_first"), F.sum("n").alias("_all"))
    return at.join(group, F.col(by).eqNullSafe(F.col("_k"))).select(by, value, ((F.col("_before") - F.col("_first") + F.col("n")) / F.col("_all")).alias("share"))


def binned_error(df: DataFrame, x: str, y: str, error: str, width: float, least: int) -> DataFrame:
    """Mean error in square cells of ``width``; cells of fewer than ``least`` rows are left out."""
    cell = [F.floor(F.col(c) / width).cast("long").alias(f"{c}_bin") for c in (x, y)]
    return df.groupBy(*cell).agg(F.avg(error).alias("mean_error"), F.count("*").alias("n")).where(F.col("n") >= least)


def shares(df: DataFrame, by: str, label: str) -> DataFrame:
    """Row-normalised counts: by, label, n, share of the row."""
    counts = df.groupBy(by, label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def chunk_order(df: DataFrame, row: str, col: str, chunk: int, keys: list[str]) -> DataFrame:
    """``df`` laid out by chunk row, chunk column, row, column: neighbours on a grid stand in one partition; ``keys`` break ties."""
    order = [F.floor(F.col(row) / chunk), F.floor(F.col(col) / chunk), F.col(row), F.col(col), *map(F.col, keys)]
    return df.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
