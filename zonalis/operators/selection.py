"""Features by their association with a target, and a proposal of those to use."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import special
from . import order, screening, stats

KRUSKAL, CRAMER, SPEARMAN = "kruskal_epsilon_squared", "bias_corrected_cramers_v", "absolute_spearman_correlation"

_FOUND = "feature string, feature_type string, method string, effect_size double, direction double, p double, rows_used long"


def _known(x) -> float | None:
    return float(x) if x is not None and math.isfinite(x) else None


def _kruskal(df: DataFrame, group: str, value: str) -> tuple:
    r = stats.kruskal(df, group, value).first()
    h, e = (_known(r["h"]), _known(r["epsilon_squared"])) if r["n"] and r["k"] > 1 and r["n"] > r["k"] else (None, None)
    return KRUSKAL, None if e is None else min(max(e, 0.0), 1.0), None, None if h is None else special.chi2_sf(h, r["k"] - 1), r["n"] or 0


def _cramer(df: DataFrame, a: str, b: str) -> tuple:
    r = stats.chi2(df, a, b).first()
    ok = r["n"] is not None and r["df"] > 0
    return CRAMER, _known(r["cramers_v_corrected"]) if ok else None, None, special.chi2_sf(r["chi2"], r["df"]) if ok else None, r["n"] or 0


def _spearman(df: DataFrame, a: str, b: str) -> tuple:
    r = stats.spearman(df, a, b).first()
    rho, n = _known(r["rho"]), r["n"]
    p = None
    if rho is not None and n > 2:
        p = 0.0 if abs(rho) >= 1 else special.t_sf2(abs(rho) * math.sqrt((n - 2) / (1 - rho * rho)), n - 2)
    return SPEARMAN, None if rho is None else abs(rho), rho, p, n


def associations(df: DataFrame, target: str, numeric: list[str], categorical: list[str], classes: bool, alpha: float = 0.05) -> DataFrame:
    """A row for each feature: feature, feature_type, method, effect_size, direction, p, q, rows_used, missing_percent, strength, significant, note, rank.

    A target of classes is tested by Kruskal-Wallis (numbers) and corrected
    Cramer's V (categories), a number by Spearman's correlation and by
    Kruskal-Wallis over the categories.  p-values are adjusted, and effects
    ranked (equal ones share the least rank), within each method.  A test
    without enough rows or groups has null effect, p and q, and comes last.
    The tests are aggregates; one row of each reaches the driver.
    """
    found = []
    for c in numeric:
        found.append((c, "numeric", *(_kruskal(df, target, c) if classes else _spearman(df, c, target))))
    for c in categorical:
        found.append((c, "categorical", *(_cramer(df, c, target) if classes else _kruskal(df, c, target))))
    names = [*numeric, *categorical]
    lost = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(names)]).first()
    share = {c: round(100 * lost[f"_m{i}"] / lost["_n"], 4) if lost["_n"] else 0.0 for i, c in enumerate(names)}
    d = df.sparkSession.createDataFrame([(*r, share[r[0]]) for r in found], _FOUND + ", missing_percent double")
    d = order.adjust_p(d, ["method"], "p", "q").withColumn("strength", screening.effect_label(F.col("method"), F.col("effect_size")))
    d = d.withColumn("significant", F.coalesce(F.col("q") <= alpha, F.lit(False))).withColumn("note", screening.selection_note(F.col("strength"), F.col("q"), alpha))
    better = d.select(F.col("method").alias("_m"), F.col("effect_size").alias("_e"))  # a row for each feature
    met = d.join(better, (F.col("method") == F.col("_m")) & (F.col("_e") > F.coalesce("effect_size", F.lit(-1.0))), "left")
    return met.groupBy(*d.columns).agg((F.count("_e") + 1).cast("int").alias("rank"))


def redundancy(df: DataFrame) -> Callable[[str, str, str], float | None]:
    """|Spearman's correlation| of two numbers, Cramer's V of two categories, computed when asked."""
    seen: dict = {}

    def of(kind: str, a: str, b: str) -> float | None:
        pair = (kind, *sorted((a, b)))
        if pair not in seen:
            r = stats.spearman(df, *pair[1:]).first()["rho"] if kind == "numeric" else stats.chi2(df, *pair[1:]).first()["cramers_v"]
            seen[pair] = None if _known(r) is None else abs(r)
        return seen[pair]

    return of


def proposal(found: DataFrame, flags: DataFrame, pair: Callable[[str, str, str], float | None], excluded: Iterable[str] = (), threshold: float = 0.9, most: int | None = None, blocking: Iterable[str] = ("constant", "quasi_constant", "high_missing")) -> DataFrame:
    """A row for each feature of ``found``: position, feature, feature_type, action, reason, method, effect_size, q, missing_percent, redundant_with, redundancy.

    In this order: ``excluded`` features and those named ``eda_...`` go; so do
    columns that ``flags`` (column_name, flag) marks with a blocking flag;
    what has an effect and evidence is used, what has neither goes, the rest
    is for review.  Of those to use, by rank within their method, then least
    missing, then name, one that goes with a feature kept before it (``pair``
    at ``threshold`` or more, of the same type) is for review, as are those
    beyond the ``most`` first.  Features are few: a row each reaches the
    driver, and only pairs that the rule meets are computed.
    """
    marks: dict[str, set] = {}
    for r in flags.collect():  # a few for each column
        marks.setdefault(r["column_name"], set()).add(r["flag"])
    excluded, blocking, out, kept = set(excluded), set(blocking), [], []
    for r in sorted(found.collect(), key=lambda r: (r["rank"], r["missing_percent"], r["feature"])):
        f, kind, twin, strength = r["feature"], r["feature_type"], None, None
        bad = sorted(marks.get(f, set()) & blocking)
        if f in excluded or f.startswith("eda_"):
            action, reason = "exclude", "excluded by name"
        elif bad:
            action, reason = "exclude", "quality: " + ", ".join(bad)
        elif r["note"] == screening.NOTES[False, False]:
            action, reason = "exclude", r["note"]
        elif r["note"] != screening.NOTES[True, True]:
            action, reason = "review", r["note"]
        else:
            action, reason = "use", r["note"]
            for k, other in kept:
                v = pair(kind, f, other) if k == kind else None
                if v is not None and v >= threshold:
                    action, reason, twin, strength = "review", "redundant", other, v
                    break
            else:
                kept.append((kind, f))
                if most is not None and len(kept) > most:
                    action, reason = "review", "beyond the shortlist"
        out.append((action, r["rank"], r["missing_percent"], f, kind, reason, r["method"], r["effect_size"], r["q"], twin, strength))
    out.sort(key=lambda r: (("use", "review", "exclude").index(r[0]), *r[1:4]))
    rows = [(i + 1, f, kind, action, reason, method, effect, q, missing, twin, strength) for i, (action, _, missing, f, kind, reason, method, effect, q, twin, strength) in enumerate(out)]
    return found.sparkSession.createDataFrame(rows, "position int, feature string, feature_type string, action string, reason string, method string, effect_size double, q double, missing_percent double, redundant_with string, redundancy double")
