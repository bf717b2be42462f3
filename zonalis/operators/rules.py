"""Inspection scores, the decision table for label and evidence, check types, reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import case, label_text, reasons
from .order import with_percent_rank

#: Weights of the three risks, bands of the score, boundaries of data reliability and geometry risk.
WEIGHTS = {"confidence": 0.60, "data": 0.25, "geometry": 0.15}
SCORE_HIGH, SCORE_MEDIUM = 50.0, 25.0
DATA_LOW, DATA_MEDIUM = 0.60, 0.80
GEOMETRY_MEDIUM, GEOMETRY_HIGH = 0.50, 0.75
#: The decision table.  Class reliability, rank confidence, reliable data, plain geometry (None: any); need if labels agree; need if they differ.
TABLE = [
    ("HIGH", "HIGH", True, True, "VERY_LOW", "VERY_HIGH"),
    ("HIGH", "HIGH", True, False, "LOW", "HIGH"),
    ("MEDIUM", "HIGH", True, True, "LOW", "HIGH"),
    ("MEDIUM", "HIGH", True, False, "LOW_MEDIUM", "MEDIUM_HIGH"),
    ("HIGH", "MEDIUM", True, True, "LOW_MEDIUM", "MEDIUM_HIGH"),
    ("HIGH", "MEDIUM", True, False, "MEDIUM", "MEDIUM"),
    ("MEDIUM", "MEDIUM", True, None, "MEDIUM", "MEDIUM"),
    ("LOW", None, None, None, "MEDIUM", "MEDIUM"),
    (None, "LOW", None, None, "MEDIUM", "MEDIUM"),
    (None, None, False, None, "MEDIUM", "MEDIUM"),
]
BANDS = ["VERY_LOW", "LOW", "LOW_MEDIUM", "MEDIUM", "MEDIUM_HIGH", "HIGH", "VERY_HIGH"]
#: The bands as shown.
SHOWN = {"VERY_LOW": "Very Low", "LOW": "Low", "LOW_MEDIUM": "Low–Medium", "MEDIUM": "Medium", "MEDIUM_HIGH": "Medium–High", "HIGH": "High", "VERY_HIGH": "Very High", "UNKNOWN": "Unknown"}


def declaration_status(declared: Column, predicted: Column) -> Column:
    """UNAVAILABLE without a prediction, NO_DECLARATION without a label, else whether the two agree."""
    return F.when(predicted.isNull(), "UNAVAILABLE").when(declared.isNull(), "NO_DECLARATION").when(label_text(declared) == label_text(predicted), "SAME").otherwise("DIFFERENT")


def risks(df: DataFrame, confidence: str, reliability: str, complexity: str) -> DataFrame:
    """Adds the three risks, the weighted score and its band; a missing part makes the score null."""
    known = F.when(F.col(reliability).between(0.0, 1.0), F.col(reliability))
    c = F.upper(F.trim(F.col(confidence)))
    out = df.withColumn("confidence_risk", F.when(c == "HIGH", 0.0).when(c == "MEDIUM", 0.5).when(c == "LOW", 1.0)).withColumn("data_risk", 1 - known)
    out = with_percent_rank(out.withColumn("_g", F.when(F.col(complexity) >= 0, F.col(complexity))), "_g", "geometry_risk").drop("_g")
    score = 100 * sum((F.col(f"{k}_risk") * w for k, w in WEIGHTS.items()), F.lit(0.0))
    out = out.withColumn("_score", score)
    out = out.withColumn("inspection_score", F.when(F.col("_score").isNotNull(), F.round(F.greatest(F.least("_score", F.lit(100.0)), F.lit(0.0)), 2))).drop("_score")
    s = F.col("inspection_score")
    return out.withColumn("inspection_need_base", F.when(s.isNull(), "UNKNOWN").when(s >= SCORE_HIGH, "HIGH").when(s >= SCORE_MEDIUM, "MEDIUM").otherwise("LOW"))


def decide(df: DataFrame, status: str, confidence: str, reliability: str, geometry: str, level: str, level_valid: str, data_medium: float = DATA_MEDIUM, switch: str | None = None, rank_valid: str | None = None) -> DataFrame:
    """Adds inspection_rule, inspection_need and class_reliability_applied by the table; the first row that fits decides.

    Where the boolean column ``switch`` is false, class reliability is not
    asked for: rows of the table for HIGH classes stand for any class, those
    for MEDIUM and LOW for none.  A false or null ``rank_valid`` makes the
    confidence unusable.
    """
    st, conf, rel, geo = F.col(status), F.upper(F.trim(F.col(confidence))), F.col(reliability), F.col(geometry)
    cls = F.upper(F.trim(F.col(level)))
    usable = F.coalesce(conf.isin("HIGH", "MEDIUM", "LOW") & rel.between(0.0, 1.0) & geo.isNotNull(), F.lit(False))
    if rank_valid is not None:
        usable = usable & F.coalesce(F.col(rank_valid), F.lit(False))
    on = F.lit(True) if switch is None else F.coalesce(F.col(switch), F.lit(True))
    rated = ~on | F.coalesce(F.col(level_valid), F.lit(False)) & F.coalesce(cls.isin("HIGH", "MEDIUM", "LOW"), F.lit(False))

    def fits(row: tuple) -> Column:
        of_class = {"HIGH": ~on | (cls == "HIGH")}.get(row[0], on & (cls == row[0]))
        parts = [of_class] * (row[0] is not None) + [conf == row[1]] * (row[1] is not None)
        parts += [(rel > data_medium) == F.lit(row[2])] * (row[2] is not None) + [(geo < GEOMETRY_MEDIUM) == F.lit(row[3])] * (row[3] is not None)
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out

    same, differ = st == "SAME", st == "DIFFERENT"
    rule, need = F.when(~usable | (st == "UNAVAILABLE"), F.lit("REQUIRED_EVIDENCE_UNAVAILABLE")), F.when(~usable | (st == "UNAVAILABLE"), F.lit("UNKNOWN"))
    rule = rule.when(st == "NO_DECLARATION", "NO_DECLARATION").when(~rated, "CLASS_RELIABILITY_UNAVAILABLE")
    need = need.when((st == "NO_DECLARATION") | ~rated, "MEDIUM")
    for side, offset, at in ((same, 1, 4), (differ, 11, 5)):
        for i, row in enumerate(TABLE):
            rule = rule.when(side & fits(row), f"R{i + offset:02d}")
            need = need.when(side & fits(row), row[at])
    applied = on & usable & rated & F.coalesce(same | differ, F.lit(False))
    return df.withColumn("inspection_rule", rule.otherwise("UNCLASSIFIED")).withColumn("inspection_need", need.otherwise("MEDIUM")).withColumn("class_reliability_applied", applied)


def check_type(status: Column, need: Column, check_matching: bool = False) -> Column:
    conflict = (status == "DIFFERENT") & need.isin("VERY_HIGH", "HIGH", "MEDIUM_HIGH")
    none = need.isin("VERY_LOW", "LOW")
    if not check_matching:
        none = none | (status == "SAME") & need.isin("LOW_MEDIUM", "MEDIUM")
    return case([(conflict, "DECLARATION_CONFLICT"), (none, "NONE")], "INSUFFICIENT_EO_EVIDENCE")


def escalate(need: Column, flagged: Column) -> Column:
    """One band up where flagged; the top band and UNKNOWN stay."""
    up = F.create_map(*[F.lit(x) for a, b in zip(BANDS, BANDS[1:]) for x in (a, b)])
    return F.when(F.coalesce(flagged, F.lit(False)), F.coalesce(up[need], need)).otherwise(need)


def adjust(df: DataFrame, need: str, check: str, flag: str) -> DataFrame:
    """Raises ``need`` one band where ``flag`` holds and the band can rise; adds outlier_adjusted and need_before_outlier.

    A row without a check whose raised band is above LOW gets one; no conflict is made up.
    """
    rises = F.coalesce(F.col(flag), F.lit(False)) & F.col(need).isin(BANDS[:-1])
    out = df.withColumn("need_before_outlier", F.col(need)).withColumn("outlier_adjusted", rises)
    out = out.withColumn(need, escalate(F.col("need_before_outlier"), F.col("outlier_adjusted")))
    review = F.col("outlier_adjusted") & (F.col(check) == "NONE") & ~F.col(need).isin("VERY_LOW", "LOW")
    return out.withColumn(check, F.when(review, "INSUFFICIENT_EO_EVIDENCE").otherwise(F.col(check)))


def priority_label(need: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in SHOWN.items() for x in kv])[need]


def reason_codes(status: Column, check: Column, need: Column, confidence: Column, reliability: Column, geometry: Column, rule: Column, applied: Column | None = None, level: Column | None = None, adjusted: Column | None = None, low: Column | None = None, medium: Column | None = None) -> Column:
    """Stable codes: those of labels first, then confidence, data, geometry, rule, class reliability where it was applied, and outliers."""
    conf = F.upper(F.trim(confidence))
    rel = F.when(reliability.between(0.0, 1.0), reliability)
    low, medium = F.lit(DATA_LOW) if low is None else low, F.lit(DATA_MEDIUM) if medium is None else medium
    conflict = check == "DECLARATION_CONFLICT"
    codes = [
        ((status == "DIFFERENT") & conflict & (need == "VERY_HIGH"), "STRONG_DECLARATION_CONFLICT"),
        ((status == "DIFFERENT") & conflict & (need != "VERY_HIGH"), "DECLARATION_CONFLICT"),
        ((status == "DIFFERENT") & ~conflict, "DECLARATION_PREDICTION_DIFFERENCE"),
        (check == "INSUFFICIENT_EO_EVIDENCE", "INSUFFICIENT_EO_EVIDENCE"),
        (conf == "LOW", "LOW_MODEL_CONFIDENCE"),
        (conf == "MEDIUM", "MEDIUM_MODEL_CONFIDENCE"),
        (F.coalesce(~conf.isin("HIGH", "MEDIUM", "LOW"), F.lit(True)), "INVALID_MODEL_CONFIDENCE"),
        (rel.isNull(), "MISSING_DATA_RELIABILITY"),
        (rel < low, "LOW_DATA_RELIABILITY"),
        ((rel >= low) & (rel <= medium), "MEDIUM_DATA_RELIABILITY"),
        (geometry.isNull(), "MISSING_GEOMETRY_COMPLEXITY"),
        (geometry >= GEOMETRY_HIGH, "HIGH_GEOMETRY_COMPLEXITY"),
        ((geometry >= GEOMETRY_MEDIUM) & (geometry < GEOMETRY_HIGH), "MEDIUM_GEOMETRY_COMPLEXITY"),
        (rule == "CLASS_RELIABILITY_UNAVAILABLE", "CLASS_RELIABILITY_UNAVAILABLE"),
        (rule == "NO_DECLARATION", "NO_DECLARATION"),
    ]
    if applied is not None and level is not None:
        codes += [(applied & (F.upper(F.trim(level)) == x), f"{x}_CLASS_RELIABILITY") for x in ("LOW", "MEDIUM")]
    if adjusted is not None:
        codes.append((adjusted, "OUTLIER_PRIORITY_INCREASE"))
    return reasons(codes)


def reliability_bounds(df: DataFrame, reliability: str, low_q: float = 0.05, medium_q: float = 0.25) -> DataFrame:
    """One row: the boundaries, each the lower of the fixed value and the population's percentile."""
    v = F.when(F.col(reliability).between(0.0, 1.0), F.col(reliability))
    return df.agg(F.least(F.lit(DATA_LOW), F.percentile(v, F.lit(low_q))).alias("low"), F.least(F.lit(DATA_MEDIUM), F.percentile(v, F.lit(medium_q))).alias("medium"))
