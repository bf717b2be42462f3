"""Scalar functions and rule tables as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Literals that stand for missing.
NULL_LITERALS = ("0", "-1", "NONE", "NULL", "UNKNOWN", "NAN", "")
#: Metres in a unit.
METRES = {"m": 1.0, "km": 1000.0, "ft": 0.3048, "mi": 1609.344, "degree": 111_320.0}


def null_literals(c: Column) -> Column:
    return F.when(~F.upper(F.trim(c.cast("string"))).isin(*NULL_LITERALS), c)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; null where either is missing or b is nought."""
    return F.when(F.abs(b) > 0, a / b)


def _diff(a: Column, b: Column) -> Column:
    return safe_ratio(a - b, a + b)


def _msavi(nir: Column, red: Column) -> Column:
    inner = (2 * nir + 1) * (2 * nir + 1) - 8 * (nir - red)
    return F.when(inner >= 0, (2 * nir + 1 - F.sqrt(inner)) / 2)


#: Spectral indices by name: the roles they need and their formula.
INDICES = {
    "NDVI": (("nir", "red"), _diff),
    "NDWI": (("green", "nir"), _diff),
    "MNDWI": (("green", "swir1"), _diff),
    "NDMI": (("nir", "swir1"), _diff),
    "NBR": (("nir", "swir2"), _diff),
    "GNDVI": (("nir", "green"), _diff),
    "EVI": (("nir", "red", "blue"), lambda n, r, b: safe_ratio(2.5 * (n - r), n + 6 * r - 7.5 * b + 1)),
    "SAVI": (("nir", "red"), lambda n, r: safe_ratio(1.5 * (n - r), n + r + 0.5)),
    "MSAVI": (("nir", "red"), _msavi),
    "NDRE": (("nir", "red_edge"), _diff),
    "PSRI": (("red", "blue", "red_edge2"), lambda r, b, e: safe_ratio(r - b, e)),
    "CI": (("nir", "red_edge"), lambda n, e: safe_ratio(n, e) - 1),
}


def index(name: str, roles: dict[str, Column]) -> Column:
    needs, formula = INDICES[name]
    return formula(*[roles[r] for r in needs])


def radar_index(name: str, vv: Column, vh: Column) -> Column:
    """R = VV / VH, RVI = 4 VH / (VV + VH); a negative intensity is an error when the plan runs."""
    bad = (vv < 0) | (vh < 0)
    value = safe_ratio(vv, vh) if name == "R" else safe_ratio(4 * vh, vv + vh)
    return F.when(bad, F.raise_error(F.lit("negative intensity")).cast("double")).otherwise(value)


def shape(area: Column, perimeter: Column) -> dict[str, Column]:
    return {"compactness": safe_ratio(4 * math.pi * area, perimeter * perimeter), "perimeter_area": safe_ratio(perimeter, area), "shape_index": safe_ratio(perimeter, 2 * F.sqrt(math.pi * area))}


def complexity(compactness: Column, shape_index: Column, elongation: Column) -> Column:
    """Mean of three logarithmic penalties; null if one is."""
    return (F.abs(F.log(compactness)) + F.log(shape_index) + F.log(elongation)) / 3


def unit_factor(a: str, b: str) -> float:
    return METRES[a] / METRES[b]


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + F.least(F.floor((lon + 180) / 6) + 1, F.lit(60))


def borda(rank: Column, n: Column) -> Column:
    """100 for the best of n classes, 0 for the last."""
    return F.when(n > 1, F.greatest(F.least(100.0 * (n - rank) / (n - 1), F.lit(100.0)), F.lit(0.0)))


def display_name(c: Column) -> Column:
    return F.initcap(F.replace(F.trim(c), F.lit("_"), F.lit(" ")))


def label_text(c: Column) -> Column:
    """A label as text: trimmed, without the ``.0`` of whole numbers."""
    return F.regexp_replace(F.trim(c.cast("string")), r"^(-?[0-9]+)\.0$", "$1")


def redact(c: Column) -> Column:
    """URLs and values after secret-like names hidden."""
    hidden = F.regexp_replace(c, r"https?://[^ \"]+", "[url]")
    return F.regexp_replace(hidden, r"(password|token|secret)(\"?\s*[=:]\s*\"?)[^\s\"&,}]+", "$1$2[hidden]")


def temporal_name(c: Column) -> dict[str, Column]:
    """``<source>_<statistic>__<yyyymmdd>`` taken apart."""
    pattern = r"^(.+)_([^_]+)__(\d{8})$"
    return {k: F.regexp_extract(c, pattern, i + 1) for i, k in enumerate(("source", "statistic", "date"))}


def normalised(weights: Column, p: Column) -> Column:
    """An array of probabilities times weights, divided by its sum; a sum of nought stays nought."""
    raw = F.zip_with(p, weights, lambda a, w: a * w)
    total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raw, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def signature(*columns: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def case(rules: list[tuple[Column, str]], default: str | None) -> Column:
    """The value of the first rule that holds."""
    out = None
    for cond, value in rules:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))  # type: ignore[union-attr]


def reasons(rules: list[tuple[Column, str]], none: str = "NONE") -> Column:
    """Codes of all rules that hold, in order, joined by a bar."""
    joined = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(v)) for c, v in rules])), "|")
    return F.when(joined == "", F.lit(none)).otherwise(joined)
