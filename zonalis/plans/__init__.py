"""The registered queries of the engine's own operators."""

from . import decisions, extras, matches, models, places, polygons, profiles, rasters, samples, screening, shapes, tests_of  # noqa: F401  (each registers its queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
