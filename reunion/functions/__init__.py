"""Column functions: string similarity, agreement levels, Fellegi-Sunter probabilities."""

from .levels import distance_sql, level_sql, match_probability_sql, odds_sql
from .similarity import jaro_winkler, jaro_winkler_udf, register_jaro_winkler

__all__ = [
    "distance_sql",
    "jaro_winkler",
    "jaro_winkler_udf",
    "level_sql",
    "match_probability_sql",
    "odds_sql",
    "register_jaro_winkler",
]
