"""Pair-table stages: agreement levels, Fellegi-Sunter probability, threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PROB_COL
from ..functions.levels import jw_bound_sql, level_sql, match_probability_sql, q, sql_double
from ..functions.similarity import register_jaro_winkler
from ..model import Model


def level_col(column: str) -> str:
    return f"{column}_level"


def compare_pairs(
    pairs: DataFrame, model: Model, *, unit: str = "byte", keep_values: bool = False, edit_unit: str | None = None
) -> DataFrame:
    """Add ``<c>_level`` for every comparison of ``model`` to a pair table with ``<c>_l``/``<c>_r``.

    ``edit_unit`` overrides the unit of the edit-distance comparisons, e.g. ``"char"`` when
    their values were already mapped to one character per byte (see ``byte_chars``).
    """
    jw = None
    if any(c.kind == "name" for c in model.comparisons):
        jw = register_jaro_winkler(pairs.sparkSession, unit)
    levels = [
        f"{level_sql(comp, q(comp.column + '_l'), q(comp.column + '_r'), unit if comp.kind == 'name' else (edit_unit or unit), jw)}"
        f" AS {q(level_col(comp.column))}"
        for comp in model.comparisons
    ]
    value_cols = {f"{c}{s}" for c in model.columns for s in ("_l", "_r")}
    keep = [q(c) for c in pairs.columns if keep_values or c not in value_cols]
    return pairs.selectExpr(*keep, *levels)


def score_pairs(levels: DataFrame, model: Model, digits: int | None = None) -> DataFrame:
    """Add ``match_probability`` from the level columns (prior odds times factors, in column order), rounded if digits are given."""
    prob = match_probability_sql(model, [q(level_col(c)) for c in model.columns], digits)
    return levels.selectExpr("*", f"{prob} AS {PROB_COL}")


def link_pairs(scored: DataFrame, threshold: float) -> DataFrame:
    """Pairs at or above the threshold: the edges of the match graph."""
    return scored.where(F.col(PROB_COL) >= F.lit(float(threshold)))


# Margin below the threshold kept by the bound, so floating-point rounding can never drop a link.
PRUNE_MARGIN = 1e-12


def prune_unreachable(
    pairs: DataFrame, model: Model, threshold: float, *, unit: str = "byte", edit_unit: str | None = None
) -> DataFrame:
    """Drop pairs that cannot reach ``threshold`` before any Jaro-Winkler is computed.

    Edit-distance levels are computed exactly (JVM side); a name column that is set and differs gets
    the most favourable level that a native bound of its Jaro-Winkler similarity (shared symbols and common
    prefix) still allows. The probability of that pattern bounds the true one from above, so only
    pairs below the threshold are removed and the links are unchanged. Without a name
    comparison there is nothing to save.
    """
    if threshold <= 0.0 or not any(c.kind == "name" for c in model.comparisons):
        return pairs
    levels = []
    for comp in model.comparisons:
        left, right = q(comp.column + "_l"), q(comp.column + "_r")
        if comp.kind == "name":
            # best[k]: the level of the largest factor among levels 0..k
            best = [max(range(k + 1), key=lambda lv: comp.factors[lv]) for k in range(comp.exact_level)]
            bound = jw_bound_sql(left, right)
            bands = " ".join(f"WHEN b >= {sql_double(t - 1e-6)} THEN {best[lvl]}" for t, lvl in comp.band_levels())
            reach = f"element_at(transform(array({bound}), b -> CASE {bands} ELSE {best[0]} END), 1)"
            levels.append(
                f"(CASE WHEN {left} IS NULL OR {right} IS NULL THEN -1 WHEN {left} = {right} THEN {comp.exact_level} ELSE {reach} END)"
            )
        else:
            levels.append(f"({level_sql(comp, left, right, edit_unit or unit)})")
    bound = match_probability_sql(model, levels)
    return pairs.where(f"{bound} >= {sql_double(float(threshold) - PRUNE_MARGIN)}")
