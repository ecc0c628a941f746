"""u of edit-distance columns over all pairs of records, without a sample and without making the pairs.

A column's pairs fall into levels by their values only. So one histogram of the values is enough: equal values
give the sum of ``n (n - 1) / 2``, pairs of different values within the widest band come from the segment index of
``near`` and weigh the product of their counts, and all other pairs are what is left of ``N (N - 1) / 2``.
Work grows with the distinct values and the near pairs among them, not with the pairs of records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Comparison, Model
from ..session import release, traced, write_table
from .blocking import DEFAULT_BLOCK_SPLIT
from .near import NearValues, value_distances

_WHOLE = "DECIMAL(38, 0)"


def _counted(rows: DataFrame, comp: Comparison, id_col: str, unit: str, block_split: int | None) -> tuple[DataFrame, str]:
    if comp.kind != "edit":
        raise ValueError(f"levels of {comp.column} are not edit distances")
    near = NearValues(rows, comp.column, int(max(comp.thresholds)), id_col=id_col, unit=unit, block_split=block_split)
    bands = " ".join(f"WHEN distance <= {int(t)} THEN {len(comp.thresholds) - i}" for i, t in enumerate(comp.thresholds))
    held = near.values.select("vid", F.col("holders").cast("decimal(19, 0)").alias("h"))
    pairs = value_distances(near, rows, id_col).join(held.selectExpr("vid AS a", "h AS ha"), "a").join(held.selectExpr("vid AS b", "h AS hb"), "b")
    parts = [
        pairs.selectExpr(f"CASE {bands} END AS level", f"CAST(ha * hb AS {_WHOLE}) AS n").groupBy("level").agg(F.sum("n").alias("n")),
        held.selectExpr(f"{comp.exact_level} AS level", f"CAST(h * (h - 1) / 2 AS {_WHOLE}) AS n"),
        held.selectExpr("-1 AS level", f"CAST(h AS {_WHOLE}) AS n"),  # the records that have a value
    ]
    stacked = parts[0].selectExpr("level", f"CAST(n AS {_WHOLE}) AS n").unionByName(parts[1]).unionByName(parts[2])
    sums = stacked.agg(*[F.coalesce(F.sum(F.when(F.col("level") == k, F.col("n"))), F.lit(0)).cast("decimal(38, 0)").alias(f"l{k + 1}") for k in range(-1, comp.n_levels)])
    others = " - ".join(f"l{k + 1}" for k in range(1, comp.n_levels))
    values = [f"CAST(l0 * (l0 - 1) / 2 - {others} AS {_WHOLE})", *[f"CAST(l{k + 1} AS {_WHOLE})" for k in range(1, comp.n_levels)]]
    name = comp.column.replace("\\", "\\\\").replace("'", "\\'")
    each = ", ".join(f"named_struct('column', '{name}', 'level', {k}, 'pairs', {v})" for k, v in enumerate(values))
    return sums.selectExpr(f"inline(array({each}))"), near.folder


def exact_level_counts(rows: DataFrame, comp: Comparison, *, id_col: str = "uid", unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT) -> DataFrame:
    """``(column, level, pairs)`` of every level of an edit-distance column over all pairs of records with a value, as decimals.

    The counts are written, so that the tables and shuffle files behind them go before another column is counted.
    """
    counts, folder = _counted(rows, comp, id_col, unit, block_split)
    out, _ = write_table(counts, "exact-levels", clear=True)
    release(rows.sparkSession, [folder])
    return out


def exact_u(slim: DataFrame, model: Model, *, unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT) -> dict[str, dict[int, float]]:
    """u of the model's edit-distance columns, level by level; columns without any pair, and name columns, are left out."""
    out: dict[str, dict[int, float]] = {}
    for comp in model.comparisons:
        if comp.kind != "edit":
            continue
        counts, folder = _counted(slim, comp, "uid", unit, block_split)
        with traced("train-u-exact"):
            found = {r["level"]: int(r["pairs"]) for r in counts.collect()}  # one row per level
        release(slim.sparkSession, [folder])
        total = sum(found.values())
        if total:
            out[comp.column] = {level: n / total for level, n in found.items()}
    return out
