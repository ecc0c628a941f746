"""The Fellegi-Sunter model value: a prior and, per comparison column, per-level m and u.

Levels are numbered worst first: 0 is "else", ``n_levels - 1`` is an exact match, and
``NULL_LEVEL`` (-1) marks a NULL on either side (factor 1). A model is small: it can be
saved as JSON or as a table of ``(column, kind, level, m, u)`` rows plus a prior row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .constants import (
    DEFAULT_PRIOR,
    EDIT_DISTANCE_THRESHOLDS,
    NAME_JW_THRESHOLDS,
    NAME_LIKE_COLUMNS,
    default_m_u,
)

KINDS = ("name", "edit")


@dataclass(frozen=True)
class Comparison:
    """How one column is compared: ``kind`` "name" (Jaro-Winkler bands) or "edit" (Levenshtein bands)."""

    column: str
    kind: str
    thresholds: tuple[float, ...]
    m: tuple[float, ...]
    u: tuple[float, ...]

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"comparison kind must be one of {KINDS}, got {self.kind!r}")
        n = len(self.thresholds) + 2
        if len(self.m) != n or len(self.u) != n:
            raise ValueError(f"comparison on {self.column!r} needs {n} m and u values")

    @property
    def n_levels(self) -> int:
        return len(self.thresholds) + 2

    @property
    def exact_level(self) -> int:
        return self.n_levels - 1

    @property
    def factors(self) -> tuple[float, ...]:
        return tuple(mi / ui for mi, ui in zip(self.m, self.u))

    def band_levels(self) -> list[tuple[float, int]]:
        """(threshold, level) for the fuzzy bands, best band first."""
        return [(t, self.exact_level - 1 - i) for i, t in enumerate(self.thresholds)]

    @classmethod
    def default(cls, column: str) -> Comparison:
        """Jaro-Winkler bands for name-like columns (case-insensitive test), edit distance otherwise."""
        if column.lower() in NAME_LIKE_COLUMNS:
            kind, thresholds = "name", tuple(float(t) for t in NAME_JW_THRESHOLDS)
        else:
            kind, thresholds = "edit", tuple(float(t) for t in EDIT_DISTANCE_THRESHOLDS)
        m, u = default_m_u(len(thresholds) + 2)
        return cls(column, kind, thresholds, tuple(m), tuple(u))

    def to_dict(self) -> dict[str, Any]:
        return {
            "column": self.column,
            "kind": self.kind,
            "thresholds": list(self.thresholds),
            "m": list(self.m),
            "u": list(self.u),
        }

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> Comparison:
        return cls(
            d["column"],
            d["kind"],
            tuple(float(x) for x in d["thresholds"]),
            tuple(float(x) for x in d["m"]),
            tuple(float(x) for x in d["u"]),
        )


@dataclass(frozen=True)
class Model:
    """Prior match probability plus one :class:`Comparison` per column, in scoring order."""

    prior: float
    comparisons: tuple[Comparison, ...]
    trained: tuple[str, ...] = field(default=())
    #: Blocking rules: pairs that agree on all columns of one of them are compared. Empty: each compared column.
    blocking: tuple[tuple[str, ...], ...] = field(default=())
    #: Further rules ``(column, edits)``: pairs whose values are at most so many edits apart are compared too.
    near: tuple[tuple[str, int], ...] = field(default=())

    def __post_init__(self) -> None:
        rules = tuple((r,) if isinstance(r, str) else tuple(r) for r in self.blocking)
        if any(not r for r in rules):
            raise ValueError("a blocking rule needs at least one column")
        object.__setattr__(self, "blocking", rules)
        object.__setattr__(self, "near", tuple((str(c), int(k)) for c, k in self.near))
        if not 0.0 < self.prior < 1.0:
            raise ValueError(f"prior must be in (0, 1), got {self.prior}")
        names = [c.column for c in self.comparisons]
        if len(set(names)) != len(names):
            raise ValueError(f"a column is compared twice: {names}")

    @property
    def columns(self) -> list[str]:
        return [c.column for c in self.comparisons]

    @property
    def rules(self) -> list[tuple[str, ...]]:
        """The blocking rules in use."""
        return list(self.blocking) or [(c,) for c in self.columns]

    @property
    def all_columns(self) -> list[str]:
        """Compared columns, then further columns of the blocking rules."""
        return list(dict.fromkeys([*self.columns, *[c for r in self.rules for c in r], *[c for c, _ in self.near]]))

    def renamed(self, names: dict[str, str]) -> Model:
        """The same model over other column names."""
        return replace(
            self,
            comparisons=tuple(replace(c, column=names[c.column]) for c in self.comparisons),
            blocking=tuple(tuple(names[c] for c in r) for r in self.rules),
            near=tuple((names[c], k) for c, k in self.near),
        )

    @property
    def prior_odds(self) -> float:
        return self.prior / (1.0 - self.prior)

    @classmethod
    def default(cls, columns: list[str], prior: float = DEFAULT_PRIOR) -> Model:
        return cls(float(prior), tuple(Comparison.default(c) for c in columns))

    def comparison(self, column: str) -> Comparison:
        for c in self.comparisons:
            if c.column == column:
                return c
        raise KeyError(column)

    def with_prior(self, prior: float) -> Model:
        return replace(self, prior=float(prior))

    def with_comparison(self, comp: Comparison) -> Model:
        return replace(self, comparisons=tuple(comp if c.column == comp.column else c for c in self.comparisons))

    # --- persistence ------------------------------------------------------

    def to_json(self) -> str:
        return json.dumps(
            {"prior": self.prior, "comparisons": [c.to_dict() for c in self.comparisons], "trained": list(self.trained),
             "blocking": [list(r) for r in self.blocking], "near": [list(r) for r in self.near]},
            sort_keys=True,
        )

    @classmethod
    def from_json(cls, text: str | dict[str, Any]) -> Model:
        d = json.loads(text) if isinstance(text, str) else text
        return cls(
            float(d["prior"]),
            tuple(Comparison.from_dict(c) for c in d["comparisons"]),
            tuple(d.get("trained", ())),
            tuple(tuple(r) for r in d.get("blocking", ())),
            tuple((c, int(k)) for c, k in d.get("near", ())),
        )

    @classmethod
    def from_file(cls, path: str, spark: SparkSession | None = None) -> Model:
        """A model saved with :meth:`save`: JSON text in a file or folder that Spark can read (shared storage included)."""
        spark = spark or SparkSession.builder.getOrCreate()
        return cls.from_json("".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        """Write the model's JSON as a text table (a folder of one file) that every executor can reach."""
        spark = spark or SparkSession.builder.getOrCreate()
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    TABLE_SCHEMA = T.StructType(
        [
            T.StructField("position", T.IntegerType(), False),
            T.StructField("column", T.StringType(), True),
            T.StructField("kind", T.StringType(), True),
            T.StructField("level", T.IntegerType(), True),
            T.StructField("threshold", T.DoubleType(), True),
            T.StructField("m", T.DoubleType(), True),
            T.StructField("u", T.DoubleType(), True),
            T.StructField("prior", T.DoubleType(), True),
        ]
    )

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        """One row per (column, level), one at position -1 with the prior, and one per column of blocking rule k at position -2 - k; near rules follow, with the edits as level."""
        rows = [(-1, None, None, None, None, None, None, self.prior)]
        for pos, c in enumerate(self.comparisons):
            bands = dict((lvl, t) for t, lvl in c.band_levels())
            for lvl in range(c.n_levels):
                rows.append((pos, c.column, c.kind, lvl, bands.get(lvl), c.m[lvl], c.u[lvl], None))
        for k, rule in enumerate(self.blocking):
            rows += [(-2 - k, c, "block", i, None, None, None, None) for i, c in enumerate(rule)]
        rows += [(-2 - len(self.blocking) - k, c, "near", edits, None, None, None, None) for k, (c, edits) in enumerate(self.near)]
        return spark.createDataFrame(rows, self.TABLE_SCHEMA)

    @classmethod
    def from_dataframe(cls, df: DataFrame) -> Model:
        """Inverse of :meth:`to_dataframe`; the model table is small by construction."""
        rows = sorted(df.collect(), key=lambda r: (r["position"], r["level"] if r["level"] is not None else -1))
        prior = next(r["prior"] for r in rows if r["position"] == -1)
        comps: list[Comparison] = []
        for pos in sorted({r["position"] for r in rows if r["position"] >= 0}):
            levels = [r for r in rows if r["position"] == pos]
            bands = [r for r in levels if r["threshold"] is not None]
            bands.sort(key=lambda r: -r["level"])
            comps.append(
                Comparison(
                    levels[0]["column"],
                    levels[0]["kind"],
                    tuple(r["threshold"] for r in bands),
                    tuple(r["m"] for r in levels),
                    tuple(r["u"] for r in levels),
                )
            )
        blocks = sorted({r["position"] for r in rows if r["kind"] == "block"}, reverse=True)
        rules = tuple(tuple(r["column"] for r in rows if r["position"] == p) for p in blocks)
        near = sorted((r for r in rows if r["kind"] == "near"), key=lambda r: -r["position"])
        return cls(prior, tuple(comps), blocking=rules, near=tuple((r["column"], r["level"]) for r in near))
