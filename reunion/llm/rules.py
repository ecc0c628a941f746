"""Quality rules: base counts per text, then robust multivariate outliers.

Counts of every text are turned into a statistic vector on stable scales. For each language
and source a minimum-covariance-determinant estimate (centre and covariance of the
most concentrated share of its rows) is fitted by concentration steps, and a text is rejected
when its squared Mahalanobis distance exceeds a chi-square quantile.

A step is distributed: distances to the present estimate, a distance quantile per group by
a mergeable sketch, then count, sums and cross products of the rows within it, combined before
the shuffle. So a source with a third of all rows is no single task's work, and only the
estimates (one row per group) are joined back. The start is the group's medians and spreads. Every group
is fitted on all its rows; one too small for an estimate of its own uses its language's, else the one
of all rows. Passed-over scale: each covariance gets a floor on its diagonal, as some counts are
zero for most texts.

Results for odd input: a null text has no words (and fails the base rules); null language or
source are groups of their own; null ids and repeated rows keep their rows; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_batches, picked, utf8

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Share of a group's rows that an estimate is concentrated on.
CORE = 0.75
STEPS = 4
#: Rows that a group needs for an estimate of its own.
MIN_GROUP = 200
#: chi-square quantile (4 degrees of freedom) at 1 - 1e-6.
CUTOFF = 33.38
#: E[x^2 | x within the core] falls short of the variance by this factor, for 4 dimensions and a core of 0.75.
CONSISTENCY = 1.6
#: Least standard deviation per statistic. An extreme share alone must be able to pass the cutoff: 1 / floor^2 is above it.
FLOORS = (0.12, 0.04, 0.15, 0.15)
P = len(FLOORS)
SPREAD = 1.4826

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    v = len(index)
    if v < 1 << 20:
        keys = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:  # keep the key within 64 bits
        pairs = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)[1].astype(np.int64)
        keys = pairs * v + ids[2:]
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(n + 3, np.int64)
    at = order[twice]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + 3, -1)
    return int((np.cumsum(hit)[:n] > 0).sum())


def count_text(b: bytes) -> tuple[int, int, int, int, int]:
    words = b.split()
    joined = b"".join(words)
    word_chars = len(joined.decode("utf-8"))
    lines = [x for x in b.split(b"\n") if x and not x.isspace()]
    return len(words), word_chars, len(b) - len(b.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def counted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``(id, lang, source, counts...)`` over whole texts."""
    d = picked(docs, id=id_col, text=text_col, lang=lang_col, source=source_col)
    d = d.select("id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    schema = T.StructType([T.StructField("id", d.schema["id"].dataType), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("n_lines", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(*count_text(t), t.count(b"\n") + 1) for t in utf8(b.column("text"))]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("lang"), b.column("source"), *[pa.array(c, pa.int64()) for c in cols]], ["id", "lang", "source", *_COUNTS, "n_lines"])

    return map_batches(d, run, schema)


def statistics() -> list[Column]:
    """The transformed statistic vector: log word length, and square roots of symbol, repeated-line and repeated-word shares."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log((F.col("word_chars") + 1) / n),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / F.col("n_lines")),
        F.sqrt(F.col("n_repeat_words") / n),
    ]


_PARAMS = ("m", "w")  # centre, and the inverse covariance by rows


def _distance(x: list[str], centre: str, inverse: str) -> Column:
    """Squared Mahalanobis distance as a native expression."""
    d = [F.col(x[i]) - F.col(centre)[i] for i in range(P)]
    return sum((d[i] * d[j] * F.col(inverse)[i * P + j] for i in range(P) for j in range(P)), F.lit(0.0))


def _inverses(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and inverse covariance of each group from its count, sums and cross products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.diag(np.square(FLOORS))
        for b in batches:
            n = b.column("n").to_numpy(zero_copy_only=False).astype(float)
            s = np.array(b.column("s").to_pylist(), float).reshape(-1, P)
            c = np.array(b.column("c").to_pylist(), float).reshape(-1, P, P)
            m = s / n[:, None]
            cov = CONSISTENCY * (c / n[:, None, None] - m[:, :, None] * m[:, None, :]) + floor
            w = np.linalg.inv((cov + cov.transpose(0, 2, 1)) / 2).reshape(-1, P * P) if len(n) else np.zeros((0, P * P))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], pa.array(m.tolist(), pa.list_(pa.float64())), pa.array(w.tolist(), pa.list_(pa.float64()))], [*keys, "m", "w"])

    schema = T.StructType([*[T.StructField(k, moments.schema[k].dataType) for k in keys], T.StructField("m", T.ArrayType(T.DoubleType())), T.StructField("w", T.ArrayType(T.DoubleType()))])
    return moments.mapInArrow(run, schema)


def fit(stats: DataFrame, scratch: Scratch) -> DataFrame:
    """``(level, lang, source, m, w)``: an estimate for each group with enough rows, each language, and all rows.

    ``stats`` holds ``lang, source`` and the statistics ``x0..``; level 0 is (lang, source), 1 is lang, 2 is all.
    """
    x = [f"x{i}" for i in range(P)]
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), (F.col("lang") if k < 2 else F.lit(None).cast("string")).alias("lang"), (F.col("source") if k < 1 else F.lit(None).cast("string")).alias("source")) for k in range(3)]))
    rows = stats.select(levels.alias("g"), *x).select("g.level", "g.lang", "g.source", *x)
    keys = ["level", "lang", "source"]
    start = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_all"), *[F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{c}") for c in x])
    start = start.where(f"n_all >= {MIN_GROUP} OR level = 2")
    spread = [F.greatest((F.col(f"q{c}")[2] - F.col(f"q{c}")[0]) / 2 * SPREAD, F.lit(f)) for c, f in zip(x, FLOORS)]
    weights = [(1 / (spread[i] * spread[i])) if i == j else F.lit(0.0) for i in range(P) for j in range(P)]
    params = scratch.write(start.select(*keys, F.array(*[F.col(f"q{c}")[1] for c in x]).alias("m"), F.array(*weights).alias("w")), "mcd-start")
    for step in range(STEPS):
        placed = _joined(rows, params, keys).withColumn("d", _distance(x, "m", "w"))
        limit = scratch.write(placed.groupBy(*keys).agg(F.percentile_approx("d", F.lit(CORE), 2000).alias("limit")), f"mcd-limit{step}")
        core = _joined(placed.drop("m", "w"), limit, keys).where("d <= limit")
        moments = core.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(c) for c in x]).alias("s"),
            F.array(*[F.sum(F.col(x[i]) * F.col(x[j])) for i in range(P) for j in range(P)]).alias("c"),
        )
        params = scratch.write(_inverses(moments, keys), f"mcd-step{step}")
    return params


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on the keys; ``right`` has one row per key and is a written table, so Spark knows its size."""
    r = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    cond = on[0]
    for o in on[1:]:
        cond = cond & o
    return left.join(r, cond, how).drop(*[f"_{k}" for k in keys])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row: id, base counts, ``base_failed``, ``kept``, and the squared distance that decided."""
    scratch = Scratch(docs.sparkSession)
    x = [f"x{i}" for i in range(P)]
    counts = counted(docs, id_col, text_col, lang_col, source_col)
    stats = scratch.write(counts.select("*", *[s.alias(c) for s, c in zip(statistics(), x)]), "stats")
    params = fit(stats.where("n_words > 0"), scratch)
    own, lang = (params.where(f"level = {k}").drop("level") for k in range(2))
    out = stats
    for k, (p, keys) in enumerate(((own, ["lang", "source"]), (lang.drop("source"), ["lang"]))):
        out = _joined(out, p.withColumnsRenamed({"m": f"m{k}", "w": f"w{k}"}), keys, "left")
    # the estimate of all rows is one row; without any row there is none
    every = params.where("level = 2").select("m", "w").collect()
    none = F.lit(None).cast("array<double>")
    m, w = (F.array(*map(F.lit, x)) for x in every[0]) if every else (none, none)
    out = out.withColumn("m", F.coalesce("m0", "m1", m)).withColumn("w", F.coalesce("w0", "w1", w))
    out = out.withColumn("distance", _distance(x, "m", "w"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(F.col("id").alias(id_col), *_COUNTS, failed.alias("base_failed"), (~failed & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))).alias("kept"), F.col("distance"))
