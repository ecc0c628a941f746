"""Unsupervised training of the model on the data (opt-in).

T1  prior: pairs inside the blocks of the first column that has any, divided by the
    recall (0.7) and by all N(N-1)/2 pairs. One aggregate over all columns at once.
    Or, for rules of several columns, the pairs of their union by inclusion and exclusion: one aggregate over the
    sets of columns that rules share, no pair is made.
T2  u: level frequencies among random pairs. All records are spread over seeded hash buckets so that about
    ``max_pairs`` pairs share a bucket; pairs come from an equi-join on the bucket (no cross
    product). Records alone in their bucket make no pair: a first join of ids and buckets leaves those that
    do, so only their values are shuffled. The sample is the same on every run.
T3  m: expectation-maximisation, one pass per column blocked on that column, training the
    *other* columns. Records with equal values are one profile, a pair of profiles weighs the
    product of their counts, so copies cost no pairs, and large blocks are counted in matrices (``dense``). All passes share one written table of counts
    per level pattern; an iteration is one aggregate over it, and only the parameters
    (a few numbers per pass and level) reach the driver.
T4  best effort: a step without data is skipped and reported, never an error.
T5  levels never estimated keep their defaults; m and u are floored at 1e-12.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import replace
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_PRIOR,
    EM_MAX_ITERATIONS,
    EM_TOLERANCE,
    NULL_LEVEL,
    PROBABILITY_FLOOR,
    TRAIN_PRIOR_RECALL,
    TRAIN_U_MAX_PAIRS,
    TRAIN_U_SEED,
)
from ..functions.levels import q, sql_array, sql_double
from ..model import Comparison, Model
from ..session import release, traced, write_table
from .blocking import DEFAULT_BLOCK_SPLIT, Rules, as_rules, block_maxima, candidate_pairs, rule_columns, stack_rules
from .dense import DENSE_BLOCK, level_counts
from .scoring import compare_pairs, level_col


def _slim(rows: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    return rows.selectExpr(f"{q(id_col)} AS uid", *[f"CAST({q(c)} AS STRING) AS {q(c)}" for c in columns])


# --- T1 ---------------------------------------------------------------------------


def block_pair_counts(slim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(rule, pairs)`` inside the blocks of every column, plus ``(-1, N)`` rows in total."""
    stacked = stack_rules(slim, columns, id_col="uid")
    per_rule = (
        stacked.groupBy("rule", "key")
        .count()
        .groupBy("rule")
        .agg(F.expr("CAST(sum(count * (count - 1)) div 2 AS BIGINT)").alias("pairs"))
    )
    total = slim.agg(F.lit(-1).alias("rule"), F.count(F.lit(1)).cast("bigint").alias("pairs"))
    return per_rule.unionByName(total)


#: Rules whose union is counted; a record has a row for each distinct set of columns that some of them make up.
MAX_UNION_RULES = 8


def signed_column_sets(rules: Rules) -> dict[tuple[str, ...], int]:
    """Column sets and the factors with which their pair counts add up to the pairs of the rules' union.

    Records agree on several rules when they agree on all their columns, so sets of rules with the same columns fall together.
    """
    rules = list(dict.fromkeys(tuple(sorted(set(r))) for r in as_rules(rules)))
    if not rules or len(rules) > MAX_UNION_RULES:
        raise ValueError(f"between 1 and {MAX_UNION_RULES} different rules, got {len(rules)}")
    out: dict[tuple[str, ...], int] = {}
    for k in range(1, len(rules) + 1):
        for some in combinations(rules, k):
            columns = tuple(sorted(set().union(*some)))
            out[columns] = out.get(columns, 0) + (1 if k % 2 else -1)
    return {c: n for c, n in out.items() if n}


def union_pair_counts(slim: DataFrame, rules: Rules) -> DataFrame:
    """``(records, pairs)``, decimals: records, and pairs of records that agree on all columns of at least one rule, each once.

    A record without a value in a column agrees with none on it. Keys are 128 bits of hash; counts combine map-side, so a hot
    key is a few rows.
    """
    sets = signed_column_sets(rules)
    entries = []
    for k, (columns, sign) in enumerate(sets.items()):
        values = ", ".join(f"CAST({q(c)} AS STRING)" for c in columns)
        both = f"named_struct('sign', {sign}, 'k1', xxhash64({k}, {values}), 'k2', xxhash64({values}, {k}, 'b'))"
        entries.append(f"CASE WHEN {' AND '.join(f'{q(c)} IS NOT NULL' for c in columns)} THEN {both} END")
    keyed = slim.selectExpr(f"explode(array({', '.join(entries)})) AS e").where("e IS NOT NULL").select("e.*")
    n = "CAST(n AS DECIMAL(19, 0))"
    per_key = keyed.groupBy("sign", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    pairs = per_key.selectExpr("CAST(0 AS DECIMAL(38, 0)) AS r", f"CAST(sign * {n} * ({n} - 1) / 2 AS DECIMAL(38, 0)) AS p")
    records = slim.selectExpr("CAST(1 AS DECIMAL(38, 0)) AS r", "CAST(0 AS DECIMAL(38, 0)) AS p")
    total = pairs.unionByName(records).agg(F.sum("r").alias("r"), F.sum("p").alias("p"))
    return total.selectExpr("coalesce(r, 0) AS records", "coalesce(p, 0) AS pairs")


def estimate_prior_of_rules(slim: DataFrame, rules: Rules, recall: float = TRAIN_PRIOR_RECALL) -> float | None:
    """Prior from the pairs of the union of the rules, or None when they make no pair."""
    with traced("train-prior-rules"):
        found = union_pair_counts(slim, rules).collect()[0]
    n, pairs = int(found["records"]), int(found["pairs"])
    if not pairs:
        return None
    return min(max(pairs / recall / (n * (n - 1) / 2), PROBABILITY_FLOOR), 1.0 - PROBABILITY_FLOOR)


def estimate_prior(slim: DataFrame, columns: Sequence[str], recall: float = TRAIN_PRIOR_RECALL) -> tuple[float, str] | None:
    """Prior and the column it came from, or None when no column has a pair."""
    with traced("train-prior"):
        rows = {r["rule"]: r["pairs"] for r in block_pair_counts(slim, columns).collect()}
    n = rows.get(-1, 0)
    total = n * (n - 1) / 2
    for k, c in enumerate(columns):
        pairs = rows.get(k, 0)
        if pairs and total:
            p = pairs / recall / total
            return min(max(p, PROBABILITY_FLOOR), 1.0 - PROBABILITY_FLOOR), c
    return None


# --- T2 ---------------------------------------------------------------------------


def u_buckets(n_rows: int, max_pairs: int = TRAIN_U_MAX_PAIRS) -> int:
    """Number of hash buckets so that pairs sharing a bucket number about ``max_pairs``."""
    return max(1, math.ceil(n_rows * (n_rows - 1) / 2 / max_pairs))


def u_sample_pairs(slim: DataFrame, buckets: int, seed: int = TRAIN_U_SEED) -> DataFrame:
    """Pairs ``uid_l < uid_r`` of records in the same seeded md5 bucket, with their values."""
    cols = [c for c in slim.columns if c != "uid"]
    bucket = f"pmod(CAST(conv(substr(md5(concat('{int(seed)}:', CAST(uid AS STRING))), 1, 15), 16, 10) AS BIGINT), {int(buckets)})"
    tagged = slim.selectExpr("*", f"{bucket} AS _bucket")
    if buckets > 1:  # most buckets of many hold one record: drop these before any value moves
        shared = slim.selectExpr(f"{bucket} AS _bucket").groupBy("_bucket").count().where("count > 1").select("_bucket")
        tagged = tagged.join(shared, "_bucket", "left_semi").select(*[q(c) for c in slim.columns], "_bucket")
    joined = tagged.alias("l").join(tagged.alias("r"), F.expr("l._bucket = r._bucket AND l.uid < r.uid"))
    return joined.selectExpr(
        "l.uid AS uid_l", "r.uid AS uid_r", *[f"{side}.{q(c)} AS {q(c + '_' + side)}" for c in cols for side in ("l", "r")]
    )


def level_frequencies(levels: DataFrame, model: Model) -> DataFrame:
    """``(column, level, n)`` over non-NULL levels, one aggregate for all columns."""
    entries = ", ".join(
        f"named_struct('column', '{c.column}', 'level', {q(level_col(c.column))})" for c in model.comparisons
    )
    return (
        levels.selectExpr(f"inline(array({entries}))")
        .where(f"level <> {NULL_LEVEL}")
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    )


def estimate_u(slim: DataFrame, model: Model, *, n_rows: int, max_pairs: int = TRAIN_U_MAX_PAIRS,
               seed: int = TRAIN_U_SEED, unit: str = "byte") -> tuple[dict[str, dict[int, float]], int]:
    """u per column and observed level (share of the level among sampled pairs with both values set), and the most pairs used."""
    pairs = u_sample_pairs(slim, u_buckets(n_rows, max_pairs), seed)
    with traced("train-u"):
        rows = level_frequencies(compare_pairs(pairs, model, unit=unit), model).collect()
    totals: dict[str, int] = {}
    for r in rows:
        totals[r["column"]] = totals.get(r["column"], 0) + r["n"]
    out: dict[str, dict[int, float]] = {}
    for r in rows:
        out.setdefault(r["column"], {})[r["level"]] = r["n"] / totals[r["column"]]
    return out, max(totals.values(), default=0)


# --- T3 ---------------------------------------------------------------------------


def profiles_of(slim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(uid, values..., weight)``: records of equal values as one, with their number."""
    return slim.groupBy(*[q(c) for c in columns]).agg(F.min("uid").alias("uid"), F.count(F.lit(1)).alias("weight"))


def em_patterns(
    profiles: DataFrame, model: Model, blocked: str, *, unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT
) -> DataFrame:
    """``(pattern levels of the other columns..., n)`` over all pairs of records agreeing on ``blocked``."""
    others = [c for c in model.columns if c != blocked]
    sub = Model(model.prior, tuple(model.comparison(c) for c in others))
    # all pairs agreeing on the blocked column: large blocks in matrices, the others as pairs (one rule, hot blocks salted)
    counted = None
    maxima = block_maxima(stack_rules(profiles, [blocked], id_col="uid"), 1)
    rest = profiles
    if maxima[0] > DENSE_BLOCK:
        counted, rest = level_counts(profiles, blocked, sub, id_col="uid", weight="weight", unit=unit, block_split=block_split)
    pairs = candidate_pairs(rest, [blocked], id_col="uid", carry=[*others, "weight"], block_split=block_split, maxima=maxima)
    levels = compare_pairs(pairs, sub, unit=unit).withColumn("w", F.col("weight_l") * F.col("weight_r"))
    # the records of one profile among themselves: equal wherever a value is set
    exact = [f"CASE WHEN {q(c)} IS NULL THEN {NULL_LEVEL} ELSE {sub.comparison(c).exact_level} END AS {q(level_col(c))}" for c in others]
    copies = profiles.where(f"weight > 1 AND {q(blocked)} IS NOT NULL").selectExpr(*exact, "weight * (weight - 1) div 2 AS w")
    every = levels.select(*[q(level_col(c)) for c in others], "w").unionByName(copies)
    if counted is not None:
        every = every.unionByName(counted)
    return every.groupBy(*[q(level_col(c)) for c in others]).agg(F.sum("w").cast("bigint").alias("n"))


def em_table(profiles: DataFrame, model: Model, *, unit: str = "byte") -> DataFrame:
    """``(pass, l0, l1, ..., n)``: the patterns of all passes; the column that a pass is blocked on counts as NULL."""
    parts = []
    for k, c in enumerate(model.columns):
        if len(model.columns) > 1:
            levels = [f"{NULL_LEVEL if o == c else q(level_col(o))} AS l{j}" for j, o in enumerate(model.columns)]
            parts.append(em_patterns(profiles, model, c, unit=unit).selectExpr(f"{k} AS pass", *levels, "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_em(
    patterns: DataFrame,
    comps: Sequence[Comparison],
    starts: dict[int, float],
    *,
    max_iter: int = EM_MAX_ITERATIONS,
    tol: float = EM_TOLERANCE,
) -> dict[int, tuple[list[list[float]], float, int, bool]]:
    """EM with u fixed over ``(pass, l0.., n)`` patterns, all passes at once.

    ``starts`` has the match rate that a pass begins with. Returns per pass m per column, the match
    rate, the iterations and whether it converged. An iteration is one aggregate over the table.
    """
    state = {k: ([list(c.m) for c in comps], lam, 0, False) for k, lam in starts.items()}

    def looked_up(j: int, values: dict[int, list[float]]) -> str:
        rows = ", ".join(f"{k}, {sql_array([1.0, *v], 'double')}" for k, v in values.items())
        return f"element_at(element_at(map({rows}), pass), l{j} + 2)"

    for it in range(1, max_iter + 1):
        live = {k: s for k, s in state.items() if not s[3]}
        if not live:
            break
        rate = "element_at(map(" + ", ".join(f"{k}, {sql_double(s[1])}" for k, s in live.items()) + "), pass)"
        pm = " * ".join([rate, *[looked_up(j, {k: s[0][j] for k, s in live.items()}) for j in range(len(comps))]])
        pu = " * ".join([f"(1D - {rate})", *[looked_up(j, dict.fromkeys(live, list(c.u))) for j, c in enumerate(comps)]])
        scored = patterns.where(f"pass IN ({', '.join(map(str, live))})").selectExpr("*", f"{pm} AS pm", f"{pu} AS pu")
        scored = scored.selectExpr("*", "CASE WHEN pm + pu > 0 THEN n * (pm / (pm + pu)) ELSE 0D END AS hit")
        sums = [f"sum(CASE WHEN l{j} = {lv} THEN hit ELSE 0D END) AS s{j}_{lv}" for j, c in enumerate(comps) for lv in range(c.n_levels)]
        aggs = [F.expr(x) for x in ["sum(n) AS n", "sum(hit) AS hit", *sums]]
        for r in scored.groupBy("pass").agg(*aggs).collect():  # one row per pass
            m, lam, _, _ = state[r["pass"]]
            new_lam = r["hit"] / r["n"] if r["n"] else lam
            new_m = []
            for j, c in enumerate(comps):
                total = sum(r[f"s{j}_{lv}"] for lv in range(c.n_levels))
                new_m.append([r[f"s{j}_{lv}"] / total if total > 0 else m[j][lv] for lv in range(c.n_levels)])
            change = max([abs(new_lam - lam), *[abs(a - b) for x, y in zip(new_m, m) for a, b in zip(x, y)]])
            state[r["pass"]] = (new_m, new_lam, it, change < tol)
    return state


def _median(xs: list[float]) -> float:
    s = sorted(xs)
    n = len(s)
    return s[n // 2] if n % 2 else (s[n // 2 - 1] + s[n // 2]) / 2


def estimate_m(slim: DataFrame, model: Model, *, iterations: int = EM_MAX_ITERATIONS, unit: str = "byte") -> tuple[dict[str, list[float]], list[str]]:
    """m per column from EM passes blocked on each column in turn (median over passes), and what each pass did."""
    if len(model.columns) < 2:
        return {}, []
    comps = model.comparisons
    with traced("train-em"):
        patterns, folder = write_table(em_table(profiles_of(slim, model.columns), model, unit=unit), "em-patterns")
        present = {r["pass"] for r in patterns.select("pass").distinct().collect()}  # one row per column at most
        odds = [model.prior_odds * c.factors[c.exact_level] for c in comps]
        done = run_em(patterns, comps, {k: odds[k] / (1.0 + odds[k]) for k in sorted(present)}, max_iter=iterations)
        release(slim.sparkSession, [folder])
    out = {}
    for j, c in enumerate(comps):
        found = [m[j] for k, (m, _, _, _) in done.items() if k != j]
        if found:
            out[c.column] = [_median([m[lv] for m in found]) for lv in range(c.n_levels)]
    return out, [f"{comps[k].column}:{it} iterations{'' if ok else ', not converged'}" for k, (_, _, it, ok) in sorted(done.items())]


# --- whole training -----------------------------------------------------------------


def _floor(x: float) -> float:
    return min(max(float(x), PROBABILITY_FLOOR), 1.0)


def train_model(rows: DataFrame, model: Model, *, id_col: str, unit: str = "byte", max_pairs: int = TRAIN_U_MAX_PAIRS,
                seed: int = TRAIN_U_SEED, iterations: int = EM_MAX_ITERATIONS, prior_rules: Rules = (), exact: bool = False) -> Model:
    """Train prior, u and m of ``model`` on ``rows``; untrained parts keep their values.

    ``max_pairs`` and ``seed`` set the random pairs that u is counted on, ``iterations`` bounds
    the EM. With ``prior_rules`` the prior comes from the union of these rules (of columns of ``rows``), not from the
    first column that has a pair. With ``exact`` u of edit-distance columns is counted over all pairs
    (``operators/exact.py``), only names are sampled. The result's ``trained`` says what was learned, from how many pairs, and whether EM converged.
    """
    from pyspark import StorageLevel

    slim = _slim(rows, model.columns, id_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trained: list[str] = []
        if prior_rules:
            of_rules = estimate_prior_of_rules(rows.select(*[q(c) for c in rule_columns(prior_rules)]), prior_rules)
            prior = None if of_rules is None else (of_rules, "rules")
        else:
            prior = estimate_prior(slim, model.columns)
        n_rows = slim.count()
        if prior is not None:
            model = model.with_prior(prior[0])
            trained.append(f"prior:{prior[1]}")
        u, pairs = estimate_u(slim, model, n_rows=n_rows, max_pairs=max_pairs, seed=seed, unit=unit)
        if exact:
            from .exact import exact_u

            counted = exact_u(slim, model, unit=unit)
            u.update(counted)
            trained += [f"u-exact:{c}" for c in counted]
        comps = []
        for c in model.comparisons:
            cu = u.get(c.column)
            new_u = tuple(_floor(cu[lv]) if cu and lv in cu else c.u[lv] for lv in range(c.n_levels))
            if cu:
                trained.append(f"u:{c.column}")
            comps.append(replace(c, u=new_u))
        model = replace(model, comparisons=tuple(comps))
        trained.append(f"u-pairs:{pairs}")
        m, passes = estimate_m(slim, model, iterations=iterations, unit=unit)
        comps = []
        for c in model.comparisons:
            if c.column in m:
                comps.append(replace(c, m=tuple(_floor(x) for x in m[c.column])))
                trained.append(f"m:{c.column}")
            else:
                comps.append(c)
        trained += [f"em-pass:{p}" for p in passes]
        return replace(model, comparisons=tuple(comps), trained=tuple(trained))
    finally:
        slim.unpersist()


def trained_model(df: DataFrame, columns: Sequence[str], *, id_col: str, prior: float = DEFAULT_PRIOR, unit: str = "byte", **options) -> Model:
    """A model for ``columns`` trained on ``df``, to be saved and used by ``resolve`` and ``score_records``."""
    return train_model(df, Model.default(list(columns), prior), id_col=id_col, unit=unit, **options)
