"""DuckDB twin of training: prior (T1), u (T2) and EM for m (T3), as recursive SQL.

Produces CTEs ``tprior(prior)`` and ``tmodel(col, m, u)`` (lists, worst level first) for a
workload; the EM recursion carries the match rate and the m lists from one iteration to
the next and stops at the same tolerance and iteration cap as the Spark side.
"""

from __future__ import annotations

from ..constants import (
    EM_MAX_ITERATIONS,
    EM_TOLERANCE,
    PROBABILITY_FLOOR,
    TRAIN_PRIOR_RECALL,
    TRAIN_U_MAX_PAIRS,
    TRAIN_U_SEED,
)
from ..model import Model
from .oracle import dbl, level_sql, qi


def _list(values) -> str:
    return "[" + ", ".join(dbl(v) for v in values) + "]"


def _floor(expr: str) -> str:
    return f"greatest(least({expr}, {dbl(1.0)}), {dbl(PROBABILITY_FLOOR)})"


def training_ctes(model: Model) -> str:
    """CTEs over ``slim`` (uid + compared columns as text) ending in ``tprior`` and ``tmodel``."""
    cols = model.columns
    comps = {c.column: c for c in model.comparisons}
    parts: list[str] = []

    # T1: pairs inside blocks, first column that has any
    rules = " UNION ALL ".join(
        f"SELECT {k} AS rule, (SELECT coalesce(sum(n * (n - 1)) // 2, 0) FROM "
        f"(SELECT count(*) AS n FROM slim WHERE {qi(c)} IS NOT NULL GROUP BY {qi(c)})) AS pairs"
        for k, c in enumerate(cols)
    )
    parts.append(f"t1_rules AS ({rules})")
    parts.append(
        "t1 AS (SELECT "
        + _floor(
            f"least(CAST(pairs AS DOUBLE) / {TRAIN_PRIOR_RECALL} / (n * (n - 1) / 2.0), {dbl(1.0 - PROBABILITY_FLOOR)})"
        )
        + " AS prior FROM t1_rules, (SELECT count(*) AS n FROM slim) WHERE pairs > 0 ORDER BY rule LIMIT 1)"
    )
    parts.append(f"tprior AS (SELECT coalesce((SELECT prior FROM t1), {dbl(model.prior)}) AS prior)")

    # T2: u from seeded hash buckets
    n = "(SELECT count(*) FROM slim)"
    buckets = f"greatest(1, CAST(ceil({n} * ({n} - 1) / 2.0 / {TRAIN_U_MAX_PAIRS}) AS BIGINT))"
    bucket = f"('0x' || substr(md5(concat('{TRAIN_U_SEED}:', CAST(uid AS VARCHAR))), 1, 15))::BIGINT % {buckets}"
    carry = ", ".join(f"l.{qi(c)} AS {qi(c + '_l')}, r.{qi(c)} AS {qi(c + '_r')}" for c in cols)
    parts.append(f"t2_tagged AS (SELECT *, {bucket} AS bucket FROM slim)")
    parts.append(f"t2_pairs AS (SELECT {carry} FROM t2_tagged l JOIN t2_tagged r ON l.bucket = r.bucket AND l.uid < r.uid)")
    lev = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {level_sql(comps[c], qi(c + '_l'), qi(c + '_r'))} AS level FROM t2_pairs" for c in cols
    )
    parts.append(f"t2_levels AS ({lev})")
    parts.append(
        "t2_share AS (SELECT col, level, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY col) AS u "
        "FROM (SELECT col, level, count(*) AS n FROM t2_levels WHERE level <> -1 GROUP BY col, level))"
    )
    tu = " UNION ALL ".join(
        f"SELECT '{c}' AS col, ["
        + ", ".join(
            f"coalesce((SELECT {_floor('u')} FROM t2_share WHERE col = '{c}' AND level = {lv}), {dbl(comps[c].u[lv])})"
            for lv in range(comps[c].n_levels)
        )
        + "] AS u"
        for c in cols
    )
    parts.append(f"tu AS ({tu})")

    # T3: one EM recursion per blocked column
    passes = []
    for c in cols:
        others = [o for o in cols if o != c]
        if not others:
            continue
        oc = ", ".join(f"l.{qi(o)} AS {qi(o + '_l')}, r.{qi(o)} AS {qi(o + '_r')}" for o in others)
        lv = ", ".join(f"{level_sql(comps[o], qi(o + '_l'), qi(o + '_r'))} AS l{j}" for j, o in enumerate(others))
        group = ", ".join(f"l{j}" for j in range(len(others)))
        parts.append(
            f"pat_{c} AS (SELECT {group}, count(*) AS n FROM (SELECT {lv} FROM (SELECT {oc} FROM slim l JOIN slim r "
            f"ON l.{qi(c)} = r.{qi(c)} AND l.uid < r.uid)) GROUP BY {group})"
        )
        ec = comps[c]
        lam0 = (
            f"(SELECT odds / (1.0 + odds) FROM (SELECT (prior / (1.0 - prior)) * ({dbl(ec.m[ec.exact_level])} / "
            f"(SELECT u[{ec.exact_level + 1}] FROM tu WHERE col = '{c}')) AS odds FROM tprior))"
        )
        init_m = ", ".join(f"{_list(comps[o].m)} AS m{j}" for j, o in enumerate(others))
        mcols = ", ".join(f"m{j}" for j in range(len(others)))
        ulists = ", ".join(f"(SELECT u FROM tu WHERE col = '{o}') AS u{j}" for j, o in enumerate(others))
        pm = "e.lam" + "".join(f" * (CASE WHEN p.l{j} = -1 THEN 1.0 ELSE e.m{j}[p.l{j} + 1] END)" for j in range(len(others)))
        pu = "(1.0 - e.lam)" + "".join(
            f" * (CASE WHEN p.l{j} = -1 THEN 1.0 ELSE uu.u{j}[p.l{j} + 1] END)" for j in range(len(others))
        )
        new_m = []
        for j, o in enumerate(others):
            den = f"sum(CASE WHEN l{j} <> -1 THEN n * post ELSE 0.0 END)"
            levels = ", ".join(
                f"CASE WHEN {den} > 0 THEN sum(CASE WHEN l{j} = {lvl} THEN n * post ELSE 0.0 END) / {den} ELSE m{j}[{lvl + 1}] END"
                for lvl in range(comps[o].n_levels)
            )
            new_m.append(f"[{levels}] AS nm{j}")
        change_terms = ["abs(nlam - lam)"] + [
            f"abs(nm{j}[{lvl + 1}] - m{j}[{lvl + 1}])" for j, o in enumerate(others) for lvl in range(comps[o].n_levels)
        ]
        lcols = ", ".join(f"l{j}" for j in range(len(others)))
        parts.append(
            f"""em_{c}(it, lam, {mcols}, done) AS (
  SELECT 0, {lam0}, {", ".join(f"{_list(comps[o].m)}" for o in others)}, false
  UNION ALL
  SELECT it + 1, nlam, {", ".join(f"nm{j}" for j in range(len(others)))}, greatest({", ".join(change_terms)}) < {EM_TOLERANCE}
  FROM (
    SELECT it, lam, {mcols}, sum(n * post) / sum(n) AS nlam, {", ".join(new_m)}
    FROM (
      SELECT it, lam, {mcols}, {lcols}, n, CASE WHEN pm + pu > 0 THEN pm / (pm + pu) ELSE 0.0 END AS post
      FROM (
        SELECT e.it, e.lam, {", ".join(f"e.m{j}" for j in range(len(others)))}, {", ".join(f"p.l{j}" for j in range(len(others)))},
               p.n, {pm} AS pm, {pu} AS pu
        FROM em_{c} e, pat_{c} p, (SELECT {ulists}) uu
        WHERE NOT e.done AND e.it < {EM_MAX_ITERATIONS}))
    GROUP BY it, lam, {mcols}))"""
        )
        passes.append((c, others))
    # final m per column: median over the passes that trained it
    rows = []
    for c, others in passes:
        for j, o in enumerate(others):
            rows.append(
                f"SELECT '{o}' AS col, m{j} AS m FROM (SELECT * FROM em_{c} ORDER BY it DESC LIMIT 1) "
                f"WHERE (SELECT count(*) FROM pat_{c}) > 0"
            )
    parts.append(f"em_all AS ({' UNION ALL '.join(rows) if rows else 'SELECT NULL AS col, NULL AS m WHERE false'})")
    tm = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {k} AS pos, coalesce((SELECT ["
        + ", ".join(f"{_floor(f'median(m[{lv + 1}])')}" for lv in range(comps[c].n_levels))
        + f"] FROM em_all WHERE col = '{c}' HAVING count(*) > 0), {_list(comps[c].m)}) AS m, "
        f"(SELECT u FROM tu WHERE col = '{c}') AS u"
        for k, c in enumerate(cols)
    )
    parts.append(f"tmodel AS ({tm})")
    return ",\n".join(parts)
