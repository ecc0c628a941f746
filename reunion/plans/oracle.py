"""DuckDB SQL twins of the pipeline, for cross-checking Spark results.

The SQL is generated from the same :class:`Model` the Spark plan uses, so both engines see
the same double literals and the same multiplication order. It works row by row (no
profiles), with a recursive reachability CTE for the components: a plain, independent
formulation of the same semantics.
"""

from __future__ import annotations

from ..constants import JW_ROUND_DIGITS, PROB_COL, RESULT_ROUND_DIGITS
from ..model import Comparison, Model


def dbl(x: float) -> str:
    """A DOUBLE literal that parses to exactly ``x``."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def level_sql(comp: Comparison, left: str, right: str) -> str:
    head = f"CASE WHEN {left} IS NULL OR {right} IS NULL THEN -1 WHEN {left} = {right} THEN {comp.exact_level}"
    if comp.kind == "name":
        jw = f"round(jaro_winkler_similarity({left}, {right}), {JW_ROUND_DIGITS})"
        bands = " ".join(f"WHEN {jw} >= {dbl(t)} THEN {lvl}" for t, lvl in comp.band_levels())
    else:
        # strings whose lengths differ by more than the widest band can't reach it
        widest = int(max(comp.thresholds))
        dist = f"(CASE WHEN abs(strlen({left}) - strlen({right})) > {widest} THEN {widest + 1} ELSE levenshtein({left}, {right}) END)"
        bands = " ".join(f"WHEN {dist} <= {int(t)} THEN {len(comp.thresholds) - i}" for i, t in enumerate(comp.thresholds))
    return f"{head} {bands} ELSE 0 END"


def within_sql(left: str, right: str, edits: int) -> str:
    """Whether two values are at most ``edits`` apart; lengths decide first."""
    return f"(CASE WHEN abs(strlen({left}) - strlen({right})) > {edits} THEN false WHEN {left} = {right} THEN true ELSE levenshtein({left}, {right}) <= {edits} END)"


def factor_sql(comp: Comparison, level: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {dbl(f)}" for i, f in enumerate(comp.factors))
    return f"(CASE {level} WHEN -1 THEN {dbl(1.0)} {whens} END)"


def probability_sql(model: Model, levels: list[str], factors_from: str | None = None) -> str:
    """Pair probability; with ``factors_from`` the prior odds and factor lists come from that relation's columns."""
    odds = f"{factors_from}.prior_odds" if factors_from else dbl(model.prior_odds)
    for k, (comp, lvl) in enumerate(zip(model.comparisons, levels)):
        f = f"{factors_from}.f{k}[{lvl} + 2]" if factors_from else factor_sql(comp, lvl)
        odds = f"({odds} * {f})"
    return f"({odds} / ({dbl(1.0)} + {odds}))"


def rnd(expr: str) -> str:
    return f"round({expr}, {RESULT_ROUND_DIGITS})"


def pipeline_ctes(
    source_sql: str, id_col: str, model: Model, threshold: float, within: list[str] = (), trained_ctes: str = ""
) -> str:
    """CTE list (without WITH) defining src, slim, pairs, levels, scored, links, comp, best, labels, ids, resolved."""
    cols = model.columns
    within = list(within)
    slim_cols = ", ".join(f"CAST({qi(c)} AS VARCHAR) AS {qi(c)}" for c in model.all_columns)
    slim_within = "".join(f", {qi(w)}" for w in within if w not in model.all_columns)
    carry = ", ".join(f"l.{qi(c)} AS {qi(c + '_l')}, r.{qi(c)} AS {qi(c + '_r')}" for c in cols)
    rules = []
    for k, rule in enumerate(model.rules):
        conds = [f"l.{qi(c)} = r.{qi(c)}" for c in rule] + ["l.uid < r.uid"]
        conds += [f"l.{qi(w)} = r.{qi(w)}" for w in within]
        conds += [f"NOT coalesce({' AND '.join(f'l.{qi(e)} = r.{qi(e)}' for e in early)}, false)" for early in model.rules[:k]]
        rules.append(
            f"SELECT l.uid AS uid_l, r.uid AS uid_r, {k} AS rule, {carry} FROM slim l JOIN slim r ON {' AND '.join(conds)}"
        )
    for k, (column, edits) in enumerate(model.near):
        conds = ["l.uid < r.uid", within_sql(f"l.{qi(column)}", f"r.{qi(column)}", edits)]
        conds += [f"l.{qi(w)} = r.{qi(w)}" for w in within]
        conds += [f"NOT coalesce({' AND '.join(f'l.{qi(e)} = r.{qi(e)}' for e in [*early, *within])}, false)" for early in model.rules]
        conds += [f"NOT coalesce({within_sql(f'l.{qi(c)}', f'r.{qi(c)}', n)}, false)" for c, n in model.near[:k]]
        rules.append(f"SELECT l.uid AS uid_l, r.uid AS uid_r, {len(model.rules) + k} AS rule, {carry} FROM slim l JOIN slim r ON {' AND '.join(conds)}")
    level_cols = ", ".join(
        f"{level_sql(comp, qi(comp.column + '_l'), qi(comp.column + '_r'))} AS {qi(comp.column + '_level')}"
        for comp in model.comparisons
    )
    if trained_ctes:
        # model trained in SQL: prior odds and [1.0, m/u per level] lists from tprior/tmodel
        facs = ", ".join(
            f"(SELECT list_prepend(1.0, list_transform(range(len(m)), lambda i: m[i + 1] / u[i + 1])) FROM tmodel "
            f"WHERE col = '{c}') AS f{k}"
            for k, c in enumerate(cols)
        )
        fac_cte = f"{trained_ctes},\ntfac AS (SELECT (SELECT prior / (1.0 - prior) FROM tprior) AS prior_odds, {facs}),"
        prob = probability_sql(model, [qi(c + "_level") for c in cols], "tfac")
        scored = f"scored AS (SELECT levels.*, {prob} AS {PROB_COL} FROM levels, tfac),"
    else:
        fac_cte = ""
        prob = probability_sql(model, [qi(c + "_level") for c in cols])
        scored = f"scored AS (SELECT *, {prob} AS {PROB_COL} FROM levels),"
    return f"""
src AS ({source_sql}),
slim AS (SELECT {qi(id_col)} AS uid, {slim_cols}{slim_within} FROM src),
{fac_cte}
pairs AS ({' UNION ALL '.join(rules)}),
levels AS (SELECT uid_l, uid_r, rule, {level_cols} FROM pairs),
{scored}
links AS (SELECT uid_l, uid_r, {PROB_COL} FROM scored WHERE {PROB_COL} >= {dbl(threshold)}),
edges AS (SELECT uid_l AS a, uid_r AS b FROM links UNION ALL SELECT uid_r AS a, uid_l AS b FROM links),
reach(node, root) AS (
  SELECT a, a FROM edges
  UNION
  SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
best AS (SELECT uid, max(p) AS best FROM (
  SELECT uid_l AS uid, {PROB_COL} AS p FROM links UNION ALL SELECT uid_r AS uid, {PROB_COL} AS p FROM links) GROUP BY uid),
labels AS (SELECT s.uid, coalesce(c.root, s.uid) AS root, coalesce(b.best, {dbl(1.0)}) AS best
           FROM slim s LEFT JOIN comp c ON c.node = s.uid LEFT JOIN best b ON b.uid = s.uid),
ids AS (SELECT root, CAST(dense_rank() OVER (ORDER BY root) - 1 AS VARCHAR) AS cluster_id
        FROM (SELECT DISTINCT root FROM labels)),
resolved AS (SELECT src.*, ids.cluster_id, labels.best AS {PROB_COL}
             FROM src JOIN labels ON src.{qi(id_col)} = labels.uid JOIN ids ON ids.root = labels.root)
"""


def with_pipeline(
    source_sql: str, id_col: str, model: Model, threshold: float, body: str, within=(), extra_ctes: str = "",
    trained_ctes: str = "",
) -> str:
    extra = f", {extra_ctes}" if extra_ctes else ""
    return f"WITH RECURSIVE {pipeline_ctes(source_sql, id_col, model, threshold, within, trained_ctes)}{extra} {body}"


def score_sql(new_sql: str, known_sql: str, new_id: str, known_id: str, model: Model, threshold: float, body: str) -> str:
    """CTEs newsrc, known, pairs, levels, scored, links, best, matched for scoring new against known records."""
    cols = model.columns

    def stack(src: str, idc: str) -> str:
        vals = ", ".join(f"CAST({qi(c)} AS VARCHAR) AS {qi(c)}" for c in cols)
        return " UNION ALL ".join(
            f"SELECT {qi(idc)} AS uid, {k} AS rule, CAST({qi(c)} AS VARCHAR) AS key, {vals} FROM {src} WHERE {qi(c)} IS NOT NULL"
            for k, c in enumerate(cols)
        )

    carry = ", ".join(f"l.{qi(c)} AS {qi(c + '_l')}, r.{qi(c)} AS {qi(c + '_r')}" for c in cols)
    excl = "".join(f" AND NOT (l.rule > {j} AND coalesce(l.{qi(c)} = r.{qi(c)}, false))" for j, c in enumerate(cols[:-1]))
    level_cols = ", ".join(
        f"{level_sql(comp, qi(comp.column + '_l'), qi(comp.column + '_r'))} AS {qi(comp.column + '_level')}"
        for comp in model.comparisons
    )
    prob = probability_sql(model, [qi(c + "_level") for c in cols])
    return f"""WITH newsrc AS ({new_sql}),
known AS ({known_sql}),
ns AS ({stack('newsrc', new_id)}),
ks AS ({stack('known', known_id)}),
pairs AS (SELECT l.uid AS uid_l, r.uid AS uid_r, l.rule, {carry} FROM ns l JOIN ks r ON l.rule = r.rule AND l.key = r.key{excl}),
levels AS (SELECT uid_l, uid_r, {level_cols} FROM pairs),
scored AS (SELECT *, {prob} AS {PROB_COL} FROM levels),
links AS (SELECT uid_l, uid_r, {PROB_COL} FROM scored WHERE {PROB_COL} >= {dbl(threshold)}),
best AS (SELECT uid_l, uid_r AS match_id, {PROB_COL} FROM (
  SELECT *, row_number() OVER (PARTITION BY uid_l ORDER BY {PROB_COL} DESC, uid_r) AS rn FROM links) WHERE rn = 1),
matched AS (SELECT newsrc.*, best.match_id, best.{PROB_COL} FROM newsrc LEFT JOIN best ON newsrc.{qi(new_id)} = best.uid_l)
{body}"""
