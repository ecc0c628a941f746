"""Queries over kept and matched links: entities by batches, at several thresholds, one to one, the prior of rules and u over all pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import CLUSTER_COL, PROB_COL, TRAIN_PRIOR_RECALL
from ..operators import training as T
from ..operators.exact import exact_level_counts
from ..operators.spanning import entity_counts, maximum_spanning_forest
from ..sources.fixtures import NEW_CUSTOMERS_SQL, new_customers
from .incremental import ENTITY, KeptEntities
from .oracle import dbl, qi, rnd, score_sql, within_sql
from .queries import COMPOSITE, EDITED, PLANTED, PLANTED_SOURCE_SQL, REGION_SQL, Query, _member_links, _region, _round_p
from .score import match_records

# --- records that arrive in batches ------------------------------------------------


def q_resolve_incremental(spark, sf_dir):
    """Planted customers in two batches (even and odd records), the second added to the kept entities of the first."""
    w = PLANTED
    rows = w.rows(spark, sf_dir)
    kept = KeptEntities(w.model, id_col=w.id_col, threshold=w.threshold)
    for half in (0, 1):
        kept.add(rows.where(F.col(w.id_col) % 2 == half))
    return _round_p(kept.entities())


SQL_INCREMENTAL = PLANTED.sql(
    f"SELECT {PLANTED.id_col}, min({PLANTED.id_col}) OVER (PARTITION BY {CLUSTER_COL}) AS {ENTITY}, {rnd(PROB_COL)} AS {PROB_COL} FROM resolved"
)

# --- all thresholds from one linkage -------------------------------------------------

THRESHOLDS = (0.5, 0.8, 0.9, 0.99, 0.999)


def q_entities_by_threshold(spark, sf_dir):
    """Entities at five thresholds from the maximum spanning forest of the links at the lowest (in partitions of 2,000 edges)."""
    w = PLANTED
    forest = maximum_spanning_forest(_member_links(w, spark, sf_dir), partition_edges=2000)
    return entity_counts(forest, w.rows(spark, sf_dir), THRESHOLDS)


SQL_BY_THRESHOLD = "\nUNION ALL\n".join(
    f"SELECT {dbl(t)} AS threshold, entities FROM ({PLANTED.sql('SELECT count(DISTINCT cluster_id) AS entities FROM resolved', t)})" for t in THRESHOLDS
)

# --- one to one ----------------------------------------------------------------------


def q_match_one_to_one(spark, sf_dir):
    """New customer records and planted customers, each at most once (rounds down to 200 links, the rest in one task)."""
    w = PLANTED
    out = match_records(new_customers(spark, sf_dir), w.rows(spark, sf_dir), w.model, new_id="new_id", known_id=w.id_col, threshold=w.threshold, task_links=200)
    return _round_p(out)


SQL_ONE_TO_ONE = score_sql(
    NEW_CUSTOMERS_SQL, PLANTED_SOURCE_SQL, "new_id", PLANTED.id_col, PLANTED.model, PLANTED.threshold,
    f""", rounds(k, uid_l, uid_r, p, taken, gone) AS (
  SELECT 0, uid_l, uid_r, {PROB_COL}, false, false FROM links
  UNION ALL
  SELECT k + 1, uid_l, uid_r, p, taken, bool_or(taken) OVER (PARTITION BY uid_l) OR bool_or(taken) OVER (PARTITION BY uid_r)
  FROM (SELECT k, uid_l, uid_r, p,
               row_number() OVER (PARTITION BY uid_l ORDER BY p DESC, uid_r) = 1 AND row_number() OVER (PARTITION BY uid_r ORDER BY p DESC, uid_l) = 1 AS taken
        FROM rounds WHERE NOT gone))
SELECT newsrc.*, m.uid_r AS match_id, {rnd('m.p')} AS {PROB_COL}
FROM newsrc LEFT JOIN (SELECT * FROM rounds WHERE taken) m ON newsrc.new_id = m.uid_l""",
).replace("WITH newsrc", "WITH RECURSIVE newsrc", 1)

# --- prior of rules of several columns ----------------------------------------------


def q_train_prior_rules(spark, sf_dir):
    """Pairs of the union of composite rules by inclusion and exclusion, and the prior they give."""
    found = T.union_pair_counts(_region(spark, sf_dir), COMPOSITE.rules)
    share = f"CAST(pairs AS DOUBLE) / CAST('{TRAIN_PRIOR_RECALL!r}' AS DOUBLE) / CAST(records * (records - 1) / 2 AS DOUBLE)"
    return found.selectExpr("CAST(records AS BIGINT) AS records", "CAST(pairs AS BIGINT) AS pairs", f"round({share}, 15) AS prior")


def _agree(rule: tuple[str, ...]) -> str:
    return " AND ".join(f"l.{qi(c)} = r.{qi(c)}" for c in rule)


SQL_PRIOR_RULES = f"""
WITH s AS ({REGION_SQL}), u AS ({' UNION '.join(f'SELECT l.record_id AS a, r.record_id AS b FROM s l JOIN s r ON l.record_id < r.record_id AND {_agree(rule)}' for rule in COMPOSITE.rules)}),
c AS (SELECT (SELECT count(*) FROM s) AS records, (SELECT count(*) FROM u) AS pairs)
SELECT records, pairs, round(CAST(pairs AS DOUBLE) / {dbl(TRAIN_PRIOR_RECALL)} / (records * (records - 1) / 2.0), 15) AS prior FROM c
"""

# --- u over all pairs ------------------------------------------------------------------

U_COLUMNS = [(PLANTED, "email"), *[(EDITED, c) for c in EDITED.columns]]


def _comparison(w, column):
    return next(c for c in w.model.comparisons if c.column == column)


def q_train_u_exact(spark, sf_dir):
    """u of the planted e-mails and of all columns of the edited documents, counted over all pairs of records."""
    out = None
    for w, column in U_COLUMNS:
        counts = exact_level_counts(w.rows(spark, sf_dir), _comparison(w, column), id_col=w.id_col)
        out = counts if out is None else out.unionByName(counts)
    share = "CAST(pairs AS DOUBLE) / CAST(sum(pairs) OVER (PARTITION BY column) AS DOUBLE)"
    return out.selectExpr("column", "level", "CAST(pairs AS BIGINT) AS pairs", f"round({share}, 12) AS u")


def _u_exact_sql(w, column) -> str:
    comp = _comparison(w, column)
    bands = " ".join(f"WHEN d <= {int(t)} THEN {len(comp.thresholds) - i}" for i, t in enumerate(comp.thresholds))
    return f"""SELECT '{column}' AS "column", level, pairs, round(CAST(pairs AS DOUBLE) / sum(pairs) OVER (), 12) AS u FROM (
  WITH v AS (SELECT CAST({qi(column)} AS VARCHAR) AS t, count(*) AS n FROM ({w.source_sql}) WHERE {qi(column)} IS NOT NULL GROUP BY 1),
  near AS (SELECT CASE {bands} END AS level, CAST(sum(w) AS BIGINT) AS n FROM (
    SELECT levenshtein(l.t, r.t) AS d, l.n * r.n AS w FROM v l JOIN v r ON l.t < r.t AND {within_sql('l.t', 'r.t', int(max(comp.thresholds)))}) GROUP BY 1),
  known AS (SELECT level, n FROM near UNION ALL SELECT {comp.exact_level}, CAST(sum(n * (n - 1)) // 2 AS BIGINT) FROM v),
  whole AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM v)
  SELECT CAST(k AS INTEGER) AS level, CAST(CASE WHEN k = 0 THEN n * (n - 1) // 2 - (SELECT sum(n) FROM known) ELSE coalesce((SELECT sum(n) FROM known WHERE level = k), 0) END AS BIGINT) AS pairs
  FROM whole, range(0, {comp.n_levels}) AS g(k))"""


SQL_U_EXACT = "\nUNION ALL\n".join(_u_exact_sql(w, column) for w, column in U_COLUMNS)

LINK_QUERIES = {
    "resolve_incremental": Query(q_resolve_incremental, SQL_INCREMENTAL),
    "entities_by_threshold": Query(q_entities_by_threshold, SQL_BY_THRESHOLD),
    "match_one_to_one": Query(q_match_one_to_one, SQL_ONE_TO_ONE),
    "train_u_exact": Query(q_train_u_exact, SQL_U_EXACT),
    "train_prior_rules": Query(q_train_prior_rules, SQL_PRIOR_RULES),
}
