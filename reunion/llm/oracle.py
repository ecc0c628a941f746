"""DuckDB twins of the operators that SQL can express on whole tables.

The other queries are held against brute-force versions in ``tests/llm``.
"""

from .secrets import BASE_RULES, MORE_RULES, Rule

# Every query vector against every other, in double precision.
NEAREST = """
WITH e AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(k: int, r: Rule) -> str:
    """The texts cut at the rule's matches: every second piece is one."""
    marked = f"regexp_replace(t, {_quoted(r.pattern)}, chr(1) || '\\0' || chr(1), 'g')"
    return f"SELECT doc_id, {k} AS k, '{r.kind}' AS kind, string_split({marked}, chr(1)) AS a FROM d"


def secrets_sql(base: tuple[Rule, ...] = BASE_RULES, more: tuple[Rule, ...] = MORE_RULES) -> str:
    """All rules on every text, without an index."""
    rules = base + more
    size = " ".join(f"WHEN {k} THEN {f'length(regexp_extract(piece, {_quoted(r.pattern)}, {r.length_group}))' if r.length_group else 'length(piece)'} >= {r.min_chars}" for k, r in enumerate(rules))
    written = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k)"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in base)
    zero = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in base)
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
cut AS ({' UNION ALL '.join(_matches(k, r) for k, r in enumerate(rules))}),
pieces AS (SELECT doc_id, k, kind, unnest(a) AS piece, generate_subscripts(a, 1) AS i FROM cut WHERE len(a) > 1),
placed AS (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id, k ORDER BY i) AS BIGINT) AS e FROM pieces),
hits AS (SELECT doc_id, k, kind, e - length(piece) AS s, e FROM placed WHERE i % 2 = 0 AND CASE k {size} END),
found AS (
  SELECT doc_id, {counts}, {written} FILTER (k < {len(base)}) AS base, {written} AS spans FROM hits GROUP BY doc_id)
SELECT d.doc_id, {zero}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found ON d.doc_id = found.doc_id
"""


#: Every anchor against every row, without a tree.
NEGATIVES = """
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""


SQL: dict[str, str] = {"op1_secret_scan": secrets_sql(), "op2_nearest_neighbours": NEAREST, "op13_hard_negatives": NEGATIVES}
