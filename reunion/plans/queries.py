"""The published query shapes, each as a Spark builder ``(spark, sf_dir) -> DataFrame`` and a DuckDB twin.

All builders read the given tables (through the workloads of ``reunion.sources``) in
full. Probabilities are rounded to 9 digits in both engines before comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import CLUSTER_COL, NULL_LEVEL, PROB_COL, RESULT_ROUND_DIGITS
from ..functions.levels import q
from ..model import Model
from ..operators.blocking import block_maxima, block_stats, candidate_pairs, stack_rules
from ..operators.clusters import best_match_probability, copy_profiles, member_links, member_pairs
from ..operators.components import connected_components
from ..operators.dense import pair_levels, reachable_pairs
from ..operators.near import near_pairs, near_value_pairs
from ..operators.scoring import compare_pairs, level_col, link_pairs, score_pairs
from ..session import materialize
from ..sources.fixtures import PLANTED_CUSTOMERS_SQL as PLANTED_SOURCE_SQL
from ..sources.fixtures import WORKLOADS
from .oracle import qi, rnd, with_pipeline, within_sql
from .resolve import copies_probability, resolve


@dataclass(frozen=True)
class Workload:
    name: str
    threshold: float

    @property
    def builder(self):
        return WORKLOADS[self.name][0]

    @property
    def source_sql(self) -> str:
        return WORKLOADS[self.name][1]

    @property
    def id_col(self) -> str:
        return WORKLOADS[self.name][2]

    @property
    def model(self) -> Model:
        return WORKLOADS[self.name][3]

    @property
    def columns(self) -> list[str]:
        return self.model.columns

    def rows(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.builder(spark, sf_dir)

    def slim(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.rows(spark, sf_dir).select(
            F.col(self.id_col).alias("uid"), *[F.col(c).cast("string").alias(c) for c in self.columns]
        )

    def resolved(self, spark: SparkSession, sf_dir: str, threshold: float | None = None) -> DataFrame:
        t = self.threshold if threshold is None else threshold
        return resolve(self.rows(spark, sf_dir), model=self.model, threshold=t, id_col=self.id_col)

    def pairs(self, slim: DataFrame, threshold: float | None = None) -> DataFrame:
        """All candidate pairs, or those of large blocks only that may reach a threshold."""
        if threshold is not None and not self.model.near:
            maxima = block_maxima(stack_rules(slim, self.model.rules, id_col="uid"), len(self.model.rules))
            return reachable_pairs(slim, self.model.rules, self.model, threshold, carry=self.columns, maxima=maxima)
        pairs = candidate_pairs(slim, self.model.rules, carry=self.columns)
        for more in near_pairs(slim, self.model.near, self.model.rules, carry=self.columns):
            pairs = pairs.unionByName(more)
        return pairs

    def sql(self, body: str, threshold: float | None = None, extra_ctes: str = "") -> str:
        t = self.threshold if threshold is None else threshold
        return with_pipeline(self.source_sql, self.id_col, self.model, t, body, extra_ctes=extra_ctes)


PLANTED = Workload("planted", 0.5)
DOCUMENTS = Workload("documents", 0.5)
EDITED = Workload("edited", 0.5)
PARTS = Workload("parts", 0.99)


def _round_p(df: DataFrame, col: str = PROB_COL) -> DataFrame:
    return df.withColumn(col, F.round(col, RESULT_ROUND_DIGITS))


def _resolved_out(w: Workload, threshold: float | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _round_p(w.resolved(spark, sf_dir, threshold))

    return run


def _resolved_sql(w: Workload, threshold: float | None = None) -> str:
    return w.sql(f"SELECT * REPLACE ({rnd(PROB_COL)} AS {PROB_COL}) FROM resolved", threshold)


# --- pair stages ----------------------------------------------------------------


def q_candidate_pairs(spark, sf_dir):
    w = PLANTED
    return candidate_pairs(w.slim(spark, sf_dir), w.columns, carry=[]).select("uid_l", "uid_r", "rule")


def q_block_stats(spark, sf_dir):
    w = PLANTED
    return block_stats(w.slim(spark, sf_dir), w.columns)


SQL_BLOCK_STATS = "\n UNION ALL ".join(
    f"""SELECT {i} AS rule, '{c}' AS "column", CAST(coalesce(sum(n), 0) AS BIGINT) AS records,
       CAST(count(*) AS BIGINT) AS blocks, CAST(coalesce(max(n), 0) AS BIGINT) AS largest_block,
       CAST(coalesce(sum(n * (n - 1)) // 2, 0) AS BIGINT) AS pairs
FROM (SELECT {qi(c)}, count(*) AS n FROM slim WHERE {qi(c)} IS NOT NULL GROUP BY {qi(c)})"""
    for i, c in enumerate(PLANTED.columns)
)


def _every_level(w: Workload, slim: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All pairs of the blocks with their levels, those of large blocks from matrices."""
    maxima = block_maxima(stack_rules(slim, w.model.rules, id_col="uid"), len(w.model.rules))
    return pair_levels(slim, w.model.rules, w.model, columns=columns, maxima=maxima)


def _levels(w: Workload, slim: DataFrame, threshold: float | None = None) -> DataFrame:
    return compare_pairs(w.pairs(slim, threshold), w.model)


def q_name_levels(spark, sf_dir):
    levels = _every_level(PLANTED, PLANTED.slim(spark, sf_dir), ["first_name", "last_name"])
    return levels.select("uid_l", "uid_r", "first_name_level", "last_name_level")


def _copy_levels(w: Workload, profiles: DataFrame) -> DataFrame:
    """The levels of copies ``(uid_l = uid_r = pid, rule, <levels...>)`` for profiles that hold several records which meet by a rule."""
    rules = [*w.model.rules, *[(c,) for c, _ in w.model.near]]
    first = " ".join(f"WHEN {' AND '.join(f'{q(c)} IS NOT NULL' for c in r)} THEN {k}" for k, r in enumerate(rules))
    levels = [f"IF({q(c.column)} IS NULL, {NULL_LEVEL}, {c.exact_level}) AS {q(level_col(c.column))}" for c in w.model.comparisons]
    return profiles.where("lo < hi").selectExpr("pid AS uid_l", "pid AS uid_r", f"CASE {first} END AS rule", *levels).where("rule IS NOT NULL")


def _record_pairs(w: Workload, slim: DataFrame, of_levels: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``of_levels`` of the pairs of profiles (with their levels), for all pairs of records: values are compared once for all copies."""
    profiles, members = copy_profiles(slim, w.model.all_columns)
    levels = _levels(w, profiles.drop("lo", "hi").withColumnRenamed("pid", "uid")).unionByName(_copy_levels(w, profiles))
    pairs = materialize(of_levels(levels), "profile-pairs")
    # a record that comes c times is met c times by equal values; near pairs are joined with their records twice
    return member_pairs(pairs, members, often=f"IF(rule < {len(w.model.rules)}, c, c * c)").drop("rule")


def q_edit_levels(spark, sf_dir):
    pairs = _record_pairs(EDITED, EDITED.slim(spark, sf_dir), lambda levels: levels)
    return pairs.select("uid_l", "uid_r", *[f"{c}_level" for c in EDITED.columns])


def q_near_texts(spark, sf_dir):
    """All pairs of different texts (``documents`` and edited copies) at most two edits of bytes apart, each text named by its smallest id."""
    return near_value_pairs(EDITED.rows(spark, sf_dir), "text", 2, id_col=EDITED.id_col)


SQL_NEAR_TEXTS = f"""
WITH src AS ({EDITED.source_sql}), t AS (SELECT min(doc_id) AS id, text FROM src GROUP BY text)
SELECT least(l.id, r.id) AS a, greatest(l.id, r.id) AS b, CAST(levenshtein(l.text, r.text) AS INTEGER) AS distance
FROM t l JOIN t r ON l.id < r.id AND {within_sql('l.text', 'r.text', 2)}
"""


def q_scored_pairs(spark, sf_dir):
    w = PLANTED
    scored = score_pairs(_every_level(w, w.slim(spark, sf_dir)), w.model, digits=RESULT_ROUND_DIGITS)
    return scored.select("uid_l", "uid_r", PROB_COL)


def _links(w: Workload, slim: DataFrame) -> DataFrame:
    return link_pairs(score_pairs(_levels(w, slim, w.threshold), w.model), w.threshold).select("uid_l", "uid_r", PROB_COL)


def _member_links(w: Workload, spark, sf_dir) -> DataFrame:
    """Links enough for components and best probabilities: pairs are those of profiles, copies are not made into pairs."""
    profiles, members = copy_profiles(w.slim(spark, sf_dir), w.model.all_columns)
    links = materialize(_links(w, profiles.drop("lo", "hi").withColumnRenamed("pid", "uid")), "links")
    return member_links(links, profiles, members, copies_probability(w.model), w.threshold)


def q_linked_pairs(spark, sf_dir):
    def links(levels: DataFrame) -> DataFrame:
        return link_pairs(score_pairs(levels, EDITED.model), EDITED.threshold).select("uid_l", "uid_r", "rule", PROB_COL)

    return _round_p(_record_pairs(EDITED, EDITED.slim(spark, sf_dir), links))


def q_connected_components(spark, sf_dir):
    return connected_components(_member_links(EDITED, spark, sf_dir))


def q_best_match_probability(spark, sf_dir):
    return _round_p(best_match_probability(_member_links(EDITED, spark, sf_dir)), "best")


# --- resolved relation and the query shapes over it -------------------------------


def q_entity_count(spark, sf_dir):
    return PLANTED.resolved(spark, sf_dir).agg(F.countDistinct(CLUSTER_COL).alias("entities"))


def q_duplicate_groups(spark, sf_dir):
    r = PLANTED.resolved(spark, sf_dir)
    return (
        r.groupBy(CLUSTER_COL)
        .agg(F.count(F.lit(1)).alias("rows_in_entity"))
        .where(F.col("rows_in_entity") > 1)
        .orderBy(F.desc("rows_in_entity"), CLUSTER_COL)
    )


def q_largest_group(spark, sf_dir):
    r = PLANTED.resolved(spark, sf_dir)
    return r.groupBy(CLUSTER_COL).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("largest_group"))


def q_duplicate_group_count(spark, sf_dir):
    r = PLANTED.resolved(spark, sf_dir)
    groups = r.groupBy(CLUSTER_COL).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return groups.agg(F.count(F.lit(1)).alias("duplicate_groups"))


def q_group_sizes(spark, sf_dir):
    r = DOCUMENTS.resolved(spark, sf_dir)
    return r.groupBy(CLUSTER_COL).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), CLUSTER_COL)


def q_ordered_rows(spark, sf_dir):
    r = PLANTED.resolved(spark, sf_dir)
    return r.select("first_name", "last_name", "email", CLUSTER_COL).orderBy(CLUSTER_COL, "first_name")


def q_clusters_differ(spark, sf_dir):
    """Whether the first record and the first one of another true entity than the least are in different clusters."""
    least = PLANTED.rows(spark, sf_dir).agg(F.min("expected_entity")).collect()[0][0]
    other = F.col("expected_entity") != F.lit(least)
    ends = PLANTED.resolved(spark, sf_dir).agg(
        F.min_by(CLUSTER_COL, "record_id").alias("a"),
        F.min_by(F.when(other, F.col(CLUSTER_COL)), F.when(other, F.col("record_id"))).alias("b"),
    )
    return ends.select((F.col("a") != F.col("b")).alias("clusters_differ"))


SQL_CLUSTERS_DIFFER = """
SELECT (SELECT cluster_id FROM resolved WHERE record_id = (SELECT min(record_id) FROM resolved))
    <> (SELECT cluster_id FROM resolved
        WHERE record_id = (SELECT min(record_id) FROM resolved
                           WHERE expected_entity <> (SELECT min(expected_entity) FROM resolved)))
    AS clusters_differ
"""


def q_truth_counts(spark, sf_dir):
    return PLANTED.rows(spark, sf_dir).groupBy("expected_entity").agg(F.count(F.lit(1)).alias("records"))


def q_sample_browse(spark, sf_dir):
    rows = PLANTED.rows(spark, sf_dir)
    first_id = rows.agg(F.min("record_id").alias("record_id"))
    first = rows.join(first_id, "record_id").select("last_name")
    return rows.join(first, "last_name", "left_semi").agg(F.count(F.lit(1)).alias("n"))


SQL_SAMPLE_BROWSE = """
SELECT count(*) AS n FROM src
WHERE last_name = (SELECT last_name FROM src WHERE record_id = (SELECT min(record_id) FROM src))
"""


def q_pair_quality(spark, sf_dir):
    """Pairwise precision, recall and F1 of the clusters against the planted truth."""
    r = PLANTED.resolved(spark, sf_dir)
    pairs = F.expr("sum(n * (n - 1)) div 2")
    both = r.groupBy(CLUSTER_COL, "expected_entity").agg(F.count(F.lit(1)).alias("n")).agg(pairs.alias("tp"))
    pred = r.groupBy(CLUSTER_COL).agg(F.count(F.lit(1)).alias("n")).agg(pairs.alias("pred"))
    true = r.groupBy("expected_entity").agg(F.count(F.lit(1)).alias("n")).agg(pairs.alias("truth"))
    metrics = (
        both.select(F.lit("tp").alias("m"), F.col("tp").alias("v"))
        .unionByName(pred.select(F.lit("pred").alias("m"), F.col("pred").alias("v")))
        .unionByName(true.select(F.lit("truth").alias("m"), F.col("truth").alias("v")))
    )
    j = metrics.agg(*[F.max(F.when(F.col("m") == k, F.col("v"))).alias(k) for k in ("tp", "pred", "truth")])
    precision = F.col("tp") / F.col("pred")
    recall = F.col("tp") / F.col("truth")
    return j.select(
        F.col("tp").cast("bigint").alias("true_pairs_found"),
        F.col("pred").cast("bigint").alias("predicted_pairs"),
        F.col("truth").cast("bigint").alias("true_pairs"),
        F.round(precision, RESULT_ROUND_DIGITS).alias("precision"),
        F.round(recall, RESULT_ROUND_DIGITS).alias("recall"),
        F.round(2 * precision * recall / (precision + recall), RESULT_ROUND_DIGITS).alias("f1"),
    )


PAIR_QUALITY_CTE = """q AS (
  SELECT (SELECT sum(n * (n - 1)) // 2 FROM (SELECT count(*) AS n FROM resolved GROUP BY cluster_id, expected_entity)) AS tp,
         (SELECT sum(n * (n - 1)) // 2 FROM (SELECT count(*) AS n FROM resolved GROUP BY cluster_id)) AS pred,
         (SELECT sum(n * (n - 1)) // 2 FROM (SELECT count(*) AS n FROM resolved GROUP BY expected_entity)) AS truth)"""
SQL_PAIR_QUALITY = f"""
SELECT CAST(tp AS BIGINT) AS true_pairs_found, CAST(pred AS BIGINT) AS predicted_pairs, CAST(truth AS BIGINT) AS true_pairs,
       round(CAST(tp AS DOUBLE) / pred, {RESULT_ROUND_DIGITS}) AS precision,
       round(CAST(tp AS DOUBLE) / truth, {RESULT_ROUND_DIGITS}) AS recall,
       round(2 * (CAST(tp AS DOUBLE) / pred) * (CAST(tp AS DOUBLE) / truth)
             / ((CAST(tp AS DOUBLE) / pred) + (CAST(tp AS DOUBLE) / truth)), {RESULT_ROUND_DIGITS}) AS f1
FROM q
"""


def q_probability_out_of_range(spark, sf_dir):
    r = PLANTED.resolved(spark, sf_dir)
    return r.where((F.col(PROB_COL) < 0.0) | (F.col(PROB_COL) > 1.0)).agg(F.count(F.lit(1)).alias("n"))


def q_entities_within_rows(spark, sf_dir):
    """For every true entity with several records: how many clusters its records fall into."""
    r = PLANTED.resolved(spark, sf_dir)
    return (
        r.groupBy("expected_entity")
        .agg(F.count(F.lit(1)).alias("records"), F.countDistinct(CLUSTER_COL).alias("clusters"))
        .where(F.col("records") > 1)
    )


@dataclass(frozen=True)
class Query:
    spark: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def _planted_sql(body: str, threshold: float | None = None) -> str:
    return PLANTED.sql(body, threshold)


QUERIES: dict[str, Query] = {
    "candidate_pairs": Query(q_candidate_pairs, _planted_sql("SELECT uid_l, uid_r, rule FROM pairs")),
    "block_stats": Query(q_block_stats, _planted_sql(SQL_BLOCK_STATS)),
    "name_levels": Query(
        q_name_levels, _planted_sql("SELECT uid_l, uid_r, first_name_level, last_name_level FROM levels")
    ),
    "edit_levels": Query(
        q_edit_levels, EDITED.sql("SELECT uid_l, uid_r, text_level, lang_level, source_level, n_chars_level FROM levels")
    ),
    "near_texts": Query(q_near_texts, SQL_NEAR_TEXTS),
    "scored_pairs": Query(q_scored_pairs, _planted_sql(f"SELECT uid_l, uid_r, {rnd(PROB_COL)} AS {PROB_COL} FROM scored")),
    "linked_pairs": Query(q_linked_pairs, EDITED.sql(f"SELECT uid_l, uid_r, {rnd(PROB_COL)} AS {PROB_COL} FROM links")),
    "connected_components": Query(q_connected_components, EDITED.sql("SELECT node, root FROM comp")),
    "best_match_probability": Query(q_best_match_probability, EDITED.sql(f"SELECT uid, {rnd('best')} AS best FROM best")),
    "resolve_planted": Query(_resolved_out(PLANTED), _resolved_sql(PLANTED)),
    "resolve_documents": Query(_resolved_out(DOCUMENTS), _resolved_sql(DOCUMENTS)),
    "resolve_parts": Query(_resolved_out(PARTS), _resolved_sql(PARTS)),
    "resolve_strict": Query(
        lambda spark, sf_dir: _round_p(PLANTED.resolved(spark, sf_dir, 0.9).where(F.col(PROB_COL) >= 0.5)),
        _planted_sql(f"SELECT * REPLACE ({rnd(PROB_COL)} AS {PROB_COL}) FROM resolved WHERE {PROB_COL} >= 0.5", 0.9),
    ),
    "entity_count": Query(q_entity_count, _planted_sql("SELECT count(DISTINCT cluster_id) AS entities FROM resolved")),
    "duplicate_groups": Query(
        q_duplicate_groups,
        _planted_sql(
            "SELECT cluster_id, count(*) AS rows_in_entity FROM resolved GROUP BY cluster_id "
            "HAVING count(*) > 1 ORDER BY rows_in_entity DESC, cluster_id"
        ),
    ),
    "largest_group": Query(
        q_largest_group,
        _planted_sql("SELECT max(n) AS largest_group FROM (SELECT cluster_id, count(*) AS n FROM resolved GROUP BY cluster_id)"),
    ),
    "duplicate_group_count": Query(
        q_duplicate_group_count,
        _planted_sql(
            "SELECT count(*) AS duplicate_groups FROM (SELECT cluster_id FROM resolved GROUP BY cluster_id HAVING count(*) > 1)"
        ),
    ),
    "group_sizes": Query(
        q_group_sizes, DOCUMENTS.sql("SELECT cluster_id, count(*) AS n FROM resolved GROUP BY cluster_id ORDER BY n DESC, cluster_id")
    ),
    "ordered_rows": Query(
        q_ordered_rows,
        _planted_sql("SELECT first_name, last_name, email, cluster_id FROM resolved ORDER BY cluster_id, first_name"),
    ),
    "clusters_differ": Query(q_clusters_differ, _planted_sql(SQL_CLUSTERS_DIFFER)),
    "truth_counts": Query(
        q_truth_counts, _planted_sql("SELECT expected_entity, count(*) AS records FROM src GROUP BY expected_entity")
    ),
    "sample_browse": Query(q_sample_browse, _planted_sql(SQL_SAMPLE_BROWSE)),
    "pair_quality": Query(q_pair_quality, PLANTED.sql(SQL_PAIR_QUALITY, extra_ctes=PAIR_QUALITY_CTE)),
    "probability_out_of_range": Query(
        q_probability_out_of_range,
        _planted_sql("SELECT count(*) AS n FROM resolved WHERE match_probability < 0.0 OR match_probability > 1.0"),
    ),
    "entities_within_rows": Query(
        q_entities_within_rows,
        _planted_sql(
            "SELECT expected_entity, count(*) AS records, count(DISTINCT cluster_id) AS clusters "
            "FROM resolved GROUP BY expected_entity HAVING count(*) > 1"
        ),
    ),
}


# --- training ---------------------------------------------------------------------

from ..constants import TRAIN_PRIOR_RECALL, TRAIN_U_MAX_PAIRS, TRAIN_U_SEED  # noqa: E402
from ..operators import training as T  # noqa: E402


def q_train_prior(spark, sf_dir):
    w = PLANTED
    got = T.estimate_prior(T._slim(w.rows(spark, sf_dir), w.columns, w.id_col), w.columns)
    rows = [] if got is None else [(got[1], float(got[0]))]
    return spark.createDataFrame(rows, "column string, prior double").selectExpr(
        "column", f"round(prior, 15) AS prior"
    )


def _prior_sql(w: Workload) -> str:
    per_rule = "\n UNION ALL ".join(
        f"SELECT {k} AS rule, '{c}' AS col, (SELECT coalesce(sum(n * (n - 1)) // 2, 0) FROM "
        f"(SELECT count(*) AS n FROM slim WHERE {qi(c)} IS NOT NULL GROUP BY {qi(c)})) AS pairs"
        for k, c in enumerate(w.columns)
    )
    return w.sql(
        f"""SELECT col AS "column", round(CAST(pairs AS DOUBLE) / {TRAIN_PRIOR_RECALL} / (n * (n - 1) / 2.0), 15) AS prior
        FROM (SELECT *, (SELECT count(*) FROM slim) AS n FROM ({per_rule}))
        WHERE pairs > 0 ORDER BY rule LIMIT 1"""
    )


def q_train_u(spark, sf_dir):
    w = PLANTED
    slim = T._slim(w.rows(spark, sf_dir), w.columns, w.id_col)
    n = slim.count()
    pairs = T.u_sample_pairs(slim, T.u_buckets(n))
    freq = T.level_frequencies(compare_pairs(pairs, w.model), w.model)
    return freq.selectExpr(
        "column", "level", f"round(n / sum(n) OVER (PARTITION BY column), {RESULT_ROUND_DIGITS}) AS u"
    )


def _u_sql(w: Workload) -> str:
    n = "(SELECT count(*) FROM slim)"
    buckets = f"greatest(1, CAST(ceil({n} * ({n} - 1) / 2.0 / {TRAIN_U_MAX_PAIRS}) AS BIGINT))"
    bucket = f"('0x' || substr(md5(concat('{TRAIN_U_SEED}:', CAST(uid AS VARCHAR))), 1, 15))::BIGINT % {buckets}"
    carry = ", ".join(f"l.{qi(c)} AS {qi(c + '_l')}, r.{qi(c)} AS {qi(c + '_r')}" for c in w.columns)
    from .oracle import level_sql

    levels = "\n UNION ALL ".join(
        f"SELECT '{c.column}' AS col, {level_sql(c, qi(c.column + '_l'), qi(c.column + '_r'))} AS level FROM upairs"
        for c in w.model.comparisons
    )
    extra = f"""tagged AS (SELECT *, {bucket} AS bucket FROM slim),
upairs AS (SELECT {carry} FROM tagged l JOIN tagged r ON l.bucket = r.bucket AND l.uid < r.uid),
ulev AS ({levels}),
ucount AS (SELECT col, level, count(*) AS n FROM ulev WHERE level <> -1 GROUP BY col, level)"""
    return w.sql(
        f"""SELECT col AS "column", level, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY col), {RESULT_ROUND_DIGITS}) AS u
        FROM ucount""",
        extra_ctes=extra,
    )


def q_train_em_patterns(spark, sf_dir):
    w = PLANTED
    slim = T._slim(w.rows(spark, sf_dir), w.columns, w.id_col)
    parts = []
    for c in w.columns:
        pat = T.em_patterns(T.profiles_of(slim, w.columns), w.model, c)
        parts.append(
            pat.selectExpr(
                f"'{c}' AS blocked",
                *[("CAST(NULL AS INT)" if o == c else q_level(o)) + f" AS {q_level(o)}" for o in w.columns],
                "n",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_level(c: str) -> str:
    from ..functions.levels import q as quote

    return quote(c + "_level")


def _em_patterns_sql(w: Workload) -> str:
    from .oracle import level_sql

    parts = []
    for c in w.columns:
        others = [x for x in w.model.comparisons if x.column != c]
        carry = ", ".join(f"l.{qi(o.column)} AS {qi(o.column + '_l')}, r.{qi(o.column)} AS {qi(o.column + '_r')}" for o in others)
        lv = {o.column: level_sql(o, qi(o.column + "_l"), qi(o.column + "_r")) for o in others}
        cols = ", ".join(f"{lv[x] if x in lv else 'CAST(NULL AS INTEGER)'} AS {qi(x + '_level')}" for x in w.columns)
        parts.append(
            f"SELECT '{c}' AS blocked, {cols} FROM (SELECT {carry} FROM slim l JOIN slim r "
            f"ON l.{qi(c)} = r.{qi(c)} AND l.uid < r.uid)"
        )
    group = ", ".join(["blocked", *[qi(x + "_level") for x in w.columns]])
    return w.sql(f"SELECT {group}, count(*) AS n FROM ({' UNION ALL '.join(parts)}) GROUP BY {group}")


def q_train_m(spark, sf_dir):
    """m after EM (rounded); iterative, so no SQL twin."""
    w = PLANTED
    model = T.train_model(w.rows(spark, sf_dir), w.model, id_col=w.id_col)
    rows = [(c.column, lv, float(c.m[lv]), float(c.u[lv])) for c in model.comparisons for lv in range(c.n_levels)]
    return spark.createDataFrame(rows, "column string, level int, m double, u double").selectExpr(
        "column", "level", f"round(m, {RESULT_ROUND_DIGITS}) AS m", f"round(u, {RESULT_ROUND_DIGITS}) AS u"
    )


def q_resolve_trained(spark, sf_dir):
    w = PLANTED
    out = resolve(w.rows(spark, sf_dir), w.columns, id_col=w.id_col, threshold=w.threshold, train=True)
    return _round_p(out)


# A supplied model (M4): used as-is, no training. Fixed values of this example model.
SUPPLIED_MODEL_JSON = (
    '{"prior": 0.02, "comparisons": ['
    '{"column": "first_name", "kind": "name", "thresholds": [0.92, 0.88, 0.7], '
    '"m": [0.05, 0.05, 0.1, 0.2, 0.6], "u": [0.9, 0.05, 0.03, 0.015, 0.005]}, '
    '{"column": "last_name", "kind": "name", "thresholds": [0.92, 0.88, 0.7], '
    '"m": [0.05, 0.05, 0.05, 0.15, 0.7], "u": [0.95, 0.02, 0.015, 0.01, 0.005]}, '
    '{"column": "email", "kind": "edit", "thresholds": [1, 2], '
    '"m": [0.1, 0.05, 0.15, 0.7], "u": [0.98, 0.01, 0.009, 0.001]}]}'
)


def q_resolve_with_model(spark, sf_dir):
    w = PLANTED
    out = resolve(w.rows(spark, sf_dir), w.columns, id_col=w.id_col, threshold=w.threshold, model=SUPPLIED_MODEL_JSON)
    return _round_p(out)


def _with_model_sql(w: Workload) -> str:
    model = Model.from_json(SUPPLIED_MODEL_JSON)
    body = f"SELECT * REPLACE ({rnd(PROB_COL)} AS {PROB_COL}) FROM resolved"
    return with_pipeline(w.source_sql, w.id_col, model, w.threshold, body)


QUERIES.update(
    {
        "train_prior": Query(q_train_prior, _prior_sql(PLANTED)),
        "train_u": Query(q_train_u, _u_sql(PLANTED)),
        "train_em_patterns": Query(q_train_em_patterns, _em_patterns_sql(PLANTED)),
        "train_m": Query(q_train_m, None),
        "resolve_trained": Query(q_resolve_trained, None),
        "resolve_with_model": Query(q_resolve_with_model, _with_model_sql(PLANTED)),
    }
)


# --- scoring new records against known ones (X1) ----------------------------------

from ..sources.fixtures import NEW_CUSTOMERS_SQL, new_customers  # noqa: E402
from .oracle import score_sql  # noqa: E402
from .score import score_records  # noqa: E402


def q_score_new_records(spark, sf_dir):
    """Best planted customer for every new customer record (default model, threshold 0.5)."""
    w = PLANTED
    out = score_records(new_customers(spark, sf_dir), w.rows(spark, sf_dir), w.model, new_id="new_id", known_id=w.id_col)
    return _round_p(out)


QUERIES["score_new_records"] = Query(
    q_score_new_records,
    score_sql(
        NEW_CUSTOMERS_SQL, PLANTED_SOURCE_SQL, "new_id", PLANTED.id_col, PLANTED.model, PLANTED.threshold,
        f"SELECT * REPLACE ({rnd(PROB_COL)} AS {PROB_COL}) FROM matched",
    ),
)


def q_score_stream(spark, sf_dir):
    """The same scores from a stream over the customer files, written exactly once and read back."""
    from ..sources.fixtures import as_new_customers
    from ..sources.tables import stream_table
    from ..session import scratch_folder
    from ..streaming.score import score_stream_to

    w = PLANTED
    folder = scratch_folder(spark, "stream")
    query = score_stream_to(
        as_new_customers(stream_table(spark, sf_dir, "customer")), w.rows(spark, sf_dir), w.model, f"{folder}/out",
        new_id="new_id", known_id=w.id_col, checkpoint_location=f"{folder}/checkpoint", trigger={"availableNow": True},
    )
    query.awaitTermination()
    return _round_p(spark.read.parquet(f"{folder}/out").drop("batch"))


QUERIES["score_stream"] = Query(q_score_stream, QUERIES["score_new_records"].sql)


def q_components_rounds(spark, sf_dir):
    """Components of the linked texts in partitions of 50 edges, so that star rounds run."""
    return connected_components(_member_links(EDITED, spark, sf_dir), partition_edges=50)


QUERIES["components_rounds"] = Query(q_components_rounds, QUERIES["connected_components"].sql)


# --- SQL twins of trained results -------------------------------------------------

from .oracle_training import training_ctes  # noqa: E402


def _train_m_sql(w: Workload) -> str:
    body = f"""SELECT col AS "column", CAST(level AS INTEGER) AS level,
               round(m[level + 1], {RESULT_ROUND_DIGITS}) AS m, round(u[level + 1], {RESULT_ROUND_DIGITS}) AS u
        FROM tmodel, range(0, len(m)) AS t(level)"""
    return w.sql(body, extra_ctes=training_ctes(w.model))


QUERIES["train_m"] = Query(q_train_m, _train_m_sql(PLANTED))


def _resolve_trained_sql(w: Workload) -> str:
    body = f"SELECT * REPLACE ({rnd(PROB_COL)} AS {PROB_COL}) FROM resolved"
    return with_pipeline(w.source_sql, w.id_col, w.model, w.threshold, body, trained_ctes=training_ctes(w.model))


QUERIES["resolve_trained"] = Query(q_resolve_trained, _resolve_trained_sql(PLANTED))


# --- further paths of resolve, each over planted customers unless said otherwise ------


def _region(spark, sf_dir) -> DataFrame:
    return PLANTED.rows(spark, sf_dir).withColumn("region", F.col("expected_entity") % 3)


REGION_SQL = f"SELECT *, expected_entity % 3 AS region FROM ({PLANTED_SOURCE_SQL})"
RESOLVED_ROUNDED = f"SELECT * REPLACE ({rnd(PROB_COL)} AS {PROB_COL}) FROM resolved"


def q_resolve_within(spark, sf_dir):
    w = PLANTED
    return _round_p(resolve(_region(spark, sf_dir), w.columns, id_col=w.id_col, within=["region"]))


COMPOSITE = Model.default(["first_name", "last_name", "email"])
COMPOSITE = Model(COMPOSITE.prior, COMPOSITE.comparisons, blocking=(("last_name", "first_name"), ("email",), ("first_name", "region")))


def q_resolve_with_blocking(spark, sf_dir):
    """Composite blocking rules, one of them over a column that is not compared; the model given as a dict."""
    import json

    return _round_p(resolve(_region(spark, sf_dir), model=json.loads(COMPOSITE.to_json()), id_col=PLANTED.id_col))


# columns named like our own, and with a dot, beside a payload that has a reserved name in another case
ODD_NAMES = {"first_name": "key", "last_name": "rule", "email": "a.b"}


def q_resolve_odd_names(spark, sf_dir):
    rows = PLANTED.rows(spark, sf_dir).withColumnsRenamed(ODD_NAMES).withColumn("Cluster_ID", F.lit("old")).withColumn("uid", F.lit(1))
    kinds = Model.default(PLANTED.columns).renamed({**ODD_NAMES})
    out = _round_p(resolve(rows, model=Model(kinds.prior, kinds.comparisons), id_col=PLANTED.id_col))
    return out.withColumnRenamed("a.b", "a_b")


ODD_NAMES_SQL = PLANTED.sql(
    f"SELECT record_id, first_name AS key, last_name AS rule, email AS a_b, expected_entity, 1 AS uid, cluster_id, {rnd(PROB_COL)} AS {PROB_COL} FROM resolved"
)


def q_resolve_salted(spark, sf_dir):
    """Blocks of over 3 records are spread over several tasks; the result is the same."""
    w = PLANTED
    return _round_p(resolve(w.rows(spark, sf_dir), w.columns, id_col=w.id_col, block_split=3))


def q_resolve_char_unit(spark, sf_dir):
    """Distances count characters, not bytes (planted values are ASCII, so DuckDB's twin agrees)."""
    w = PLANTED
    return _round_p(resolve(w.rows(spark, sf_dir), w.columns, id_col=w.id_col, unit="char"))


def q_resolve_ordered(spark, sf_dir):
    w = PLANTED
    out = resolve(w.rows(spark, sf_dir), w.columns, id_col=w.id_col, ordered=True)
    return _round_p(out.withColumn("place", F.row_number().over(Window.partitionBy(CLUSTER_COL).orderBy(w.id_col))))


def q_resolve_generated_id(spark, sf_dir):
    """Without an id column: the partition into entities, each named by its smallest record."""
    w = PLANTED
    out = resolve(w.rows(spark, sf_dir), w.columns)
    least = out.groupBy(CLUSTER_COL).agg(F.min(w.id_col).alias("entity"))
    return _round_p(out.join(least, CLUSTER_COL).select(w.id_col, "entity", PROB_COL))


def q_resolved_view(spark, sf_dir):
    from .resolve import resolved_view

    w = PLANTED
    resolved_view(spark, "reunion_view", w.rows(spark, sf_dir), w.columns, id_col=w.id_col)
    try:
        return spark.sql("SELECT count(DISTINCT cluster_id) AS entities, count(*) AS records FROM reunion_view")
    finally:
        spark.catalog.dropTempView("reunion_view")


QUERIES.update(
    {
        "resolve_within": Query(q_resolve_within, with_pipeline(REGION_SQL, "record_id", PLANTED.model, 0.5, RESOLVED_ROUNDED, within=["region"])),
        "resolve_with_blocking": Query(q_resolve_with_blocking, with_pipeline(REGION_SQL, "record_id", COMPOSITE, 0.5, RESOLVED_ROUNDED)),
        "resolve_odd_names": Query(q_resolve_odd_names, ODD_NAMES_SQL),
        "resolve_salted": Query(q_resolve_salted, _planted_sql(RESOLVED_ROUNDED)),
        "resolve_char_unit": Query(q_resolve_char_unit, _planted_sql(RESOLVED_ROUNDED)),
        "resolve_ordered": Query(
            q_resolve_ordered,
            _planted_sql(f"SELECT * REPLACE ({rnd(PROB_COL)} AS {PROB_COL}), row_number() OVER (PARTITION BY cluster_id ORDER BY record_id) AS place FROM resolved"),
        ),
        "resolve_generated_id": Query(
            q_resolve_generated_id,
            _planted_sql(f"SELECT record_id, min(record_id) OVER (PARTITION BY cluster_id) AS entity, {rnd(PROB_COL)} AS {PROB_COL} FROM resolved"),
        ),
        "resolved_view": Query(q_resolved_view, _planted_sql("SELECT count(DISTINCT cluster_id) AS entities, count(*) AS records FROM resolved")),
    }
)

from .queries_links import LINK_QUERIES  # noqa: E402

QUERIES.update(LINK_QUERIES)
