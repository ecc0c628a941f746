"""``resolve``: the whole linkage as one Spark plan (with a few checkpoints).

::

    rows     = df (+ uid)                          uid = id_col, or a generated id, checkpointed
    slim     = uid + comparison values as strings  payload columns stay out of every shuffle
    profiles = slim grouped by all values          exact copies collapse: (pid = min uid, n)
    pairs    = blocking self-joins of profiles     one equi-join per column, hot blocks salted
    links    = levels -> probability -> >= t       native expressions, JW as an Arrow UDF
    comps    = star rounds over profile links      checkpoint per round
    labels   = per record: root, best p            copies of one profile share its links
    ids      = dense rank of roots                 two-pass, no single-partition window
    out      = rows JOIN labels ON uid             the only shuffle of the payload
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import (
    CLUSTER_COL,
    CLUSTER_COMMENT,
    DEFAULT_PRIOR,
    DEFAULT_THRESHOLD,
    PROB_COL,
    PROB_COMMENT,
    RESERVED_COLUMNS,
)
from ..errors import MatchError
from ..functions.levels import match_probability_sql, q, unit_sql
from ..functions.similarity import check_unit
from ..model import Model
from ..operators.blocking import DEFAULT_BLOCK_SPLIT, as_rules, block_maxima, rule_columns, stack_rules
from ..operators.clusters import best_match_probability, dense_ids
from ..operators.components import connected_components
from ..operators.dense import reachable_pairs
from ..operators.near import near_pairs
from ..operators.scoring import compare_pairs, link_pairs, prune_unreachable, score_pairs
from ..session import ensure_checkpoint_dir, materialize, traced

UID = "__reunion_uid"
EMPTY = "resolve needs a non-empty input"


def parse_columns(spec: str | Sequence[str] | None) -> list[str]:
    """``'a, b,,c'`` -> ``['a', 'b', 'c']``; a list is trimmed the same way."""
    if spec is None:
        return []
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    cols = [str(c).strip() for c in items if str(c).strip()]
    dup = sorted({c for c in cols if cols.count(c) > 1})
    if dup:
        raise MatchError(f"comparison column(s) named more than once: {', '.join(dup)}")
    return cols


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Exact, case-sensitive presence test (Spark itself would resolve names case-insensitively)."""
    if not columns:
        raise MatchError("no comparison columns given: name the fields that tell records apart, as 'a,b' or a list")
    have = set(df.columns)
    missing = [c for c in columns if c not in have]
    if missing:
        raise MatchError(f"not found in the input: {', '.join(missing)} (it has {', '.join(df.columns)})")


def check_inputs(df: DataFrame, columns: Sequence[str], threshold: float, id_col: str | None = None,
                 check_ids: bool = True) -> None:
    """The checks in their fixed order: empty input, threshold, columns, then ids.

    With an id column the emptiness and the id checks share one aggregate job.
    """
    if df.isStreaming:
        raise MatchError("resolve needs a batch DataFrame; score a stream with reunion.streaming.score_stream")
    ids_ok = True
    if id_col is not None and check_ids and id_col in df.columns:
        per_id = df.groupBy(F.col(q(id_col)).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        stats = per_id.agg(
            F.count(F.lit(1)).alias("ids"),
            F.max(((F.col("n") > 1) | F.col("id").isNull()).cast("int")).alias("bad"),
        ).collect()[0]
        empty = stats["ids"] == 0
        ids_ok = not stats["bad"]
    else:
        empty = df.isEmpty()
    if empty:
        raise MatchError(EMPTY)
    t = float(threshold)
    if not 0.0 <= t <= 1.0:
        raise MatchError(f"threshold must be in [0, 1], got {threshold}")
    require_columns(df, columns)
    if id_col is not None and id_col not in df.columns:
        raise MatchError(f"id column not found in input relation: {id_col}")
    if not ids_ok:
        raise MatchError(f"id column {id_col} must be unique and not NULL")


def positional(df: DataFrame) -> DataFrame:
    """The columns renamed ``p0, p1, ...``, so that no name of the caller's meets one of ours."""
    return df.toDF(*[f"p{i}" for i in range(len(df.columns))])


def with_uid(df: DataFrame, id_col: str | None) -> DataFrame:
    """:func:`positional` columns plus ``uid``: unique, orderable, and fixed for the whole job.

    With ``id_col`` it is the caller's column (checked unique by :func:`check_inputs`). Without it a
    generated id follows input order; the rows are checkpointed (which holds for every column type) so
    that recomputation after a lost executor cannot renumber them.
    """
    if id_col is not None:
        if id_col not in df.columns:
            raise MatchError(f"id column not found in input relation: {id_col}")
        return positional(df).withColumn("uid", F.col(f"p{df.columns.index(id_col)}"))
    ensure_checkpoint_dir(df.sparkSession)
    return positional(df).withColumn("uid", F.monotonically_increasing_id()).checkpoint()


def self_pair_probability(model: Model) -> Column:
    """Probability of a pair of identical records: exact level where the value is set, NULL level elsewhere."""
    levels = [f"(CASE WHEN {q(c.column)} IS NULL THEN -1 ELSE {c.exact_level} END)" for c in model.comparisons]
    return F.expr(match_probability_sql(model, levels))


def _all_set(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]) if cols else F.lit(True)


def copies_probability(model: Model, within: Sequence[str] = ()) -> Column:
    """:func:`self_pair_probability` of copies that meet: some rule has all its values set; else NULL."""
    blocked = reduce(lambda a, b: a | b, [_all_set(r) for r in [*model.rules, *[(c,) for c, _ in model.near]]])
    return F.when(blocked & _all_set(within), self_pair_probability(model))


def profile_states(
    profiles: DataFrame, comps: DataFrame, best: DataFrame, model: Model, threshold: float, within: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """``(pid, keep..., shared, proot, pbest)`` of profiles ``(pid, n, values...)``: whether the copies of a profile are one entity,
    its component's root and its best probability (NULL without any link). ``comps`` is ``(node, root)``, ``best`` ``(uid, best)``."""
    p_self = self_pair_probability(model)
    self_linked = (F.col("n") >= 2) & F.coalesce(copies_probability(model, within) >= F.lit(threshold), F.lit(False))
    return (
        profiles.select("pid", *keep, self_linked.alias("self_linked"), p_self.alias("p_self"))
        .join(comps.withColumnRenamed("node", "pid"), "pid", "left")
        .join(best.withColumnRenamed("uid", "pid"), "pid", "left")
        .select(
            "pid",
            *keep,
            (F.col("root").isNotNull() | F.col("self_linked")).alias("shared"),
            F.coalesce(F.col("root"), F.col("pid")).alias("proot"),
            F.greatest(F.col("best"), F.when(F.col("self_linked"), F.col("p_self"))).alias("pbest"),
        )
    )


def resolve_labels(
    slim: DataFrame,
    model: Model,
    threshold: float,
    *,
    uid: str = "uid",
    within: Sequence[str] = (),
    unit: str = "byte",
    block_split: int | None = DEFAULT_BLOCK_SPLIT,
    extra_stats: DataFrame | None = None,
    on_stats=None,
    persisted: list | None = None,
) -> DataFrame:
    """``(uid, root, best)`` for every record of ``slim`` (uid + comparison/within columns).

    ``extra_stats`` rows ``(rule < -1, largest)`` ride along in the block-maxima job and are
    handed to ``on_stats`` (in descending rule order) before any further work.
    """
    cols = model.columns
    rules = model.rules
    keys = list(dict.fromkeys([*model.all_columns, *within]))
    t = float(threshold)

    profiles = (
        slim.groupBy(*keys)
        .agg(F.min(uid).alias("pid"), F.count(F.lit(1)).alias("n"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    if persisted is not None:
        persisted.append(profiles)
    stacked = stack_rules(profiles, rules, id_col="pid", within=within)
    copies = profiles.agg(F.lit(-1).alias("rule"), F.max("n").cast("bigint").alias("largest"))
    if extra_stats is not None:
        copies = copies.unionByName(extra_stats)
    found = block_maxima(stacked, len(rules), copies)
    maxima, largest_profile, stats = found[: len(rules)], found[len(rules)], found[len(rules) + 1 :]
    if on_stats is not None:
        on_stats(stats)
    pairs = reachable_pairs(
        profiles, rules, model, t, id_col="pid", within=within, carry=cols, unit=unit, block_split=block_split, maxima=maxima
    )
    for more in near_pairs(profiles, model.near, rules, id_col="pid", within=within, carry=cols, unit=unit, block_split=block_split):
        pairs = pairs.unionByName(more)
    pairs = prune_unreachable(pairs, model, t, unit=unit)
    scored = score_pairs(compare_pairs(pairs, model, unit=unit), model)
    seen = Observation()
    links = materialize(link_pairs(scored, t).select("uid_l", "uid_r", PROB_COL).observe(seen, F.count(F.lit(1)).alias("n")), "links")

    comps = connected_components(links, count=int(seen.get["n"]))
    prof = profile_states(profiles, comps, best_match_probability(links), model, t, within, keys)
    if largest_profile <= 1:
        # no exact copies: every profile is one record and pid is its uid
        return prof.select(
            F.col("pid").alias("uid"), F.col("proot").alias("root"), F.coalesce(F.col("pbest"), F.lit(1.0)).alias("best")
        )
    member = slim.alias("s").join(
        prof.alias("p"), reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys])
    )
    labels = member.select(
        F.col(f"s.{uid}").alias("uid"),
        F.when(F.col("p.shared"), F.col("p.proot")).otherwise(F.col(f"s.{uid}")).alias("root"),
        F.coalesce(F.col("p.pbest"), F.lit(1.0)).alias("best"),
    )
    return labels


def read_model(model: Model | str | dict | None, spark) -> Model | None:
    """A model from its JSON, a dict, or a path that Spark can read."""
    if isinstance(model, dict) or isinstance(model, str) and model.lstrip().startswith("{"):
        return Model.from_json(model)
    return Model.from_file(model, spark) if isinstance(model, str) else model


def internal_model(model: Model, within: Sequence[str]) -> tuple[Model, dict[str, str], list[str]]:
    """The model over names of our own, the map from the caller's names, and the ``within`` columns' names."""
    names = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*model.all_columns, *within]))}
    return model.renamed(names), names, [names[w] for w in within]


def slim_rows(rows: DataFrame, columns: Sequence[str], model: Model, names: dict[str, str], unit: str) -> DataFrame:
    """``uid`` and the values under our names, as strings.

    Compared values are mapped to one character per UTF-8 byte here, once per record instead of
    once per pair; equality and blocking are unchanged by the mapping.
    """
    compared = set(model.columns)
    out = []
    for c, name in names.items():
        value = f"CAST(p{columns.index(c)} AS STRING)"
        out.append(f"{unit_sql(value, unit) if c in compared else value} AS {name}")
    return rows.selectExpr("uid", *out)


def resolve(
    df: DataFrame,
    columns: str | Sequence[str] | None = None,
    *,
    threshold: float = DEFAULT_THRESHOLD,
    train: bool = False,
    prior: float = DEFAULT_PRIOR,
    model: Model | str | dict | None = None,
    id_col: str | None = None,
    unit: str = "byte",
    within: Sequence[str] = (),
    blocking: Sequence[str | Sequence[str]] = (),
    block_split: int | None = DEFAULT_BLOCK_SPLIT,
    check_ids: bool = True,
    ordered: bool = False,
    train_options: dict | None = None,
    on_model: Callable[[Model], None] | None = None,
) -> DataFrame:
    """Resolve entities of a whole relation.

    Returns every input row unchanged (input columns named like ``cluster_id`` or
    ``match_probability`` in any letter case are replaced) plus ``cluster_id`` (string; "0", "1", ... in
    order of each cluster's first row) and ``match_probability`` (strongest kept pair touching the row;
    1.0 for a singleton). "First" means smallest ``id_col``, or input order when no id is given.

    ``model`` (a :class:`Model`, its JSON or dict, or the path of its JSON) is used as-is and wins
    over ``train``. ``blocking`` are the rules that make candidate pairs (tuples of columns; default: the model's,
    else each compared column). ``train_options`` (``max_pairs``, ``seed``, ``iterations``) go to training, and
    ``on_model`` gets the model that is used, to be saved. ``ordered=True`` sorts the result into
    input order (a global sort). ``within`` restricts every blocking rule to records equal on those columns.
    """
    spark = df.sparkSession
    model = read_model(model, spark)
    cols = parse_columns(columns)
    if not cols and model is not None:
        cols = model.columns
    check_unit(unit)
    within = list(within)
    rules = as_rules(blocking)
    needed = list(dict.fromkeys([*cols, *(model.all_columns if model is not None else []), *rule_columns(rules, within)]))
    try:
        t_ok = 0.0 <= float(threshold) <= 1.0
    except (TypeError, ValueError):
        t_ok = False
    # Happy path: the emptiness and id checks run inside the block-maxima job (one action less).
    fused = (
        t_ok and bool(cols) and not df.isStreaming and id_col is not None and id_col in df.columns
        and check_ids and not train and all(c in df.columns for c in needed)
    )
    extra_stats = on_stats = None
    if fused:
        per_id = df.groupBy(F.col(q(id_col)).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        extra_stats = per_id.agg(
            F.count(F.lit(1)).cast("bigint").alias("ids"),
            F.coalesce(F.max(((F.col("n") > 1) | F.col("id").isNull()).cast("bigint")), F.lit(0)).alias("bad"),
        ).selectExpr(
            "inline(array(named_struct('rule', -2, 'largest', ids), named_struct('rule', -3, 'largest', bad)))"
        )

        def on_stats(stats: list[int]) -> None:
            ids, bad = stats
            if ids == 0:
                raise MatchError(EMPTY)
            if bad:
                raise MatchError(f"id column {id_col} must be unique and not NULL")

    else:
        with traced("checks"):
            check_inputs(df, cols, threshold, id_col, check_ids)
        require_columns(df, needed)

    given = list(df.columns)
    rows = with_uid(df, id_col)
    if model is None:
        model = Model.default(cols, prior)
        if train:
            from ..operators.training import train_model

            slim = slim_rows(rows, given, model, {c: c for c in model.columns}, unit)
            model = train_model(slim, model, id_col="uid", unit="char", **(train_options or {}))
    if rules:
        model = replace(model, blocking=tuple(rules))
    if on_model is not None:
        on_model(model)
    own, names, own_within = internal_model(model, within)
    persisted = [slim_rows(rows, given, model, names, unit).persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        # The values are one character per unit by now, so distances count characters.
        labels = resolve_labels(
            persisted[0], own, threshold, uid="uid", within=own_within, unit="char", block_split=block_split,
            extra_stats=extra_stats, on_stats=on_stats, persisted=persisted,
        )
        # Written, as it is read twice and holds one row per record only.
        labels = materialize(labels, "labels")
    finally:
        for df_ in persisted:
            df_.unpersist()
    per_row = labels.join(dense_ids(labels, "root", CLUSTER_COL), "root").selectExpr("uid", f"{CLUSTER_COL} AS cid", "best")
    # every uid has a label, so the join is inner; coalesce tells Spark that neither column is ever NULL
    out = rows.join(per_row, "uid")
    if ordered:
        # input order: by id_col, or by the generated id that follows the input
        out = out.orderBy("uid")
    keep = [i for i, c in enumerate(given) if c.lower() not in RESERVED_COLUMNS]
    out = out.select(*[f"p{i}" for i in keep], F.coalesce("cid", F.lit("")).alias("cid"), F.coalesce("best", F.lit(1.0)).alias("best"))
    out = out.toDF(*[given[i] for i in keep], CLUSTER_COL, PROB_COL)
    for name, comment in ((CLUSTER_COL, CLUSTER_COMMENT), (PROB_COL, PROB_COMMENT)):
        out = out.withMetadata(name, {"comment": comment})
    return out


def resolved_view(
    spark,
    name: str,
    relation: str | DataFrame,
    columns: str | Sequence[str],
    **options,
) -> DataFrame:
    """Resolve a relation (a DataFrame, a table name or a SQL query) and register the result as a temp view."""
    if isinstance(relation, DataFrame):
        df = relation
    elif relation.strip().lower().startswith(("select", "with", "values", "(")):
        df = spark.sql(relation)
    else:
        df = spark.table(relation)
    out = resolve(df, columns, **options)
    out.createOrReplaceTempView(name)
    return out
