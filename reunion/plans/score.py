"""Score new records against known ones with a fixed model, without re-clustering (extension X1).

The same blocking, levels and probability as ``resolve``, but between two relations: each
new record is paired with the known records that agree with it on a blocking column
(one stacked equi-join for all rules), scored, and the best known record at or above the
threshold is kept (highest probability, then smallest known id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_THRESHOLD, PROB_COL
from ..errors import MatchError
from ..model import Model
from ..operators.blocking import DEFAULT_BLOCK_SPLIT, agree_sql, block_maxima, rule_columns, stack_rules
from ..operators.dense import DENSE_BLOCK, block_sizes, large_between, pairs_of, reachable_between
from ..operators.matching import TASK_LINKS, one_to_one
from ..operators.scoring import compare_pairs, link_pairs, prune_unreachable, score_pairs
from ..session import materialize
from .resolve import check_inputs, internal_model, positional, read_model, require_columns, slim_rows

MATCH_ID = "match_id"


def stack(df: DataFrame, model: Model, id_col: str, within: Sequence[str], unit: str) -> DataFrame:
    """``(uid, c0.., rule, key)`` of a relation: values under our own names, mapped to the unit once per record."""
    own, names, own_within = internal_model(model, within)
    rows = positional(df).withColumn("uid", F.col(f"p{df.columns.index(id_col)}"))
    slim = slim_rows(rows, df.columns, model, names, unit)
    carry = list(dict.fromkeys([*own.columns, *rule_columns(own.rules, own_within)]))
    return stack_rules(slim, own.rules, id_col="uid", within=own_within, carry=carry)


def hot_keys(stacked: DataFrame, split: int | None, maxima: Sequence[int], name: str) -> DataFrame | None:
    """``(rule, key, name)``: buckets of the blocks with over ``split`` records, or None without any (by the largest block of every rule)."""
    if not split or max(maxima or [0]) <= split:
        return None
    sizes = stacked.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(split))
    return sizes.select("rule", "key", F.ceil(F.col("_n") / F.lit(split)).cast("int").alias(name))


def salted(stacked: DataFrame, own: DataFrame | None, other: DataFrame | None, mine: str, theirs: str) -> DataFrame:
    """Bucket the records of own hot blocks, and copy each once per bucket of the other side's hot blocks."""
    out = stacked
    if own is None:
        out = out.withColumn(mine, F.lit(0))
    else:
        out = out.join(own.withColumnRenamed("_s", "_own"), ["rule", "key"], "left")
        out = out.withColumn(mine, F.expr("CAST(pmod(xxhash64(uid), coalesce(_own, 1)) AS INT)")).drop("_own")
    if other is None:
        return out.withColumn(theirs, F.lit(0))
    out = out.join(other.withColumnRenamed("_s", "_other"), ["rule", "key"], "left")
    return out.withColumn(theirs, F.explode(F.expr("sequence(0, coalesce(_other, 1) - 1)"))).drop("_other")


class KnownRecords:
    """The known side, stacked, salted and laid out by join key, for one or many batches of new records.

    Blocks of over ``block_split`` known records are spread over buckets; new records of such a
    block are copied once per bucket. Hot blocks of the new side are spread the same way, the known
    side being copied then. Blocks with many pairs are compared in matrices (``operators/dense.py``).
    """

    def __init__(self, known_df: DataFrame, model: Model, known_id: str, within: Sequence[str], unit: str, block_split: int | None):
        self.model, self.within, self.unit, self.split = model, list(within), unit, block_split
        if model.near:
            raise MatchError("rules of near values are for resolve; score new records with blocking rules")
        self.own, _, self.own_within = internal_model(model, within)
        self.stack = stack(known_df, model, known_id, within, unit)
        self.maxima = block_maxima(self.stack, len(self.own.rules))
        self.hot = hot_keys(self.stack, block_split, self.maxima, "_s")
        self.laid: DataFrame | None = None
        self.sizes = block_sizes(self.stack, self._values())

    def persist(self, partitions: int) -> KnownRecords:
        """Keep the known side in the join's own partitioning, so that a batch need not shuffle it again."""
        from pyspark import StorageLevel

        side = salted(self.stack, self.hot, None, "_kb", "_nb")
        self.laid = side.repartition(partitions, "rule", "key", "_kb", "_nb").persist(StorageLevel.MEMORY_AND_DISK)
        self.sizes = self.sizes.persist(StorageLevel.MEMORY_AND_DISK)
        if self.hot is not None:
            self.hot = self.hot.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        for df in (self.laid, self.sizes, self.hot):
            if df is not None:
                df.unpersist()

    def _values(self) -> list[str]:
        return list(dict.fromkeys([*self.own.columns, *rule_columns(self.own.rules, self.own_within)]))

    def _reachable(self, new_stack: DataFrame, maxima: Sequence[int], threshold: float) -> tuple[DataFrame, DataFrame | None]:
        """The new records without those of blocks with many pairs, and the pairs of these that may reach the threshold."""
        if threshold <= 0.0 or max([n * k for n, k in zip(maxima, self.maxima)] or [0]) <= pairs_of(DENSE_BLOCK):
            return new_stack, None
        large = materialize(large_between(block_sizes(new_stack, self._values()), self.sizes), "large-blocks")
        known = self.stack if self.laid is None else self.laid.drop("_kb", "_nb")
        pairs = reachable_between(new_stack, known, large, self.own.rules, self.own, threshold, within=self.own_within, unit="char", block_split=self.split)
        return new_stack.join(large, ["rule", "key"], "left_anti"), pairs

    def links(self, new_stack: DataFrame, threshold: float) -> DataFrame:
        """``(uid_l, uid_r, match_probability)``: new and known records at or above the threshold, each pair once."""
        maxima = block_maxima(new_stack, len(self.own.rules))
        new_stack, reachable = self._reachable(new_stack, maxima, threshold)
        new_hot = hot_keys(new_stack, self.split, maxima, "_s")
        if self.laid is not None and new_hot is None:
            known = self.laid
        else:  # hot blocks of the new side: the known side is copied over their buckets
            known = salted(self.stack, self.hot, new_hot, "_kb", "_nb")
        new = salted(new_stack, new_hot, self.hot, "_nb", "_kb")
        cond = [f"l.{k} = r.{k}" for k in ("rule", "key", "_kb", "_nb")] + agree_sql(self.own.rules, self.own_within)
        joined = new.alias("l").join(known.alias("r"), F.expr(" AND ".join(cond)))
        pairs = joined.selectExpr("l.uid AS uid_l", "r.uid AS uid_r", *[f"{x}.{c} AS {c}_{x}" for c in self.own.columns for x in ("l", "r")])
        if reachable is not None:
            pairs = pairs.unionByName(reachable)
        pairs = prune_unreachable(pairs, self.own, threshold, unit="char")
        return link_pairs(score_pairs(compare_pairs(pairs, self.own, unit="char"), self.own), threshold)


def best_matches(links: DataFrame) -> DataFrame:
    """``(uid, match_id, match_probability)``: best known record per new record."""
    best = links.groupBy("uid_l").agg(F.min(F.struct((-F.col(PROB_COL)).alias("np"), F.col("uid_r").alias("id"))).alias("b"))
    return best.selectExpr("uid_l AS uid", f"b.id AS {MATCH_ID}", f"-b.np AS {PROB_COL}")


def _joined(new_df: DataFrame, found: DataFrame, new_id: str) -> DataFrame:
    """Every new row plus what was found for it; columns named like the two results are replaced."""
    given = list(new_df.columns)
    if new_id not in given:
        raise MatchError(f"id column not found in input relation: {new_id}")
    rows = positional(new_df)
    keep = [i for i, c in enumerate(given) if c.lower() not in (MATCH_ID, PROB_COL)]
    out = rows.join(found, rows[f"p{given.index(new_id)}"] == found["uid"], "left").select(*[f"p{i}" for i in keep], MATCH_ID, PROB_COL)
    return out.toDF(*[given[i] for i in keep], MATCH_ID, PROB_COL)


def match_records(
    new_df: DataFrame,
    known_df: DataFrame,
    model: Model | str | dict,
    *,
    new_id: str,
    known_id: str,
    threshold: float = DEFAULT_THRESHOLD,
    unit: str = "byte",
    within: Sequence[str] = (),
    block_split: int | None = DEFAULT_BLOCK_SPLIT,
    check_ids: bool = True,
    task_links: int = TASK_LINKS,
) -> DataFrame:
    """Like :func:`score_records`, but one to one: a known record is the match of one new record at most.

    Links at or above the threshold are matched greedily, by probability, then new and known id.
    """
    model = read_model(model, new_df.sparkSession)
    needed = [*model.all_columns, *within]
    check_inputs(new_df, needed, threshold, new_id, check_ids)
    check_inputs(known_df, needed, threshold, known_id, check_ids)
    links = KnownRecords(known_df, model, known_id, within, unit, block_split).links(stack(new_df, model, new_id, within, unit), threshold)
    found = one_to_one(links, task_links=task_links).selectExpr("uid_l AS uid", f"uid_r AS {MATCH_ID}", PROB_COL)
    return _joined(new_df, found, new_id)


def score_records(
    new_df: DataFrame,
    known_df: DataFrame | None,
    model: Model | str | dict,
    *,
    new_id: str,
    known_id: str,
    threshold: float = DEFAULT_THRESHOLD,
    unit: str = "byte",
    within: Sequence[str] = (),
    block_split: int | None = DEFAULT_BLOCK_SPLIT,
    known: KnownRecords | None = None,
    check_ids: bool = True,
) -> DataFrame:
    """Every new row plus ``match_id`` (best known id, NULL if none) and ``match_probability``.

    The inputs get the checks of ``resolve``: not empty, threshold in [0, 1], columns there, ids
    unique and set (``check_ids``). Columns of the new rows named like the two results are replaced.
    """
    model = read_model(model, new_df.sparkSession)
    needed = [*model.all_columns, *within]
    if known is None:
        check_inputs(new_df, needed, threshold, new_id, check_ids)
        check_inputs(known_df, needed, threshold, known_id, check_ids)
        known = KnownRecords(known_df, model, known_id, within, unit, block_split)
    else:
        require_columns(new_df, needed)
    best = best_matches(known.links(stack(new_df, model, new_id, within, unit), threshold))
    return _joined(new_df, best, new_id)
