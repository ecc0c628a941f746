"""Blocking: candidate pairs that agree on all columns of at least one rule.

A rule is a tuple of columns (by default each comparison column is a rule). Every record is
stacked once per rule as ``(rule, key)``, the key being a 64-bit hash of the rule's values (records
with a NULL among them are left out), and the stack is joined with itself on ``(rule, key)``: one
equi-join for all rules, whose two sides are the same plan, so Spark shuffles the stack once
and reuses the exchange. The values are compared again in the join, so a hash collision makes
no pair. Rule k keeps only pairs that do *not* agree on any earlier rule, so every pair comes
out exactly once without a dedup shuffle, and no ``OR`` of equalities (which Catalyst would plan as
a nested-loop join) appears. ``within`` columns are part of every rule.

Hot blocks: a block of n records makes n(n-1)/2 pairs. Blocks above ``block_split``
records are salted: each record gets a bucket in ``[0, s)``, is copied once per bucket
pair it takes part in, and the join key becomes (rule, key, low bucket, high bucket). A
hot block is then spread over s(s+1)/2 tasks instead of one, and each pair still comes out
once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.levels import q
from ..session import traced

# Records per salt bucket of a hot block (largest block handled by one task unsalted).
DEFAULT_BLOCK_SPLIT = 5000


Rules = Sequence[str | Sequence[str]]


def as_rules(rules: Rules) -> list[tuple[str, ...]]:
    """Rules as column tuples; a plain name is a rule of one column."""
    return [(r,) if isinstance(r, str) else tuple(r) for r in rules]


def rule_columns(rules: Rules, within: Sequence[str] = ()) -> list[str]:
    return list(dict.fromkeys([*[c for r in as_rules(rules) for c in r], *within]))


def stack_rules(
    slim: DataFrame, rules: Rules, *, id_col: str, within: Sequence[str] = (), carry: Sequence[str] = ()
) -> DataFrame:
    """``(uid, <carry...>, rule, key)``: one row per record and rule whose values are not NULL."""
    entries = []
    for k, rule in enumerate(as_rules(rules)):
        parts = list(dict.fromkeys([*rule, *within]))
        # NULLs are excluded, so the hash of the values one after the other identifies them but for collisions
        key = f"xxhash64({k}, {', '.join(f'CAST({q(x)} AS STRING)' for x in parts)})"
        nonnull = " AND ".join(f"{q(x)} IS NOT NULL" for x in parts)
        entries.append(f"CASE WHEN {nonnull} THEN named_struct('rule', {k}, 'key', {key}) END")
    return (
        slim.selectExpr(f"{q(id_col)} AS uid", *[q(c) for c in carry], f"explode(array({', '.join(entries)})) AS _rk")
        .where("_rk IS NOT NULL")
        .selectExpr("uid", *[q(c) for c in carry], "_rk.rule AS rule", "_rk.key AS key")
    )


def agree_sql(rules: Rules, within: Sequence[str] = (), left: str = "l", right: str = "r") -> list[str]:
    """Join conditions beside the equal key: the rule's values are equal, and no earlier rule agrees."""
    rules = as_rules(rules)

    def same(rule: Sequence[str]) -> str:
        return " AND ".join(f"{left}.{q(c)} = {right}.{q(c)}" for c in dict.fromkeys([*rule, *within]))

    cond = [f"({left}.rule <> {k} OR ({same(r)}))" for k, r in enumerate(rules)]
    cond += [f"NOT ({left}.rule > {j} AND coalesce({same(r)}, false))" for j, r in enumerate(rules[:-1])]
    return cond


def block_maxima(stacked: DataFrame, n_rules: int, extra: DataFrame | None = None) -> list[int]:
    """Largest block of every rule, from one aggregate with map-side partial counts.

    ``extra`` rows ``(rule, largest)`` with negative rules ride along in the same job and
    are returned after the rules.
    """
    sizes = stacked.groupBy("rule", "key").count()
    maxima = sizes.groupBy("rule").agg(F.max("count").cast("bigint").alias("largest"))
    if extra is not None:
        maxima = maxima.unionByName(extra)
    with traced("block-maxima"):
        rows = maxima.collect()
    out = [0] * n_rules
    tail: dict[int, int] = {}
    for r in rows:
        if r["rule"] >= 0:
            out[r["rule"]] = int(r["largest"] or 0)
        else:
            tail[r["rule"]] = int(r["largest"] or 0)
    return out + [tail[k] for k in sorted(tail, reverse=True)]


#: Buckets that a block is dealt into at most, unless a bucket would hold more than the default number of records. A record is
#: copied once per bucket, so a small ``block_split`` must not make as many as there are records in a block.
MAX_BUCKETS = 4


def tiles_of(sized: DataFrame, split: int) -> DataFrame:
    """Add ``_b`` (bucket) and one row per bucket pair ``(_lo, _hi)`` to records with the size ``_n`` of their block."""
    buckets = f"CAST(least(ceil(_n / {split}), greatest({MAX_BUCKETS}, ceil(_n / {DEFAULT_BLOCK_SPLIT}))) AS INT)"
    tagged = sized.withColumn("_s", F.expr(f"IF(_n > {split}, {buckets}, 1)"))
    tagged = tagged.withColumn("_b", F.pmod(F.xxhash64(F.col("uid")), F.col("_s")).cast("int"))
    tagged = tagged.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_s") - F.lit(1))))
    return tagged.select("*", F.least("_b", "_j").alias("_lo"), F.greatest("_b", "_j").alias("_hi")).drop("_j", "_s", "_n")


def _salt(stacked: DataFrame, split: int) -> DataFrame:
    """Add ``_b`` (bucket) and one row per bucket pair ``(_lo, _hi)``; cold blocks keep one copy."""
    hot = stacked.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(split))
    # broadcast or shuffled as its size in bytes decides (AQE)
    return tiles_of(stacked.join(hot, ["rule", "key"], "left").withColumn("_n", F.coalesce(F.col("_n"), F.lit(1))), split)


def candidate_pairs(
    slim: DataFrame,
    rules: Rules,
    *,
    id_col: str = "uid",
    within: Sequence[str] = (),
    carry: Sequence[str] | None = None,
    block_split: int | None = DEFAULT_BLOCK_SPLIT,
    maxima: Sequence[int] | None = None,
) -> DataFrame:
    """All pairs ``uid_l < uid_r`` that agree on all columns of at least one of ``rules``.

    Output: ``uid_l, uid_r, rule`` (index of the first agreeing rule) and, for every
    column in ``carry`` (default: the rules' columns), ``<c>_l`` and ``<c>_r``.
    """
    rules, within = as_rules(rules), list(within)
    carry = list(rule_columns(rules) if carry is None else carry)
    needed = list(dict.fromkeys([*rule_columns(rules, within), *carry]))
    stacked = stack_rules(slim, rules, id_col=id_col, within=within, carry=needed)
    if block_split and maxima is None:
        maxima = block_maxima(stacked, len(rules))
    return joined_pairs(stacked, rules, within, carry, block_split if block_split and max(maxima or [0]) > block_split else None)


def joined_pairs(stacked: DataFrame, rules: Rules, within: Sequence[str], carry: Sequence[str], salt: int | None) -> DataFrame:
    """The pairs of :func:`stack_rules` rows, blocks of over ``salt`` records spread over several tasks."""
    keys = ["rule", "key"]
    cond = []
    if salt:
        stacked = _salt(stacked, salt)
        keys += ["_lo", "_hi"]
        cond.append("(l._lo = l._hi OR l._b <> r._b)")
    cond = [f"l.{k} = r.{k}" for k in keys] + ["l.uid < r.uid"] + cond + agree_sql(rules, within)
    joined = stacked.alias("l").join(stacked.alias("r"), F.expr(" AND ".join(cond)), "inner")
    return joined.selectExpr(
        "l.uid AS uid_l",
        "r.uid AS uid_r",
        "l.rule AS rule",
        *[f"{side}.{q(c)} AS {q(c + '_' + side)}" for c in carry for side in ("l", "r")],
    )


def block_stats(slim: DataFrame, rules: Rules, *, within: Sequence[str] = ()) -> DataFrame:
    """Per blocking rule: records with a key, blocks, largest block and pairs inside blocks.

    ``pairs`` counts every pair of a block (before the exclusion of earlier rules): the
    work a rule alone would cause. Run it before a resolve to spot hot blocks.
    """
    parts = []
    for i, rule in enumerate(as_rules(rules)):
        keys = list(dict.fromkeys([*rule, *within]))
        nonnull = reduce(lambda a, b: a & b, [F.col(q(k)).isNotNull() for k in keys])
        sizes = slim.where(nonnull).groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            sizes.agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("records"),
                F.count(F.lit(1)).cast("bigint").alias("blocks"),
                F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("largest_block"),
                F.coalesce(F.expr("sum(n * (n - 1)) div 2"), F.lit(0)).cast("bigint").alias("pairs"),
            ).select(F.lit(i).alias("rule"), F.lit(",".join(rule)).alias("column"), "*")
        )
    return reduce(DataFrame.unionByName, parts)
