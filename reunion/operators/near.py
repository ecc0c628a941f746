"""Candidate pairs whose values are at most k edits apart: a segment inverted index, exact.

A value of length L is cut into k + 1 segments (even ones, or for short values where a sample of that length shows that even ones
would be shared by many). k edits can't touch them all, so of two values at most k edits
apart the shorter one's segments leave one that stands unchanged in the longer one, and not far from
its own place: for a length difference d it is moved by at most ``(k - d) // 2`` to the left and
``(k + d) // 2`` to the right. So every value goes into the index by the hashes of its k + 1 segments (with
L and the segment's number), and asks for the hashes of its substrings in those windows, for each L from
its own length down to k less. Equal hashes are candidates, an edit distance bounded by k decides.

Everything is built-in expressions. Equal values are one value (by digest), named by its smallest id, so
copies cost one entry; index and questions carry ids and 64-bit hashes, and of values of up to ``SHORT_VALUE`` characters the values, so that
pairs of these are told by their distance where they meet and none that is too far moves on. Longer ones are fetched for
candidates only. Hot segments (a passage that many values of one length share) are tiled: their index rows and
questions are dealt into blocks, each pair of blocks is a key of its own.

Values of fewer than k + 1 characters have empty segments, which meet all values of that length: still exact. NULL is near nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.levels import distance_sql, q, unit_sql
from ..session import traced, write_table
from .blocking import DEFAULT_BLOCK_SPLIT, as_rules


#: Values of up to this many characters go along with their segments: many of them may share one by chance.
SHORT_VALUE = 64

#: Values of up to this many characters are cut where a sample of those of their length has the fewest equal segments.
CUT_LENGTH = 64
_CUT_SAMPLE = 300  # sampled values of a length
_CUT_LEAST = 30  # fewer: even segments


def _best_starts(values: list[str], k: int) -> list[int]:
    """Starts of ``k + 1`` segments of values of one length with the least sum of shares of equal pairs."""
    n, pairs = len(values[0]), len(values) * (len(values) - 1)

    def cost(s: int, e: int) -> float:
        # a sample doesn't show rare equality, so short segments cost at least what sixteen letters would give
        return sum(c * (c - 1) for c in Counter(v[s:e] for v in values).values()) / pairs + 16.0 ** (s - e)

    costs = {(s, e): cost(s, e) for s in range(n) for e in range(s + 1, n + 1)}
    best = {e: (costs[0, e], [0]) for e in range(1, n + 1)}
    for _ in range(k):
        best = {e: min((best[s][0] + costs[s, e], [*best[s][1], s]) for s in best if s < e) for e in range(min(best) + 1, n + 1)}
    base, even = n // (k + 1), k + 1 - n % (k + 1)
    starts = [i * base + max(0, i - even) for i in range(k + 1)]
    return best[n][1] if 2 * best[n][0] < sum(costs[s, e] for s, e in zip(starts, [*starts[1:], n])) else starts


def segment_starts(values: DataFrame, k: int) -> dict[int, list[int]]:
    """Starts of the segments by length, where even ones would be shared by many values; ``values`` has ``v`` and its length ``n``.

    Every choice finds all near pairs, so a bounded sample (by a hash of the value) is enough: the number of values of a length, then some of each.
    """
    short = values.where(f"n BETWEEN {2 * (k + 1)} AND {CUT_LENGTH}")
    with traced("near-lengths"):
        many = {r["n"]: r["many"] for r in short.groupBy("n").agg(F.count(F.lit(1)).alias("many")).collect()}
    if not many:
        return {}
    every = ", ".join(f"{n}L, {-(-m // _CUT_SAMPLE)}L" for n, m in many.items())
    some = short.where(f"pmod(xxhash64(v), element_at(map({every}), n)) = 0").select("n", "v").distinct()
    per_length = some.groupBy("n").agg(F.slice(F.sort_array(F.collect_set("v")), 1, 2 * _CUT_SAMPLE).alias("vs"))
    with traced("near-starts"):
        return {r["n"]: _best_starts(r["vs"], k) for r in per_length.collect() if len(r["vs"]) >= _CUT_LEAST}


def _segment(length: str, i: str, k: int, starts: dict[int, list[int]]) -> tuple[str, str]:
    """Start (from 0) and size of segment ``i`` of a value of that length (SQL); of even ones the last take the remainder."""
    base, even = f"({length} div {k + 1})", f"({k + 1} - {length} % {k + 1})"
    start, size = f"({i} * {base} + greatest(0, {i} - {even}))", f"({base} + IF({i} >= {even}, 1, 0))"
    if not starts:
        return start, size
    of = f"element_at(map({', '.join(f'{n}L, array({_longs([*s, n])})' for n, s in starts.items())}), CAST({length} AS BIGINT))"
    own, end = f"element_at({of}, CAST({i} AS INT) + 1)", f"element_at({of}, CAST({i} AS INT) + 2)"
    return f"coalesce({own}, {start})", f"coalesce({end} - {own}, {size})"


def _longs(values: Sequence[int]) -> str:
    return ", ".join(f"{v}L" for v in values)


def segment_keys_sql(value: str, k: int, starts: dict[int, list[int]] | None = None) -> tuple[str, str]:
    """The hashes a value is indexed by, and those it asks for (SQL arrays). ``value`` is a column name, ``n`` its length."""
    starts = starts or {}

    def key(length: str, start: str, size: str) -> str:
        return f"xxhash64({length}, i, substr({value}, CAST({start} AS INT) + 1, CAST({size} AS INT)))"

    start, size = _segment("n", "i", k, starts)
    indexed = f"transform(sequence(0, {k}), i -> {key('n', start, size)})"
    start, size = _segment("m", "i", k, starts)
    low, high = f"greatest(0, {start} - ({k} - n + m) div 2)", f"least(n - {size}, {start} + ({k} + n - m) div 2)"
    window = f"CASE WHEN {high} < {low} THEN CAST(array() AS ARRAY<BIGINT>) ELSE transform(sequence({low}, {high}), p -> {key('m', 'p', size)}) END"
    asked = f"flatten(transform(sequence(greatest(0L, n - {k}), n), m -> flatten(transform(sequence(0, {k}), i -> {window}))))"
    return indexed, f"array_distinct({asked})"


def _tiled(index: DataFrame, asked: DataFrame, split: int | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the columns of the join key; keys that over ``split`` values are indexed by get tiles."""
    if not split:
        return index, asked, ["key"]
    hot = index.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > split)
    hot = hot.select("key", F.ceil(F.col("many") / F.lit(split)).cast("int").alias("s"))
    with traced("near-hot-segments"):
        if hot.isEmpty():
            return index, asked, ["key"]
    each = F.explode(F.sequence(F.lit(0), F.col("s") - 1))
    sides = []
    for side, own, other in ((index, "x", "y"), (asked, "y", "x")):
        tagged = side.join(hot, "key", "left").withColumn("s", F.coalesce("s", F.lit(1)))
        sides.append(tagged.withColumn(own, F.pmod(F.xxhash64("vid"), "s").cast("int")).withColumn(other, each).drop("s"))
    return sides[0], sides[1], ["key", "x", "y"]


_BINS = 37  # bins of symbols: digits and letters a to y have one each


def _symbols_sql(value: str) -> str:
    """A struct of two numbers whose bits are the bins of symbols that a value has, and has twice (SQL)."""
    bit = f"shiftleft(1L, CAST(pmod(ascii(substr({value}, i, 1)), {_BINS}) AS INT))"
    none = "named_struct('x', 0L, 'y', 0L)"
    each = f"aggregate(sequence(1, CAST(length({value}) AS INT)), {none}, (s, i) -> named_struct('x', s.x | {bit}, 'y', s.y | (s.x & {bit})))"
    return f"IF(length({value}) = 0, {none}, {each})"


def _near_sql(edits: int) -> str:
    """Whether two short values may be, and are, within the edits: an edit takes one symbol away and brings one. Long ones are not known here."""
    lost = [f"bit_count({a}.has.x & ~{b}.has.x) + bit_count({a}.has.y & ~{b}.has.y) <= {edits}" for a, b in ("lr", "rl")]
    return f"(l.v IS NULL OR r.v IS NULL OR ({' AND '.join(lost)} AND levenshtein(l.v, r.v, {edits}) >= 0))"


class NearValues:
    """Values of one column and the pairs of them that may be within ``edits``: ``members(uid, vid)`` and ``candidates(a, b)``.

    ``vid`` is the smallest id that holds the value; candidates are pairs ``a < b`` of those (of short values only those that are within).
    """

    def __init__(self, rows: DataFrame, column: str, edits: int, *, id_col: str = "uid", unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT):
        if edits < 0:
            raise ValueError(f"edits must not be negative, got {edits}")
        self.column, self.edits, self.unit = column, edits, unit
        value = rows.where(F.col(q(column)).isNotNull()).selectExpr(f"{q(id_col)} AS uid", f"CAST({q(column)} AS STRING) AS t")
        # 128 bits: values are told apart by it, never shuffled
        self._digests = value.selectExpr("uid", "unhex(md5(t)) AS digest")
        mapped = value.selectExpr("uid", "unhex(md5(t)) AS digest", f"{unit_sql('t', unit)} AS v").selectExpr("uid", "digest", "v", "CAST(length(v) AS BIGINT) AS n")
        indexed, asked = segment_keys_sql("v", edits, segment_starts(mapped, edits))
        keyed = mapped.selectExpr("uid", "digest", "n", f"IF(n <= {SHORT_VALUE}, v, NULL) AS v", f"{indexed} AS indexed", f"{asked} AS asked")
        distinct = keyed.groupBy("digest").agg(F.min("uid").alias("vid"), F.count(F.lit(1)).alias("holders"), *[F.first(c).alias(c) for c in ("n", "v", "indexed", "asked")])
        distinct = distinct.selectExpr("*", f"CASE WHEN v IS NOT NULL THEN {_symbols_sql('v')} END AS has")
        self.values, self.folder = write_table(distinct, "near-values")
        index = self.values.select("vid", "n", "v", "has", F.explode("indexed").alias("key"))
        question = self.values.select("vid", "n", "v", "has", F.explode("asked").alias("key"))
        left, right, keys = _tiled(index, question, block_split)
        # dealt over all shuffle partitions: the work is in the pairs that meet, not in the bytes that AQE would go by
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
        # the longer value asks; of two equally long ones that of the larger id
        meet = [f"l.{k} = r.{k}" for k in keys] + ["(l.n < r.n OR l.vid < r.vid)", "l.vid <> r.vid", _near_sql(edits)]
        joined = left.alias("l").join(right.alias("r"), F.expr(" AND ".join(meet)))
        self.candidates = joined.select(F.least("l.vid", "r.vid").alias("a"), F.greatest("l.vid", "r.vid").alias("b")).distinct()

    @property
    def members(self) -> DataFrame:
        return self._digests.join(self.values.select("digest", "vid"), "digest").select("uid", "vid")


def value_distances(near: NearValues, rows: DataFrame, id_col: str = "uid") -> DataFrame:
    """``(a, b, distance)`` of the candidates that are within the edits; ``rows`` are those that ``near`` was made of."""
    text = rows.selectExpr(f"{q(id_col)} AS uid", f"CAST({q(near.column)} AS STRING) AS t")
    pairs = near.candidates.join(text.select(F.col("uid").alias("a"), F.col("t").alias("s")), "a").join(text.select(F.col("uid").alias("b"), "t"), "b")
    return pairs.selectExpr("a", "b", f"{distance_sql('s', 't', near.edits, near.unit)} AS distance").where("distance >= 0")


def near_value_pairs(rows: DataFrame, column: str, edits: int, *, id_col: str = "uid", unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT) -> DataFrame:
    """``(a, b, distance)``: all pairs of different values at most ``edits`` apart, each value named by its smallest id."""
    return value_distances(NearValues(rows, column, edits, id_col=id_col, unit=unit, block_split=block_split), rows, id_col)


def near_pairs(
    rows: DataFrame,
    near: Sequence[tuple[str, int]],
    rules: Sequence[str | Sequence[str]] = (),
    *,
    id_col: str = "uid",
    within: Sequence[str] = (),
    carry: Sequence[str] = (),
    unit: str = "byte",
    block_split: int | None = DEFAULT_BLOCK_SPLIT,
) -> list[DataFrame]:
    """Per near rule ``(column, edits)`` the pairs ``uid_l < uid_r`` of records whose values are within the edits.

    Columns as those of ``candidate_pairs``; rules count on behind ``rules``. Pairs that an earlier rule
    (agreement on all its columns, or an earlier near rule) gives are left out.
    """
    rules, out = as_rules(rules), []
    needed = list(dict.fromkeys([*[c for r in rules for c in r], *within, *[c for c, _ in near], *carry]))
    table = rows.selectExpr(f"{q(id_col)} AS uid", *[q(c) for c in needed])

    def agree(columns: Sequence[str]) -> str:
        return "coalesce(" + " AND ".join(f"l.{q(c)} = r.{q(c)}" for c in dict.fromkeys([*columns, *within])) + ", false)"

    def close(column: str, edits: int) -> str:
        return f"coalesce({distance_sql(f'l.{q(column)}', f'r.{q(column)}', edits, unit)} >= 0, false)"

    for k, (column, edits) in enumerate(near):
        values = NearValues(rows, column, edits, id_col=id_col, unit=unit, block_split=block_split)
        pairs = values.candidates
        if (column,) not in rules:  # equal values are near too
            pairs = pairs.unionByName(values.values.where("holders > 1").select(F.col("vid").alias("a"), F.col("vid").alias("b")))
        left, right = (values.members.select(F.col("uid").alias(u), F.col("vid").alias(v)) for u, v in (("x", "a"), ("y", "b")))
        ids = pairs.join(left, "a").join(right, "b").where("a <> b OR x < y").selectExpr("least(x, y) AS uid_l", "greatest(x, y) AS uid_r")
        cond = [close(column, edits)] + [f"l.{q(w)} = r.{q(w)}" for w in within]
        cond += [f"NOT {agree(r)}" for r in rules] + [f"NOT {close(*early)}" for early in near[:k]]
        joined = ids.join(table.alias("l"), F.expr("uid_l = l.uid")).join(table.alias("r"), F.expr("uid_r = r.uid")).where(" AND ".join(cond))
        out.append(joined.selectExpr("uid_l", "uid_r", f"{len(rules) + k} AS rule", *[f"{side}.{q(c)} AS {q(c + '_' + side)}" for c in carry for side in ("l", "r")]))
    return out
