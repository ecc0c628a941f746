"""Pairs of large blocks, compared in matrices.

A block of n records has n (n - 1) / 2 pairs, and as rows of a join each of them costs microseconds. Blocks of over
``DENSE_BLOCK`` records are therefore dealt into tiles (pairs of buckets of records, each a group of its own) and a task compares a tile's
records in matrices: the symbols that two values share, repeats counted, are a matrix product, and bound the edit distance from below and
Jaro-Winkler from above. Still every pair of a block, but some nanoseconds each:

- ``reachable_pairs`` gives those that the bounds leave a probability at or above the threshold, for the exact comparison; no link is lost.
  ``reachable_between`` does so for two relations, a block's pairs being those of its records of the one with those of the other.
- ``level_counts`` gives the number of pairs of every level pattern; levels that the bounds leave open are computed exactly.
- ``pair_levels`` gives every pair with its levels. A task returns a row per record and run of records, with lists of the others' ids and levels,
  which Spark explodes: a pair costs an element of a list, not a row of the worker's.

Blocks with values of over ``LONG_VALUE`` characters go the way of the small ones, by a join.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import JW_BOOST_THRESHOLD, JW_PREFIX_MAX, JW_PREFIX_SCALE, JW_ROUND_DIGITS, NULL_LEVEL
from ..functions.levels import LONG_VALUE, edit_band_table, q
from ..functions.similarity import _CELLS, _codes, _padded, _scores
from ..model import Comparison, Model
from .blocking import DEFAULT_BLOCK_SPLIT, MAX_BUCKETS, Rules, as_rules, candidate_pairs, joined_pairs, rule_columns, stack_rules, tiles_of
from .scoring import PRUNE_MARGIN, compare_pairs, level_col

# The matrices are made in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Records from which on a block is compared in matrices.
DENSE_BLOCK = 100

_ROWS, _COLS = 256, 2048  # pairs of one matrix
_RUN = 512  # records of a side of a matrix of bounds, which stays in a core's cache
_LENGTHS = 32  # lengths of values that a product of matrices tells apart
_SYMBOLS = 128  # symbols told apart; others fall together, which keeps the bounds
_REPEATS = 4  # repeats of a symbol that are counted one by one
_EMIT = 50_000  # pairs of one batch of results
_SLACK = 1e-5  # single precision of the bounds


@dataclass(frozen=True)
class Bound:
    """A comparison's bound: ``least``, and what each limit that a pair meets adds (``own``: on the measure, ``jw``: on Jaro-Winkler, which is 0 for the exact level)."""

    column: str
    kind: str
    least: float
    steps: tuple[tuple[float, float, float], ...]

    @property
    def most(self) -> float:
        return self.least + sum(gain for _, _, gain in self.steps)


def _measure_limit(jw: float) -> float:
    """The least ``m / |a| + m / |b|`` of m shared symbols with which Jaro-Winkler may reach ``jw``."""
    full = JW_PREFIX_MAX * JW_PREFIX_SCALE
    jaro = jw if jw <= JW_BOOST_THRESHOLD else max(JW_BOOST_THRESHOLD, (jw - full) / (1.0 - full))
    return 3.0 * jaro - 1.0 - _SLACK


def _steps(comp: Comparison) -> list[tuple[float, float, int]]:
    """Limits from the widest to the narrowest: ``(measure, Jaro-Winkler, level that becomes possible)``."""
    if comp.kind == "name":
        bands = [(_measure_limit(t), t - 1e-6, lvl) for t, lvl in reversed(comp.band_levels())]
        return [*bands, (2.0 - _SLACK, 0.0, comp.exact_level)]
    bound, table = edit_band_table(comp)
    # distance d: shared symbols less the longer length is -d at least; all shared: equal values too
    return [*[(-d - 0.5, 0.0, table[d + 1]) for d in range(bound, 0, -1)], (-0.5, 0.0, comp.exact_level)]


def bound_of(comp: Comparison) -> Bound:
    """Bounds of log2 of the comparison's factor."""
    logs = [max(math.log2(f), -1e4) if f > 0 else -1e4 for f in comp.factors]
    best, steps = logs[0], []
    for own, jw, level in _steps(comp):
        now = max(best, logs[level])
        if now > best:
            steps.append((own, jw, now - best))
        best = now
    return Bound(comp.column, comp.kind, logs[0], tuple(steps))


class _Values:
    """One column of a tile's records as matrices."""

    def __init__(self, values: list, encode: bool):
        self.null = np.array([v is None for v in values])
        self.flat, self.size = _codes(["" if v is None else v for v in values], encode)
        self.start = np.cumsum(self.size) - self.size
        self.empty = (self.size == 0) & ~self.null
        n = len(values)
        symbols, at = np.unique(self.flat, return_inverse=True)
        wide = max(1, min(len(symbols), _SYMBOLS))
        rows = np.repeat(np.arange(n), self.size)
        count = np.bincount(rows * wide + at % wide, minlength=n * wide).reshape(n, wide)
        # what two counts share is at most the product beyond the repeats counted one by one
        parts = [count >= k for k in range(1, _REPEATS + 1)] + [np.maximum(count - _REPEATS, 0)]
        # what is equal in all records is one number, and columns that are the same in all are one with a weight
        alike: dict[bytes, list[int]] = {}
        whole = np.concatenate(parts, axis=1).T.astype(np.uint16)
        for k in np.flatnonzero(whole.any(axis=1)):
            alike.setdefault(whole[k].tobytes(), []).append(k)
        first, self.weight = [k[0] for k in alike.values()], np.array([len(k) for k in alike.values()], np.float32)
        self.shared = np.ascontiguousarray(whole[first].T.astype(np.float32))
        set_ = np.flatnonzero(~self.null)
        self.fixed = np.zeros(len(first), bool) if not len(set_) else (self.shared[set_] == self.shared[set_[0]]).all(axis=0)
        self.always = float((self.weight * self.shared[set_[0]] ** 2)[self.fixed].sum()) if len(set_) else 0.0
        self.length = self.size.astype(np.float32)
        self.inverse = np.divide(1.0, self.length, out=np.zeros(n, np.float32), where=self.size > 0)

    @cached_property
    def across(self) -> np.ndarray:
        """The i-th symbols of all values, -1 beyond their ends."""
        kind = np.int16 if self.flat.dtype == np.uint8 else np.int32
        out = np.full((int(self.size.max(initial=0)), len(self.size)), -1, kind)
        out[np.arange(len(self.flat)) - np.repeat(self.start, self.size), np.repeat(np.arange(len(self.size)), self.size)] = self.flat
        return out

    @cached_property
    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two matrices whose product is the number of shared symbols (of set values)."""
        right = self.shared[:, ~self.fixed]
        left = right * self.weight[~self.fixed]
        n = len(right)
        return np.column_stack([left, np.full(n, self.always, np.float32)]), np.column_stack([right, np.ones(n, np.float32)])

    @cached_property
    def edits(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Two matrices whose product is the number of shared symbols less the longer length (of set values); None for many lengths.

        The longer length is the sum less the shorter, and that the sum of the steps between lengths that both reach.
        """
        steps = np.unique(self.length)
        if len(steps) > _LENGTHS:
            return None
        left, right = self.names
        reached = (self.length[:, None] >= steps[1:]).astype(np.float32)
        left = np.column_stack([left[:, :-1], left[:, -1] + steps[0] - self.length, np.ones(len(left), np.float32), reached * np.diff(steps)])
        return left, np.column_stack([right, -self.length, reached])

    def measure(self, kind: str, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of all pairs of two runs of records: ``m / |a| + m / |b|`` of m shared symbols (names), or m less the longer length."""
        if kind != "name" and self.edits is not None:
            return self.edits[0][x] @ self.edits[1][y].T
        both = self.names[0][x] @ self.names[1][y].T
        if kind == "name":
            both *= np.add.outer(self.inverse[x], self.inverse[y])
        else:
            both -= np.maximum.outer(self.length[x], self.length[y])
        return both

    def prefix(self) -> np.ndarray:
        """The first symbols, equal ones where both values have ended (such values are equal)."""
        inside = np.arange(JW_PREFIX_MAX) < self.size[:, None]
        at = np.minimum(self.start[:, None] + np.arange(JW_PREFIX_MAX), max(len(self.flat) - 1, 0))
        return np.where(inside, self.flat[at].astype(np.int64) if len(self.flat) else -1, -1)


def _tile_pairs(b: np.ndarray, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Runs of places whose pairs make up a tile, and a mask where a run meets itself."""
    left = np.flatnonzero(b == lo)
    right = left if lo == hi else np.flatnonzero(b == hi)
    for s in range(0, len(left), _ROWS):
        x = left[s : s + _ROWS]
        for e in range(s if lo == hi else 0, len(right), _COLS):
            y = right[e : e + _COLS]
            yield x, y, x[:, None] < y[None, :] if lo == hi else None


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    """A group's records, ordered by id."""
    table = pa.Table.from_batches(list(batches)).combine_chunks()
    return table.take(pc.sort_indices(table, sort_keys=[("uid", "ascending")])).combine_chunks()


def _met(bounds: Sequence[Bound], start: float, limit: float):
    """When the sum of the bounds may reach the limit: True, False, or a list of (the first column's step met, the same for the other columns)."""
    if start + sum(c.least for c in bounds) >= limit:
        return True
    if start + sum(c.most for c in bounds) < limit:
        return False
    here, others = bounds[0], bounds[1:]
    ways, part = [], here.least
    for k in range(len(here.steps) + 1):
        if k:
            part += here.steps[k - 1][2]
        rest = _met(others, start + part, limit)
        # a step is met only with those before, so it matters where it asks less of the others
        if rest is not False and (not ways or ways[-1][1] != rest):
            ways.append((k, rest))
        if rest is True:
            break
    return ways


def _may(ways, met, column: int = 0) -> np.ndarray | None:
    """The pairs (None: all) of which ``_met`` is true; ``met(c, k)`` is the mask of step k of the c-th column."""
    if ways is True:
        return None
    out = None
    for k, rest in ways:
        more = _may(rest, met, column + 1)
        own = None if k == 0 else met(column, k - 1)
        one = more if own is None else own if more is None else own & more
        if one is None:
            return None
        out = one if out is None else out | one
    return out


def _reach(columns: dict[str, _Values], bounds: Sequence[Bound], base: float, limit: float, b: np.ndarray, lo: int, hi: int):
    """Places of the pairs of a tile that may reach the limit."""
    prefixes = {c.column: columns[c.column].prefix() for c in bounds if c.kind == "name"}
    unset = np.zeros(len(b), np.int64)  # the columns without a value: they add nothing to a pair's sum
    for k, c in enumerate(bounds):
        unset |= columns[c.column].null.astype(np.int64) << k
    trees: dict[int, tuple] = {}
    for x, y, mask in _runs(b, unset, lo, hi):
        none = int(unset[x[0]] | unset[y[0]])
        if none not in trees:
            some = [c for k, c in enumerate(bounds) if not none >> k & 1]
            trees[none] = some, _met(some, base, limit)
        some, ways = trees[none]
        if ways is False:
            continue
        measures: dict[int, np.ndarray] = {}

        def measure(k: int) -> np.ndarray:
            if k not in measures:
                v = columns[some[k].column]
                measures[k] = v.measure(some[k].kind, x, y)
                if some[k].kind == "name" and v.empty.any():  # nothing is known of these
                    measures[k][v.empty[x], :] = np.inf
                    measures[k][:, v.empty[y]] = np.inf
            return measures[k]

        masks: dict[tuple[int, int], np.ndarray] = {}

        def met(k: int, step: int) -> np.ndarray:
            if (k, step) not in masks:
                masks[k, step] = measure(k) >= np.float32(some[k].steps[step][0])
            return masks[k, step]

        may = _may(ways, met)
        if may is None:
            may = np.ones((len(x), len(y)), bool)
        if mask is not None:
            may = may & mask
        at = np.flatnonzero(may)
        if not len(at):
            continue
        i, j = np.divmod(at, len(y))
        sums = np.full(len(at), base, np.float32)
        for k, c in enumerate(some):
            m = measure(k).ravel()[at]
            if c.kind == "name":
                first, v = prefixes[c.column], columns[c.column]
                same = np.cumprod(first[x[i]] == first[y[j]], axis=1).sum(axis=1)
                jaro = (np.minimum(m, 2.0) + 1.0) / 3.0
                jw = np.where(jaro > JW_BOOST_THRESHOLD - 1e-6, jaro + same * JW_PREFIX_SCALE * (1.0 - jaro), jaro)
                part = np.full(len(at), c.least, np.float32)
                for own, band, gain in c.steps:
                    part += ((m >= own) & (jw >= band - _SLACK)) * np.float32(gain)
                part[np.isinf(m)] = c.most
            else:
                part = np.full(len(at), c.least, np.float32)
                for own, _, gain in c.steps:
                    part += (m >= own) * np.float32(gain)
            sums += part
        kept = sums >= limit
        p, r = x[i[kept]], y[j[kept]]
        yield np.minimum(p, r), np.maximum(p, r)


def _runs(b: np.ndarray, kind: np.ndarray, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Runs of places of one kind each whose pairs make up a tile, and a mask where a run meets itself."""
    left = [np.flatnonzero((b == lo) & (kind == k)) for k in np.unique(kind)]
    right = left if lo == hi else [np.flatnonzero((b == hi) & (kind == k)) for k in np.unique(kind)]
    for g, xs in enumerate(left):
        for h in range(g if lo == hi else 0, len(right)):
            itself = lo == hi and g == h
            for s in range(0, len(xs), _RUN):
                x = xs[s : s + _RUN]
                for e in range(s if itself else 0, len(right[h]), _RUN):
                    y = right[h][e : e + _RUN]
                    yield x, y, x[:, None] < y[None, :] if itself and e == s else None


def _dealt(tiles: DataFrame) -> GroupedData:
    """Tiles as groups, dealt over all shuffle partitions: their work grows with the pairs, not the bytes, so AQE must not put partitions together by bytes."""
    keys = ["rule", "key", "_lo", "_hi"]
    return tiles.repartition(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).groupBy(*keys)


def _longest(columns: Sequence[str]):
    return F.greatest(F.lit(0), *[F.coalesce(F.length(q(c)), F.lit(0)) for c in columns])


def _large(stacked: DataFrame, columns: Sequence[str], least: int) -> DataFrame:
    """``(rule, key, _n)`` of the blocks of over ``least`` records without a long value."""
    sizes = stacked.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("_n"), F.max(_longest(columns)).alias("_long"))
    return sizes.where((F.col("_n") > least) & (F.col("_long") <= LONG_VALUE)).select("rule", "key", "_n")


def _plans(rules: Sequence[Sequence[str]], within: Sequence[str], model: Model, threshold: float) -> list[tuple[float, float, list[Bound]]]:
    """Per rule: what its equal columns give, the limit of the sum, and the bounds of the other columns."""
    base = math.log2(model.prior_odds)
    below = float(threshold) - PRUNE_MARGIN
    bounds = {c.column: bound_of(c) for c in model.comparisons}
    plans = []
    for rule in rules:
        fixed = [c for c in model.comparisons if c.column in {*rule, *within}]
        start = base + sum(math.log2(c.factors[c.exact_level]) for c in fixed if c.factors[c.exact_level] > 0)
        open_ = [b for b in bounds.values() if b.column not in {*rule, *within}]
        size = abs(start) + sum(abs(b.least) + abs(b.most) for b in open_)
        plans.append((start, math.log2(below / (1.0 - below)) - 1e-3 - 1e-6 * size if below > 0 else -math.inf, open_))
    return plans


def _agreeing(rules: Sequence[Sequence[str]], within: Sequence[str]) -> list[str]:
    """Conditions on pairs as ``agree_sql`` has them for joins: the rule's values are equal, and no earlier rule agrees."""

    def same(rule: Sequence[str]) -> str:
        return " AND ".join(f"{q(c + '_l')} = {q(c + '_r')}" for c in dict.fromkeys([*rule, *within]))

    cond = [f"(rule <> {k} OR ({same(r)}))" for k, r in enumerate(rules)]
    return cond + [f"NOT (rule > {j} AND coalesce({same(r)}, false))" for j, r in enumerate(rules[:-1])]


def reachable_pairs(
    slim: DataFrame, rules: Rules, model: Model, threshold: float, *, id_col: str = "uid", within: Sequence[str] = (), carry: Sequence[str],
    unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT, maxima: Sequence[int], dense_block: int | None = None,
) -> DataFrame:
    """``candidate_pairs`` without pairs of large blocks that are sure to stay below the threshold."""
    rules, within = as_rules(rules), list(within)
    dense_block = DENSE_BLOCK if dense_block is None else dense_block
    if threshold <= 0.0 or max(maxima or [0]) <= dense_block:
        return candidate_pairs(slim, rules, id_col=id_col, within=within, carry=carry, block_split=block_split, maxima=maxima)
    needed = list(dict.fromkeys([*rule_columns(rules, within), *carry]))
    stacked = stack_rules(slim, rules, id_col=id_col, within=within, carry=needed)
    large = _large(stacked, needed, dense_block)
    small = joined_pairs(stacked.join(large, ["rule", "key"], "left_anti"), rules, within, carry, block_split if max(maxima) > (block_split or 0) else None)

    plans = _plans(rules, within, model, threshold)
    encode = unit == "byte"

    def search(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, lo, hi = key[0].as_py(), key[2].as_py(), key[3].as_py()
        start, limit, open_ = plans[rule]
        table = _whole(batches)
        columns = {b.column: _Values(table.column(b.column).to_pylist(), encode) for b in open_}
        sides = [table.column(c).combine_chunks() for c in needed]
        uid = table.column("uid").combine_chunks()
        names = ["uid_l", "uid_r", "rule", *[f"{c}_{s}" for c in needed for s in ("l", "r")]]
        for p, r in _reach(columns, open_, start, limit, table.column("_b").to_numpy(), lo, hi):
            for at in range(0, len(p), _EMIT):
                i, j = pa.array(p[at : at + _EMIT]), pa.array(r[at : at + _EMIT])
                out = [uid.take(i), uid.take(j), pa.array(np.full(len(i), rule, np.int32))]
                yield pa.RecordBatch.from_arrays([*out, *[s.take(k) for s in sides for k in (i, j)]], names)

    kinds = {f.name: f.dataType for f in stacked.schema.fields}
    schema = T.StructType(
        [T.StructField("uid_l", kinds["uid"]), T.StructField("uid_r", kinds["uid"]), T.StructField("rule", T.IntegerType())]
        + [T.StructField(f"{c}_{s}", kinds[c]) for c in needed for s in ("l", "r")]
    )
    tiles = tiles_of(stacked.join(large, ["rule", "key"]), block_split or DEFAULT_BLOCK_SPLIT).select("uid", *[q(c) for c in needed], "rule", "key", "_b", "_lo", "_hi")
    found = _dealt(tiles).applyInArrow(search, schema)

    cond = ["uid_l < uid_r", *_agreeing(rules, within)]
    return small.unionByName(found.where(" AND ".join(cond)).select(*small.columns))


def large_between(left: DataFrame, right: DataFrame, dense_block: int | None = None) -> DataFrame:
    """``(rule, key, _nl, _nr)`` of the blocks of two stacks (:func:`block_sizes`) with as many pairs as a block of over ``dense_block`` records, none with a long value."""
    dense_block = DENSE_BLOCK if dense_block is None else dense_block
    both = left.withColumnsRenamed({"_n": "_nl", "_long": "_ll"}).join(right.withColumnsRenamed({"_n": "_nr", "_long": "_lr"}), ["rule", "key"])
    return both.where(f"_nl * _nr > {pairs_of(dense_block)} AND greatest(_ll, _lr) <= {LONG_VALUE}").select("rule", "key", "_nl", "_nr")


def pairs_of(records: int) -> int:
    return records * (records - 1) // 2


def block_sizes(stacked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(rule, key, _n, _long)``: records and longest value of the blocks of several records (one record has but as many pairs as the other relation)."""
    return stacked.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("_n"), F.max(_longest(columns)).alias("_long")).where("_n > 1")


def reachable_between(
    left: DataFrame, right: DataFrame, large: DataFrame, rules: Rules, model: Model, threshold: float, *, within: Sequence[str] = (),
    unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT,
) -> DataFrame:
    """Pairs of two stacks in the ``large`` blocks (:func:`large_between`) that may reach the threshold, each under its first rule: ids and ``<c>_l``, ``<c>_r``."""
    rules, within = as_rules(rules), list(within)
    needed = list(dict.fromkeys([*rule_columns(rules, within), *model.columns]))
    plans, encode = _plans(rules, within, model, threshold), unit == "byte"
    split = block_split or DEFAULT_BLOCK_SPLIT

    def search(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = key[0].as_py()
        start, limit, open_ = plans[rule]
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        table = table.take(pc.sort_indices(table, sort_keys=[("_b", "ascending")])).combine_chunks()  # the left ones first
        columns = {b.column: _Values(table.column(b.column).to_pylist(), encode) for b in open_}
        sides = [table.column(c).combine_chunks() for c in needed]
        ids = [table.column(c).combine_chunks() for c in ("uid_l", "uid_r")]
        names = ["uid_l", "uid_r", "rule", *[f"{c}_{s}" for c in needed for s in ("l", "r")]]
        for p, r in _reach(columns, open_, start, limit, table.column("_b").to_numpy(), 0, 1):
            for at in range(0, len(p), _EMIT):
                i, j = pa.array(p[at : at + _EMIT]), pa.array(r[at : at + _EMIT])
                out = [ids[0].take(i), ids[1].take(j), pa.array(np.full(len(i), rule, np.int32))]
                yield pa.RecordBatch.from_arrays([*out, *[s.take(k) for s in sides for k in (i, j)]], names)

    kinds = {"uid_l": left.schema["uid"].dataType, "uid_r": right.schema["uid"].dataType}
    text = {f.name: f.dataType for f in left.schema.fields}
    schema = T.StructType(
        [*[T.StructField(c, k) for c, k in kinds.items()], T.StructField("rule", T.IntegerType())]
        + [T.StructField(f"{c}_{s}", text[c]) for c in needed for s in ("l", "r")]
    )

    def tiled(side: DataFrame, mine: str, other: str, b: int) -> DataFrame:
        """Records of one side, dealt into its buckets, one row for each bucket of the other side."""
        own, theirs = (f"CAST(least(ceil({n} / {split}), greatest({MAX_BUCKETS}, ceil({n} / {DEFAULT_BLOCK_SPLIT}))) AS INT)" for n in (mine, other))
        rows = side.join(large, ["rule", "key"]).withColumn("_x", F.expr(f"CAST(pmod(xxhash64(uid), {own}) AS INT)")).withColumn("_y", F.explode(F.expr(f"sequence(0, {theirs} - 1)")))
        uid = [F.col("uid").alias(c) if k == b else F.lit(None).cast(kinds[c]).alias(c) for k, c in enumerate(kinds)]
        return rows.select(*uid, *[q(c) for c in needed], "rule", "key", F.lit(b).alias("_b"), F.col("_y" if b else "_x").alias("_lo"), F.col("_x" if b else "_y").alias("_hi"))

    found = _dealt(tiled(left, "_nl", "_nr", 0).unionByName(tiled(right, "_nr", "_nl", 1))).applyInArrow(search, schema)
    return found.where(" AND ".join(_agreeing(rules, within))).select("uid_l", "uid_r", *[q(f"{c}_{s}") for c in model.columns for s in ("l", "r")])


# --- levels -----------------------------------------------------------


def _edit_distances(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, k: int) -> np.ndarray:
    """Edit distances up to ``k`` of the rows of two padded matrices (the paddings differ), else k + 1, along the 2 k + 1 middle diagonals."""
    n, far = len(la), k + 1
    out = np.full(n, far, np.int16)
    near = np.abs(la - lb) <= k
    padded = np.full((n, a.shape[1] + 2 * k + 1), -3, np.int64)
    padded[:, k : k + b.shape[1]] = b[:, : a.shape[1] + k + 1]
    row = [np.full(n, d if d >= 0 else far, np.int16) for d in range(-k, k + 1)]
    for i in range(a.shape[1] + 1):
        if i:
            new: list[np.ndarray] = []
            for d in range(2 * k + 1):
                j = i + d - k
                if j < 0:
                    new.append(np.full(n, far, np.int16))
                    continue
                best = np.full(n, i, np.int16) if j == 0 else row[d] + (a[:, i - 1] != padded[:, i - 1 + d])
                if d < 2 * k:
                    best = np.minimum(best, row[d + 1] + 1)
                if d and j > 0:
                    best = np.minimum(best, new[d - 1] + 1)
                new.append(np.minimum(best, far).astype(np.int16))
            row = new
        done = np.flatnonzero((la == i) & near)
        if len(done):
            out[done] = np.stack([r[done] for r in row])[(lb - la)[done] + k, np.arange(len(done))]
    return out


@dataclass(frozen=True)
class Bands:
    """What a task needs of a comparison: plain values, as its worker may not have the package."""

    column: str
    kind: str
    exact_level: int
    n_levels: int
    names: tuple[tuple[float, int], ...]  # Jaro-Winkler bands
    edits: tuple[int, tuple[int, ...]]  # widest distance and the level of each
    widest: float  # the measure that any level above the lowest needs


def bands_of(comp: Comparison) -> Bands:
    bound, table = edit_band_table(comp) if comp.kind != "name" else (0, [])
    names = tuple(comp.band_levels()) if comp.kind == "name" else ()
    return Bands(comp.column, comp.kind, comp.exact_level, comp.n_levels, names, (bound, tuple(table)), min(own for own, _, _ in _steps(comp)))


def _hopeful(v: _Values, comp: Bands, p: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Whether pairs may be above the lowest level, by the symbols of the left value that the right one has too, no further away than a match may be."""
    la, lb = v.size[p], v.size[r]
    longest = np.maximum(la, lb)
    wide = int(longest.max(initial=0))
    reach = np.maximum(longest // 2 - 1, 0) if comp.kind == "name" else np.full(len(p), comp.edits[0])
    most, least = int(reach.max(initial=0)), int(reach.min(initial=wide))
    a, b = (v.across[:wide].take(side, axis=1) for side in (p, r))
    hits = np.zeros(len(p), np.int16)
    for i in range(wide):
        hit = np.zeros(len(p), bool)
        for j in range(max(0, i - most), min(wide, i + most + 1)):
            same = a[i] == b[j]
            if abs(i - j) > least:
                same &= reach >= abs(i - j)
            hit |= same
        hits += hit & (la > i)
    if comp.kind == "name":
        with np.errstate(all="ignore"):
            return (la == 0) | (lb == 0) | (hits / la + hits / lb >= comp.widest)
    return hits - longest >= comp.widest


def _tails(v: _Values, p: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Number of symbols at the end that pairs of values have in common."""
    least = np.minimum(v.size[p], v.size[r])
    a, b = v.start[p] + v.size[p] - 1, v.start[r] + v.size[r] - 1
    out = np.zeros(len(p), np.int64)
    at = np.flatnonzero(least > 0)
    while len(at):
        at = at[v.flat[a[at] - out[at]] == v.flat[b[at] - out[at]]]
        out[at] += 1
        at = at[out[at] < least[at]]
    return out


def _exact_levels(v: _Values, comp: Bands, p: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Levels of pairs of set values, as ``level_sql`` gives them."""
    out = np.zeros(len(p), np.int8)
    longest = np.maximum(v.size[p], v.size[r])
    order = np.argsort(longest, kind="stable")
    s = 0
    while s < len(order):
        limit = max(2 * int(longest[order[s]]), 8)
        e = max(s + 1, min(int(np.searchsorted(longest[order], limit, "right")), s + max(1, _CELLS // limit)))
        at, s = order[s:e], e
        at = at[_hopeful(v, comp, p[at], r[at])]
        if not len(at):
            continue
        la, lb = v.size[p[at]], v.size[r[at]]
        if comp.kind != "name":  # an equal end changes no edit distance
            tail = _tails(v, p[at], r[at])
            la, lb = la - tail, lb - tail
        a, b = _padded(v.flat, v.start[p[at]], la, -1), _padded(v.flat, v.start[r[at]], lb, -2)
        wide = min(a.shape[1], b.shape[1])
        equal = (la == lb) & ((a[:, :wide] == b[:, :wide]) | (np.arange(wide) >= la[:, None])).all(axis=1)
        if comp.kind == "name":
            with np.errstate(all="ignore"):
                jw = np.round(np.where((la > 0) & (lb > 0), _scores(a, la, b, lb), 0.0), JW_ROUND_DIGITS)
            level = np.zeros(len(at), np.int8)
            for t, lvl in reversed(comp.names):
                level[jw >= t] = lvl
        else:
            bound, table = comp.edits
            level = np.array([*table[1:], 0], np.int8)[_edit_distances(a, la, b, lb, bound)]
        level[equal] = comp.exact_level
        out[at] = level
    return out


def _tile_levels(v: _Values, comp: Bands, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Of a mask's pairs of two runs of records: flat places and levels of those that may be above the lowest, and where a value is not set (None: nowhere)."""
    may = v.measure(comp.kind, x, y) >= comp.widest
    if v.empty.any():
        may |= v.empty[x][:, None] & v.empty[y][None, :]
    may &= mask
    null = None
    if v.null.any():
        null = v.null[x][:, None] | v.null[y][None, :]
        may &= ~null
    at = np.flatnonzero(may)
    i, j = np.divmod(at, len(y))
    return at, _exact_levels(v, comp, x[i], y[j]), null


def _packed(sizes: Sequence[int]) -> list[tuple[int, int, int]]:
    """For columns of so many levels: the number that holds the level and one more, its first bit there, and its mask (15 bits a number, the very first one left free)."""
    out: list[tuple[int, int, int]] = []
    number, bit = 0, 1
    for n in sizes:
        wide = n.bit_length()
        if bit + wide > 15 and bit:
            number, bit = number + 1, 0
        out.append((number, bit, (1 << wide) - 1))
        bit += wide
    return out


def _alike(values: pa.Array) -> np.ndarray:
    """Numbers of the values, equal for equal ones; -1 for NULL."""
    return pc.fill_null(values.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)


def pair_levels(
    slim: DataFrame, rules: Rules, model: Model, *, id_col: str = "uid", within: Sequence[str] = (), columns: Sequence[str] | None = None,
    unit: str = "byte", block_split: int | None = DEFAULT_BLOCK_SPLIT, maxima: Sequence[int], dense_block: int | None = None,
) -> DataFrame:
    """``(uid_l, uid_r, rule, <c>_level...)`` of every pair of ``candidate_pairs``, for all of the model's columns or the named ones."""
    rules, within = as_rules(rules), list(within)
    few = replace(model, comparisons=tuple(c for c in model.comparisons if columns is None or c.column in columns))
    comps = [bands_of(c) for c in few.comparisons]
    dense_block = DENSE_BLOCK if dense_block is None else dense_block
    carry = [c.column for c in comps]
    wanted = ["uid_l", "uid_r", "rule", *[level_col(c) for c in carry]]
    if max(maxima or [0]) <= dense_block:
        pairs = candidate_pairs(slim, rules, id_col=id_col, within=within, carry=carry, block_split=block_split, maxima=maxima)
        return compare_pairs(pairs, few, unit=unit).select(*[q(c) for c in wanted])
    needed = list(dict.fromkeys([*rule_columns(rules, within), *carry]))
    stacked = stack_rules(slim, rules, id_col=id_col, within=within, carry=needed)
    large = _large(stacked, needed, dense_block)
    salt = block_split if max(maxima) > (block_split or 0) else None
    small = compare_pairs(joined_pairs(stacked.join(large, ["rule", "key"], "left_anti"), rules, within, carry, salt), few, unit=unit)
    keyed, encode = rule_columns(rules, within), unit == "byte"
    places = _packed([c.n_levels for c in comps])
    numbers = places[-1][0] + 1 if places else 1
    lowest = [sum(1 << bit for at, bit, _ in places if at == k) for k in range(numbers)]

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, lo, hi = key[0].as_py(), key[2].as_py(), key[3].as_py()
        own = list(dict.fromkeys([*rules[rule], *within]))
        table = _whole(batches)
        alike = {c: _alike(table.column(c).combine_chunks()) for c in keyed}
        told = [alike[c] for c in own if (alike[c] != alike[c][0]).any()]  # values whose hashes collide
        values = {c.column: _Values(table.column(c.column).to_pylist(), encode) for c in comps if c.column not in own}
        uid = table.column("uid").combine_chunks()
        ids = _alike(uid)
        repeated = len(np.unique(ids)) < len(ids) or (ids < 0).any()
        for x, y, keep in _tile_pairs(table.column("_b").to_numpy(), lo, hi):
            if keep is None:
                keep = np.ones((len(x), len(y)), bool)
            if repeated:
                keep &= (ids[x][:, None] != ids[y][None, :]) & (ids[x][:, None] >= 0) & (ids[y][None, :] >= 0)
            for v in told:
                keep &= v[x][:, None] == v[y][None, :]
            for early in rules[:rule]:
                agree = np.ones(keep.shape, bool)
                for v in (alike[c] for c in dict.fromkeys([*early, *within])):
                    agree &= np.where(v[x] < 0, -2, v[x])[:, None] == v[y][None, :]
                keep &= ~agree
            codes = [np.full(keep.shape, n, np.int16) for n in lowest]
            for c, (k, bit, _) in zip(comps, places):
                if c.column in values:
                    at, level, null = _tile_levels(values[c.column], c, x, y, keep)
                    codes[k].ravel()[at] += level.astype(np.int16) << bit
                    if null is not None:
                        codes[k][null] += np.int16(NULL_LEVEL << bit)
                else:
                    codes[k] += np.int16(c.exact_level << bit)
            codes[0] |= x[:, None] < y[None, :]  # the record is the left one
            # every record with the others of the run, which beyond its meeting with itself are mostly all of them
            cuts = [0, len(x), len(y)] if x[0] == y[0] else [0, len(y)]
            for start, end in zip(cuts, cuts[1:]):
                theirs = uid.take(pa.array(y[start:end]))
                step = max(1, _EMIT // max(1, end - start))
                for s in range(0, len(x), step):
                    part = keep[s : s + step, start:end]
                    cells = [n[s : s + step, start:end] for n in codes]
                    count = part.sum(axis=1)
                    rows = np.flatnonzero(count)
                    if not len(rows):
                        continue
                    if part.all():
                        others, cells = pa.concat_arrays([theirs] * len(part)), [n.ravel() for n in cells]
                    else:
                        others, cells = theirs.take(pa.array(np.broadcast_to(np.arange(end - start), part.shape)[part])), [n[part] for n in cells]
                    ends = pa.array(np.concatenate([[0], np.cumsum(count[rows])]).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(ends, v, type=pa.list_(pa.field("element", v.type, nullable=False))) for v in (others, *map(pa.array, cells))]
                    yield pa.RecordBatch.from_arrays([uid.take(pa.array(x[s + rows])), pa.array(np.full(len(rows), rule, np.int32)), *lists], names)

    kind = stacked.schema["uid"].dataType
    names = ["_one", "rule", "_others", *[f"_codes{k}" for k in range(numbers)]]
    schema = T.StructType(
        [T.StructField("_one", kind), T.StructField("rule", T.IntegerType()), T.StructField("_others", T.ArrayType(kind, False))]
        + [T.StructField(f"_codes{k}", T.ArrayType(T.ShortType(), False)) for k in range(numbers)]
    )
    tiles = tiles_of(stacked.join(large, ["rule", "key"]), block_split or DEFAULT_BLOCK_SPLIT).select("uid", *[q(c) for c in needed], "rule", "key", "_b", "_lo", "_hi")
    # pairs of small blocks as lists of one: the explosion after the union is then one step with what reads the pairs
    held = [" | ".join(["1" if k == 0 else "0", *[f"shiftleft({q(level_col(c))} + 1, {bit})" for c, (at, bit, _) in zip(carry, places) if at == k]]) for k in range(numbers)]
    single = small.selectExpr("uid_l AS _one", "rule", "array(uid_r) AS _others", *[f"array(CAST({v} AS SMALLINT)) AS _codes{k}" for k, v in enumerate(held)])
    every = single.unionByName(_dealt(tiles).applyInArrow(compare, schema)).selectExpr("*", "posexplode(_others) AS (_at, _other)")
    levels = [f"(shiftright(CAST(get(_codes{k}, _at) AS INT), {bit}) & {mask}) - 1 AS {q(level_col(c))}" for c, (k, bit, mask) in zip(carry, places)]
    left = "get(_codes0, _at) % 2 = 1"
    return every.selectExpr(f"IF({left}, _one, _other) AS uid_l", f"IF({left}, _other, _one) AS uid_r", "rule", *levels)


def level_counts(
    slim: DataFrame, blocked: str, model: Model, *, id_col: str, weight: str, unit: str = "byte",
    block_split: int | None = DEFAULT_BLOCK_SPLIT, dense_block: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(<c>_level..., w)`` of the model's columns over all pairs of the large blocks of one column, counted by weight, and the records of the other blocks."""
    others = model.columns
    dense_block = DENSE_BLOCK if dense_block is None else dense_block
    needed = list(dict.fromkeys([blocked, *others, weight]))
    # NULLs make no block; the values themselves are the key, so that no other value falls into it
    stacked = slim.where(f"{q(blocked)} IS NOT NULL").selectExpr(f"{q(id_col)} AS uid", *[q(c) for c in needed], "0 AS rule", f"{q(blocked)} AS key")
    large = _large(stacked, [blocked, *others], dense_block)
    small = slim.join(large.selectExpr(f"key AS {q(blocked)}"), blocked, "left_anti")
    comps = [bands_of(c) for c in model.comparisons]
    base = [c.n_levels + 1 for c in comps]
    size, encode = math.prod(base), unit == "byte"

    def count(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = key[2].as_py(), key[3].as_py()
        table = _whole(batches)
        columns = {c.column: _Values(table.column(c.column).to_pylist(), encode) for c in comps}
        w, b = table.column(weight).to_numpy().astype(np.int64), table.column("_b").to_numpy()
        sums = np.zeros(size, np.int64)
        for x, y, mask in _tile_pairs(b, lo, hi):
            code = np.zeros((len(x), len(y)), np.int64)
            for c, wide in zip(comps, base):
                v = columns[c.column]
                may = v.measure(c.kind, x, y) >= c.widest
                if v.empty.any():
                    may |= v.empty[x][:, None] & v.empty[y][None, :]
                null = v.null[x][:, None] | v.null[y][None, :]
                may &= ~null
                if mask is not None:
                    may &= mask
                level = np.where(null, np.int8(0), np.int8(1))  # a level and one more
                i, j = np.nonzero(may)
                if len(i):
                    level[i, j] = _exact_levels(v, c, x[i], y[j]) + 1
                code *= wide
                code += level
            weights = w[x][:, None] * w[y][None, :]
            if mask is not None:
                code, weights = code[mask], weights[mask]
            # few patterns: sums of whole numbers, pattern by pattern
            code, weights = code.ravel(), weights.ravel()
            if (weights == 1).all():
                sums += np.bincount(code, minlength=size)
            else:
                np.add.at(sums, code, weights)
        found = np.flatnonzero(sums)
        places = np.unravel_index(found, base)
        yield pa.RecordBatch.from_arrays([*[pa.array((p - 1).astype(np.int32)) for p in places], pa.array(sums[found])], [*[f"{c}_level" for c in others], "w"])

    schema = T.StructType([*[T.StructField(f"{c}_level", T.IntegerType()) for c in others], T.StructField("w", T.LongType())])
    tiles = tiles_of(stacked.join(large, ["rule", "key"]), block_split or DEFAULT_BLOCK_SPLIT).select("uid", *[q(c) for c in dict.fromkeys([*others, weight])], "rule", "key", "_b", "_lo", "_hi")
    return _dealt(tiles).applyInArrow(count, schema), small
