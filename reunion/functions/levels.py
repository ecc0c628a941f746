"""Agreement levels and Fellegi-Sunter probabilities as native Spark SQL expressions.

Expressions are generated as SQL text (one ``selectExpr`` per projection rather than one
JVM call per operator), and each reads its inputs once: distances and levels are mapped
through constant-array lookups instead of CASE chains. Catalyst pushes the link filter
into the join condition and inlines the level expressions there; single references keep
that inlined code small and every string distance computed once per pair.
"""

from __future__ import annotations

import itertools

from ..constants import JW_BOOST_THRESHOLD, JW_PREFIX_MAX, JW_PREFIX_SCALE, JW_ROUND_DIGITS, NULL_LEVEL
from ..model import Comparison, Model
from .similarity import check_unit

# Entries of a tabulated product of factors; longer products are looked up in several tables.
TABLE_ENTRIES = 4096


def q(name: str) -> str:
    """A whole column name as a quoted Spark SQL identifier (dots and back-ticks are part of the name)."""
    return "`" + name.replace("`", "``") + "`"


def sql_double(x: float) -> str:
    """Spark SQL literal that parses to exactly ``x`` (Java's parser rounds correctly)."""
    return f"{float(x)!r}D"


def sql_array(values: list, dtype: str) -> str:
    items = [sql_double(v) if dtype == "double" else str(int(v)) for v in values]
    return f"array({', '.join(items)})"


def unit_sql(expr: str, unit: str) -> str:
    """Make Spark's character-based string functions see one character per UTF-8 byte."""
    if check_unit(unit) == "byte":
        return f"decode(encode({expr}, 'UTF-8'), 'ISO-8859-1')"
    return expr


def edit_band_table(comp: Comparison) -> tuple[int, list[int]]:
    """Bound of the distance and level by bounded distance -1 (beyond the bound), 0, 1, ..., bound."""
    bound = int(max(comp.thresholds)) if comp.thresholds else 0
    table = []
    for d in range(-1, bound + 1):
        level = 0
        if d >= 0:
            for threshold, lvl in comp.band_levels():
                if d <= threshold:
                    level = lvl
                    break
        table.append(level)
    return bound, table


def _furthest_sql(k: int) -> str:
    """Edit distance of ``z.l`` and ``z.r`` (``z.n``, ``z.m`` long) up to ``k``, else -1, by the furthest-reaching points.

    A diagonal d holds the places i of the left and i + d of the right value. With e edits the furthest i on each diagonal
    follows from those with e - 1; equal text behind it costs nothing and is passed in steps of halving size. So the work is some
    k * k comparisons of text, where a table of distances has a cell per pair of characters.
    """
    none = -(1 << 30)

    def passed(i: str, d: str) -> str:
        there = f"a >= 0 AND a + w <= z.n AND a + ({d}) + w <= z.m"
        return f"aggregate(z.steps, CAST({i} AS INT), (a, w) -> IF({there} AND substr(z.l, a + 1, w) = substr(z.r, a + ({d}) + 1, w), a + w, a))"

    every = f"sequence(0, {2 * k})"
    start = f"transform({every}, x -> IF(x = {k}, {passed('0', '0')}, {none}))"
    best = f"greatest(element_at(s.f, x + 1) + 1, IF(x > 0, element_at(s.f, greatest(x, 1)), {none}), IF(x < {2 * k}, element_at(s.f, least(x + 2, {2 * k + 1})) + 1, {none}))"
    following = f"transform({every}, x -> {passed(f'least({best}, z.n, z.m - x + {k})', f'x - {k}')})"

    def state(f: str, edits: str) -> str:
        return f"element_at(transform(array({f}), g -> named_struct('f', g, 'd', IF(element_at(g, z.m - z.n + {k + 1}) >= z.n, {edits}, -1))), 1)"

    rounds = f"aggregate(sequence(1, {k}), {state(start, '0')}, (s, e) -> IF(s.d >= 0, s, {state(following, 'e')}), s -> s.d)" if k else f"{state(start, '0')}.d"
    return f"IF(abs(z.n - z.m) > {k}, -1, {rounds})"


#: Values of more characters are compared along diagonals, not cell by cell.
LONG_VALUE = 256


def distance_sql(left: str, right: str, k: int, unit: str = "byte") -> str:
    """Edit distance of two values up to ``k``, else -1 (SQL text); long values cost about their length, not its square."""
    a, b = unit_sql(left, unit), unit_sql(right, unit)
    steps = "transform(reverse(sequence(0, CAST(floor(log2(greatest(y.n, y.m, 1))) AS INT))), b -> shiftleft(1, b))"
    sized = f"transform(array(named_struct('l', {a}, 'r', {b})), v -> named_struct('l', v.l, 'r', v.r, 'n', length(v.l), 'm', length(v.r)))"
    stepped = f"transform({sized}, y -> named_struct('l', y.l, 'r', y.r, 'n', y.n, 'm', y.m, 'steps', {steps}))"
    long = f"element_at(transform({stepped}, z -> {_furthest_sql(k)}), 1)"
    return f"(CASE WHEN greatest(length({left}), length({right})) <= {LONG_VALUE} THEN levenshtein({a}, {b}, {k}) WHEN {left} IS NULL OR {right} IS NULL THEN NULL ELSE {long} END)"


def level_sql(comp: Comparison, left: str, right: str, unit: str = "byte", jw_function: str | None = None) -> str:
    """Agreement level: -1 NULL, exact = n-1, fuzzy bands, 0 otherwise (SQL text).

    ``left``/``right`` are SQL expressions. Equality is decided before any similarity is
    computed; Levenshtein is bounded by the widest band, so long strings stop early.
    """
    head = f"CASE WHEN {left} IS NULL OR {right} IS NULL THEN {NULL_LEVEL} WHEN {left} = {right} THEN {comp.exact_level}"
    if comp.kind == "name":
        if jw_function is None:
            raise ValueError("a name comparison needs the registered Jaro-Winkler function")
        # equal pairs go in as NULL, so the UDF scores differing values only
        jw = f"round({jw_function}(nullif({left}, {right}), {right}), {JW_ROUND_DIGITS})"
        bands = " ".join(f"WHEN {jw} >= {sql_double(t)} THEN {lvl}" for t, lvl in comp.band_levels())
        return f"CAST({head} {bands} ELSE 0 END AS INT)"
    bound, table = edit_band_table(comp)
    dist = distance_sql(left, right, bound, unit)
    return f"CAST({head} ELSE element_at({sql_array(table, 'int')}, {dist} + 2) END AS INT)"


def jw_bound_sql(left: str, right: str) -> str:
    """An upper bound of the Jaro-Winkler similarity of two differing, set values (SQL text), without any matching.

    Matched symbols occur on both sides, so their number is at most that of either side's
    symbols found on the other; no transposition and the actual common prefix bound the rest.
    """
    shared = f"least(length({left}) - length(translate({left}, {right}, '')), length({right}) - length(translate({right}, {left}, '')))"
    jaro = f"(CASE WHEN m = 0 THEN 0D ELSE (m / length({left}) + m / length({right}) + 1D) / 3D END)"
    prefix = "0"
    for k in range(JW_PREFIX_MAX, 0, -1):
        here = f"length({left}) >= {k} AND substr({left}, {k}, 1) = substr({right}, {k}, 1)"
        prefix = f"CASE WHEN {here} THEN 1 + ({prefix}) ELSE 0 END"
    boosted = f"transform(transform(array({shared}), m -> {jaro}), j -> CASE WHEN j > {JW_BOOST_THRESHOLD - 1e-9}D THEN j + ({prefix}) * {JW_PREFIX_SCALE}D * (1D - j) ELSE j END)"
    return f"element_at({boosted}, 1)"


def factor_sql(comp: Comparison, level: str) -> str:
    """Bayes factor m/u of a level (SQL); 1.0 for the NULL level."""
    return f"element_at({sql_array([1.0, *comp.factors], 'double')}, {level} + 2)"


def odds_sql(model: Model, levels: list[str]) -> str:
    """Posterior odds: prior odds times every column's factor, multiplied in column order."""
    odds = sql_double(model.prior_odds)
    for comp, lvl in zip(model.comparisons, levels):
        odds = f"({odds} * {factor_sql(comp, lvl)})"
    return odds


def _tables(model: Model) -> list[list[Comparison]]:
    """The comparisons in order, cut into runs whose level patterns fit one table each."""
    runs: list[list[Comparison]] = []
    size = 0
    for c in model.comparisons:
        if runs and size * (c.n_levels + 1) <= TABLE_ENTRIES:
            runs[-1].append(c)
            size *= c.n_levels + 1
        else:
            runs.append([c])
            size = c.n_levels + 1
    return runs


def _products(comps: list[Comparison], start: float) -> list[float]:
    """Product of the factors of every level pattern, multiplied in column order from ``start``.

    Index = mixed radix over (level + 1), first column most significant.
    """
    out = []
    for pattern in itertools.product(*[[NULL_LEVEL, *range(c.n_levels)] for c in comps]):
        odds = start
        for comp, lvl in zip(comps, pattern):
            odds = odds * (1.0 if lvl == NULL_LEVEL else comp.factors[lvl])
        out.append(odds)
    return out


def match_probability_sql(model: Model, levels: list[str], digits: int | None = None) -> str:
    """Pair probability from level expressions, rounded if digits are given; reads every level once.

    The first table holds prior odds times factors, further ones products of factors. With one
    table it holds the probabilities themselves; with several, the odds are computed once, over a one-element array,
    and odds beyond a double's range give 1.
    """
    runs, at, parts = _tables(model), 0, []
    for k, comps in enumerate(runs):
        idx = "0"
        for comp, lvl in zip(comps, levels[at : at + len(comps)]):
            idx = f"({idx} * {comp.n_levels + 1} + ({lvl} + 1))"
        at += len(comps)
        values = _products(comps, float(model.prior_odds) if k == 0 else 1.0)
        if len(runs) == 1:
            values = [1.0 if o == float("inf") else o / (1.0 + o) for o in values]
            if digits is not None:  # Spark rounds the constants once, not every pair
                rounded = ", ".join(f"round({sql_double(v)}, {digits})" for v in values)
                return f"element_at(array({rounded}), {idx} + 1)"
        parts.append(f"element_at({sql_array(values, 'double')}, {idx} + 1)")
    if len(parts) == 1:
        return parts[0]
    prob = f"element_at(transform(array({' * '.join(parts)}), o -> CASE WHEN o = double('Infinity') THEN 1.0D ELSE o / (1.0D + o) END), 1)"
    return prob if digits is None else f"round({prob}, {digits})"
