"""String similarity used by the comparisons.

Levenshtein is Spark's built-in ``levenshtein`` (JVM side, codegen). Spark has no
Jaro-Winkler, so it is an Arrow-batched pandas UDF that scores all pairs of a batch together,
position by position, in numpy matrices bucketed by length; pairs with a NULL side take no part.
Both measure UTF-8 bytes by default (``unit="byte"``), or characters (``unit="char"``).
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..constants import JW_BOOST_THRESHOLD, JW_PREFIX_MAX, JW_PREFIX_SCALE

UNITS = ("byte", "char")

# The UDFs below run in executor Python workers, which need not have this package installed:
# ship this module's code with the pickled functions instead of a reference to it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def check_unit(unit: str) -> str:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, got {unit!r}")
    return unit


def jaro_winkler(a: str | bytes, b: str | bytes) -> float:
    """Jaro-Winkler similarity of two sequences (str: characters, bytes: bytes).

    Matching window ``max(max(len)//2 - 1, 0)``, greedy left-to-right matching,
    transpositions = mismatched matched symbols // 2; an empty side gives 0.0; the
    prefix bonus (up to 4 symbols) is added only when Jaro exceeds 0.7.
    """
    la, lb = len(a), len(b)
    if la == 0 or lb == 0:
        return 0.0
    window = max(max(la, lb) // 2 - 1, 0)
    used = bytearray(lb)
    a_hits = []
    for i in range(la):
        ch = a[i]
        lo = i - window if i > window else 0
        hi = i + window + 1
        if hi > lb:
            hi = lb
        for j in range(lo, hi):
            if not used[j] and b[j] == ch:
                used[j] = 1
                a_hits.append(ch)
                break
    m = len(a_hits)
    if m == 0:
        return 0.0
    half_t = 0
    k = 0
    for j in range(lb):
        if used[j]:
            if b[j] != a_hits[k]:
                half_t += 1
            k += 1
    t = half_t // 2
    sim = (m / la + m / lb + (m - t) / m) / 3.0
    if sim > JW_BOOST_THRESHOLD:
        prefix = 0
        for x, y in zip(a[:JW_PREFIX_MAX], b[:JW_PREFIX_MAX]):
            if x != y:
                break
            prefix += 1
        sim = sim + prefix * JW_PREFIX_SCALE * (1.0 - sim)
    return sim


# Cells of one matrix of the batch scorer, which bounds its memory.
_CELLS = 1 << 22


def _codes(values: list, encode: bool) -> tuple[np.ndarray, np.ndarray]:
    """All symbols one after the other, and the length of each value."""
    if encode:
        raw = [v.encode("utf-8") for v in values]
        return np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))
    joined = "".join(values).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), np.fromiter(map(len, values), np.int64, len(values))


def _padded(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, fill: int) -> np.ndarray:
    width = max(int(sizes.max()), 1)
    out = np.full((len(sizes), width), fill, np.int64)
    inside = np.arange(width) < sizes[:, None]
    out[inside] = flat[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
    return out


def _scores(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """:func:`jaro_winkler` of the rows of two padded matrices (the paddings differ)."""
    n, width = b.shape
    rows, cols = np.arange(n), np.arange(width)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    used = np.zeros((n, width), bool)
    hit = np.zeros(a.shape, bool)
    for i in range(a.shape[1]):
        can = (b == a[:, i, None]) & ~used & (np.abs(cols - i) <= window)
        j = can.argmax(axis=1)  # the first that is free
        found = can[rows, j]
        used[rows[found], j[found]] = True
        hit[found, i] = True
    m = hit.sum(axis=1)
    # the matched symbols of both sides in order; the k-th of one meets the k-th of the other
    ra, ca = np.nonzero(hit)
    rb, cb = np.nonzero(used)
    half = np.bincount(ra, weights=a[ra, ca] != b[rb, cb], minlength=n).astype(np.int64)
    with np.errstate(all="ignore"):
        sim = (m / la + m / lb + (m - half // 2) / m) / 3.0
    sim = np.where(m > 0, sim, 0.0)
    k = min(JW_PREFIX_MAX, a.shape[1], width)
    prefix = np.cumprod(a[:, :k] == b[:, :k], axis=1).sum(axis=1) if k else np.zeros(n, np.int64)
    return np.where(sim > JW_BOOST_THRESHOLD, sim + prefix * JW_PREFIX_SCALE * (1.0 - sim), sim)


def batch_jaro_winkler(left: list, right: list, encode: bool) -> np.ndarray:
    """Jaro-Winkler of two lists of strings, NaN where a side is None."""
    out = np.full(len(left), np.nan)
    at = np.array([i for i, (x, y) in enumerate(zip(left, right)) if x is not None and y is not None], np.int64)
    if not len(at):
        return out
    (fa, la), (fb, lb) = (_codes([side[i] for i in at], encode) for side in (left, right))
    sa, sb = np.cumsum(la) - la, np.cumsum(lb) - lb
    longest = np.maximum(la, lb)
    order = np.argsort(longest, kind="stable")
    s = 0
    while s < len(order):
        # as many pairs as fit the cells, and none over twice as long as the shortest taken
        limit = max(2 * int(longest[order[s]]), 8)
        e = min(int(np.searchsorted(longest[order], limit, "right")), s + max(1, _CELLS // max(limit, 1)))
        e = max(e, s + 1)
        p = order[s:e]
        out[at[p]] = _scores(_padded(fa, sa[p], la[p], -1), la[p], _padded(fb, sb[p], lb[p], -2), lb[p])
        s = e
    return out


def _batch_scores(left: pd.Series, right: pd.Series, encode: bool) -> pd.Series:
    out = batch_jaro_winkler(left.tolist(), right.tolist(), encode)
    return pd.Series([None if np.isnan(x) else x for x in out.tolist()], dtype="float64")


@pandas_udf(T.DoubleType())
def _jw_bytes(left: pd.Series, right: pd.Series) -> pd.Series:
    return _batch_scores(left, right, True)


@pandas_udf(T.DoubleType())
def _jw_chars(left: pd.Series, right: pd.Series) -> pd.Series:
    return _batch_scores(left, right, False)


def jaro_winkler_udf(left: Column, right: Column, unit: str = "byte") -> Column:
    """Jaro-Winkler of two string columns; NULL if either side is NULL."""
    return (_jw_bytes if check_unit(unit) == "byte" else _jw_chars)(left, right)


JW_FUNCTIONS = {"byte": "reunion_jaro_winkler", "char": "reunion_jaro_winkler_chars"}
_registered: set[tuple[str, str]] = set()


def register_jaro_winkler(spark, unit: str = "byte") -> str:
    """Register the Jaro-Winkler UDF as a SQL function of this session; returns its name."""
    name = JW_FUNCTIONS[check_unit(unit)]
    key = (str(spark._jsparkSession.sessionUUID()), name)
    if key not in _registered:
        spark.udf.register(name, _jw_bytes if unit == "byte" else _jw_chars)
        _registered.add(key)
    return name
