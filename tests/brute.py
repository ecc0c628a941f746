"""A brute-force resolver in plain Python for small inputs: all pairs, no blocking tricks."""

from __future__ import annotations

from reunion.constants import NULL_LEVEL
from reunion.functions.levels import edit_band_table
from reunion.functions.similarity import jaro_winkler
from reunion.model import Model


def _lev(a: bytes, b: bytes) -> int:
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def level(comp, a, b):
    if a is None or b is None:
        return NULL_LEVEL
    if a == b:
        return comp.exact_level
    if comp.kind == "name":
        jw = round(jaro_winkler(a.encode(), b.encode()), 12)
        for t, lvl in comp.band_levels():
            if jw >= t:
                return lvl
        return 0
    bound, table = edit_band_table(comp)
    d = _lev(a.encode(), b.encode())
    return table[d + 1] if d <= bound else 0


def resolve_brute(rows: list[dict], columns: list[str], id_col: str, threshold: float, model: Model | None = None):
    """{id: (cluster_id, match_probability)}."""
    model = model or Model.default(columns)
    ids = sorted(r[id_col] for r in rows)
    val = {r[id_col]: [None if r[c] is None else str(r[c]) for c in columns] for r in rows}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    best: dict = {}
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            va, vb = val[a], val[b]
            if not any(x is not None and x == y for x, y in zip(va, vb)):
                continue
            odds = model.prior_odds
            for comp, x, y in zip(model.comparisons, va, vb):
                lv = level(comp, x, y)
                odds = odds * (1.0 if lv == NULL_LEVEL else comp.factors[lv])
            p = odds / (1.0 + odds)
            if p >= threshold:
                ra, rb = find(a), find(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                best[a] = max(best.get(a, -1.0), p)
                best[b] = max(best.get(b, -1.0), p)
    roots = {i: find(i) for i in ids}
    order = {r: str(k) for k, r in enumerate(sorted(set(roots.values())))}
    return {i: (order[roots[i]], best.get(i, 1.0)) for i in ids}
