"""Candidates within k edits: every pair that brute force finds, once, also from tiles, and through resolve."""

from __future__ import annotations

import random

import pytest

from reunion import Model, resolve
from reunion.functions import levels
from reunion.errors import MatchError
from reunion.model import Comparison
from reunion.operators.near import near_pairs, near_value_pairs
from reunion.plans.score import score_records


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng: random.Random, text: str, edits: int, letters: str) -> str:
    for _ in range(edits):
        k = rng.randrange(len(text) + 1)
        text = rng.choice([text[:k] + rng.choice(letters) + text[k:], text[:k] + text[k + 1 :], text[:k] + rng.choice(letters) + text[k + 1 :]])
    return text


def values(seed: int, letters: str, size: int) -> list[str | None]:
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(size))) for _ in range(25)]
    out = [edited(rng, rng.choice(base), rng.randrange(5), letters) for _ in range(150)]
    return [*base, *out, *out[:20], "", "", None, None, "a", "ab"]


def brute(vals, k, measure=lambda v: v):
    first: dict[str, int] = {}
    for i, v in enumerate(vals):
        if v is not None:
            first.setdefault(v, i)
    out = []
    for v, i in first.items():
        for w, j in first.items():
            if i < j and (d := distance(measure(v), measure(w))) <= k:
                out.append((i, j, d))
    return sorted(out)


@pytest.mark.parametrize(("k", "letters", "size", "split"), [(0, "ab", 6, 5000), (1, "ab", 9, 5000), (2, "abc", 30, 5000), (3, "ab", 14, 5000), (2, "ab", 8, 3)])
def test_every_pair_once(spark, k, letters, size, split):
    vals = values(k * 7 + size, letters, size)
    df = spark.createDataFrame(list(enumerate(vals)), "uid long, t string").repartition(5)
    got = sorted(tuple(r) for r in near_value_pairs(df, "t", k, block_split=split).collect())
    assert got == brute(vals, k)
    assert k == 0 or len(got) > 50


@pytest.mark.parametrize("unit", ["char", "byte"])
def test_distance_along_diagonals(spark, monkeypatch, unit):
    """Every value taken as a long one gives what the table of distances gives."""
    monkeypatch.setattr(levels, "LONG_VALUE", 0)
    rng = random.Random(1)
    rows = [("", ""), ("", "ab"), ("abc", ""), (None, "a"), ("a", None)]
    for _ in range(1500):
        letters = rng.choice(["ab", "abé", "a"])
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14)))
        rows.append((a, edited(rng, a, rng.randrange(6), letters)))
    df = spark.createDataFrame(rows, "l string, r string").repartition(4)
    for k in (0, 1, 2, 3):
        plain = f"levenshtein({levels.unit_sql('l', unit)}, {levels.unit_sql('r', unit)}, {k})"
        got = df.selectExpr("l", "r", f"{levels.distance_sql('l', 'r', k, unit)} AS d", f"{plain} AS want")
        assert got.where("NOT (d <=> want)").collect() == []


def test_long_values(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abc déf") for _ in range(30_000))
    vals = [text, *(edited(rng, text, k, "xy") for k in (1, 2, 2, 3, 6))]
    df = spark.createDataFrame(list(enumerate(vals)), "uid long, t string")
    got = {(r["a"], r["b"]): r["distance"] for r in near_value_pairs(df, "t", 2, unit="char").collect()}
    assert got[0, 1] == 1 and got[0, 2] == 2 and got[0, 3] == 2 and (0, 5) not in got


def test_units(spark):
    vals = values(3, "aé日", 12)
    df = spark.createDataFrame(list(enumerate(vals)), "uid long, t string")
    for unit, measure in (("char", lambda v: v), ("byte", lambda v: v.encode().decode("latin-1"))):
        assert sorted(tuple(r) for r in near_value_pairs(df, "t", 2, unit=unit).collect()) == brute(vals, 2, measure)


def test_a_shared_passage_is_tiled(spark):
    """Values of one length that share two of three segments: one hot key each, in tiles of 4."""
    vals = ["x" * 40 + f"{i:020d}" for i in range(0, 3000, 50)]
    df = spark.createDataFrame(list(enumerate(vals)), "uid long, t string")
    assert sorted(tuple(r) for r in near_value_pairs(df, "t", 2, block_split=4).collect()) == brute(vals, 2)


def test_no_values(spark):
    df = spark.createDataFrame([(1, None)], "uid long, t string")
    assert near_value_pairs(df, "t", 2).collect() == []
    with pytest.raises(ValueError, match="negative"):
        near_value_pairs(df, "t", -1)


def test_rules_do_not_repeat_pairs(spark):
    rng = random.Random(5)
    rows = [(i, edited(rng, rng.choice(["kitten", "sitting", "mitten"]), rng.randrange(3), "abit"), rng.choice(["x", "y", None]), rng.choice(["stone", "stony", None])) for i in range(80)]
    df = spark.createDataFrame(rows, "uid long, name string, `a b` string, place string")
    near = [("name", 1), ("place", 1)]
    got = [(r["uid_l"], r["uid_r"], r["rule"]) for part in near_pairs(df, near, [("a b",)], carry=["name"], within=[]) for r in part.collect()]
    want = set()
    for i, n1, b1, p1 in rows:
        for j, n2, b2, p2 in rows:
            if i < j and not (b1 is not None and b1 == b2):
                if distance(n1, n2) <= 1:
                    want.add((i, j, 1))
                elif p1 is not None and p2 is not None and distance(p1, p2) <= 1:
                    want.add((i, j, 2))
    assert len(got) == len(set(got)) and set(got) == want and {r for *_, r in got} == {1, 2}


def test_resolve_by_near_values(spark):
    """Inserted and deleted characters link; the model keeps the rule through JSON and a table."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        text = "".join(rng.choice("abcdefgh ") for _ in range(60))
        rows += [(i * 3, text, i), (i * 3 + 1, edited(rng, text, 1, "abc"), i), (i * 3 + 2, edited(rng, text, 2, "abc"), i)]
    df = spark.createDataFrame(rows, "id long, text string, truth int")
    model = Model(0.01, (Comparison("text", "edit", (1.0, 2.0), (0.01, 0.04, 0.05, 0.9), (0.99, 0.004, 0.004, 0.002)),), near=(("text", 2),))
    model = Model(model.prior, model.comparisons, blocking=(("text",),), near=model.near)
    assert Model.from_json(model.to_json()) == model and Model.from_dataframe(model.to_dataframe(spark)) == model
    out = resolve(df, model=model, id_col="id", threshold=0.05).collect()
    clusters = {}
    for r in out:
        clusters.setdefault(r["cluster_id"], set()).add(r["truth"])
    assert all(len(c) == 1 for c in clusters.values())
    linked = {}
    for i, a, t in rows:
        linked.setdefault(t, set())
        if all(distance(a, b) > 2 for j, b, u in rows if u == t and j != i):
            linked[t].add(i)
    assert sum(1 for _ in clusters) == sum(1 + len(alone) if len(alone) < 3 else 3 for alone in linked.values())
    with pytest.raises(MatchError, match="near"):
        score_records(df.selectExpr("id AS new", "text"), df, model, new_id="new", known_id="id")
