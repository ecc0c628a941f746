"""Exact u of edit-distance columns against all pairs; proofs of byte and character units and of the result's order."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from reunion import Model, resolve
from reunion.model import Comparison
from reunion.operators.exact import exact_level_counts, exact_u
from reunion.operators.training import train_model

from tests.brute import _lev

EDIT = Comparison("v", "edit", (1.0, 2.0), (0.1, 0.1, 0.1, 0.7), (0.7, 0.1, 0.1, 0.1))


def level(a, b):
    d = 0 if a == b else min(_lev(a, b), 3)
    return 3 - d


def rows_of(spark):
    rng = random.Random(2)
    values = ["".join(rng.choice("abé") for _ in range(rng.randrange(0, 6))) for _ in range(60)] + ["hot"] * 30 + [None] * 5
    return values, spark.createDataFrame(list(enumerate(values)), "uid long, v string")


@pytest.mark.parametrize("unit", ["byte", "char"])
def test_counts_of_all_pairs(spark, unit):
    values, df = rows_of(spark)
    want = dict.fromkeys(range(4), 0)
    for a, b in combinations([v for v in values if v is not None], 2):
        want[level(a.encode(), b.encode()) if unit == "byte" else level(a, b)] += 1
    got = {r["level"]: int(r["pairs"]) for r in exact_level_counts(df, EDIT, unit=unit, block_split=10).collect()}
    assert got == want


def test_u_in_training(spark):
    values, df = rows_of(spark)
    model = Model(0.01, (EDIT,))
    u = exact_u(df, model)["v"]
    assert sum(u.values()) == pytest.approx(1.0)
    trained = train_model(df, model, id_col="uid", max_pairs=10, exact=True)  # the sample is far too small, u is right all the same
    assert trained.comparisons[0].u == pytest.approx(tuple(max(u[k], 1e-12) for k in range(4)))
    assert "u-exact:v" in trained.trained
    assert exact_u(df.where("v IS NULL"), model) == {}
    assert exact_u(df, Model.default(["first_name"])) == {}
    with pytest.raises(ValueError):
        exact_level_counts(df, Model.default(["first_name"]).comparisons[0])


def test_units_differ_where_a_character_has_several_bytes(spark):
    """One replaced character is one edit in characters, two in bytes: another level, another probability."""
    df = spark.createDataFrame([(1, "maria@x", "k"), (2, "mariñ@x", "k")], "id long, mail string, city string")
    model = Model.default(["mail", "city"], 0.5)
    p = {unit: resolve(df, model=model, id_col="id", unit=unit, threshold=0.0).first()["match_probability"] for unit in ("byte", "char")}
    by = {c.column: c for c in model.comparisons}

    def expected(mail_level):
        odds = model.prior_odds * by["mail"].factors[mail_level] * by["city"].factors[by["city"].exact_level]
        return odds / (1 + odds)

    assert p["char"] == pytest.approx(expected(2))
    assert p["byte"] == pytest.approx(expected(1))
    assert p["char"] != p["byte"]


def test_ordered_results_come_in_input_order(spark):
    ids = [5, 3, 9, 1, 7, 2, 8]
    df = spark.createDataFrame([(i, f"n{i % 2}") for i in ids], "id long, name string").repartition(4)
    assert [r["id"] for r in resolve(df, ["name"], id_col="id", ordered=True).collect()] == sorted(ids)
    one = spark.createDataFrame([(i, f"n{i % 2}") for i in ids], "id long, name string").coalesce(1)
    assert [r["id"] for r in resolve(one, ["name"], ordered=True).collect()] == ids  # without an id: as read


def test_a_common_ending_makes_few_candidates(spark):
    """Values that share most of their text are cut where they differ: few candidates, all near pairs."""
    import random

    from reunion.operators.near import NearValues, near_value_pairs

    rng = random.Random(4)
    heads = ["".join(rng.choices("0123456789abcdef", k=8)) for _ in range(600)]
    heads += [h[:3] + "z" + h[4:] for h in heads[:40]] + [h[1:] for h in heads[40:80]] + [h[:5] + "yy" + h[5:] for h in heads[80:120]]
    df = spark.createDataFrame([(i, h + "@building.example") for i, h in enumerate(heads)], "uid bigint, t string")
    got = sorted((r["a"], r["b"], r["distance"]) for r in near_value_pairs(df, "t", 2).collect())
    sql = "SELECT l.uid AS a, r.uid AS b, levenshtein(l.t, r.t) AS distance FROM v l JOIN v r ON l.uid < r.uid WHERE levenshtein(l.t, r.t) <= 2"
    df.createOrReplaceTempView("v")
    assert got == sorted(map(tuple, spark.sql(sql).collect()))
    assert NearValues(df, "t", 2).candidates.count() < len(heads) * (len(heads) - 1) // 2 // 20


def test_short_values_that_share_a_segment_are_no_candidates(spark):
    from reunion.operators.near import NearValues, near_value_pairs
    from reunion.session import written_folders

    rng = random.Random(8)
    values = sorted({"abc" + "".join(rng.choice("0123456789abcdeé") for _ in range(rng.choice([5, 6]))) + "@x.example" for _ in range(200)})
    values += ["", "a", "ab", "é", "aaaa", "aaaaaa", "bbbb", values[0] + "q", values[0][1:], "z" * 70, "z" * 69 + "y", "z" * 64, "z" * 65]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "uid long, t string")
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if _lev(values[i].encode(), values[j].encode()) <= 2}
    assert {(r.a, r.b) for r in near_value_pairs(df, "t", 2).collect()} == want
    short = {(r.a, r.b) for r in NearValues(df, "t", 2).candidates.collect() if max(len(values[r.a].encode()), len(values[r.b].encode())) <= 64}
    assert short == {(a, b) for a, b in want if max(len(values[a].encode()), len(values[b].encode())) <= 64}
    before = written_folders(spark)
    counts = exact_level_counts(df.withColumnRenamed("t", "v"), EDIT)
    assert not [f for f in written_folders(spark) if f not in before and "near-values" in f]  # gone before the next column
    assert sum(int(r["pairs"]) for r in counts.collect()) == len(values) * (len(values) - 1) // 2
