"""Large blocks compared in matrices: the same links and counts as by pairs of rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reunion.model import Comparison, Model
from reunion.operators import training
from reunion.operators.blocking import _salt, block_maxima, candidate_pairs, stack_rules
from reunion.operators.dense import pair_levels, reachable_pairs
from reunion.operators.scoring import compare_pairs, link_pairs, score_pairs

COLUMNS = ["first_name", "last_name", "email"]


def _records(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)

    def word(letters: str, low: int, high: int) -> str | None:
        return None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))

    rows = [(i * 7 % 1009, word("abcé€", 0, 7), word("xy", 1, 1), word("aabbcdé@", 0, 9)) for i in range(n)]
    # near copies, repeated symbols and moved ones
    rows += [(2000 + i, (f or "")[::-1], s, (e or "ab") + "q") for i, (_, f, s, e) in enumerate(rows[: n // 3])]
    rows += [(4000 + i, f, s, "aaaaaaa" + (e or "")[1:]) for i, (_, f, s, e) in enumerate(rows[: n // 3])]
    return rows


MODELS = {
    "default": Model.default(COLUMNS),
    "odd": Model(
        0.05,
        (
            Comparison("first_name", "name", (0.9, 0.75, 0.6), (0.2, 0.3, 0.05, 0.2, 0.25), (0.6, 0.1, 0.1, 0.15, 0.05)),
            Comparison("last_name", "edit", (1.0,), (0.1, 0.1, 0.8), (0.5, 0.1, 0.4)),
            Comparison("email", "edit", (1.0, 3.0), (0.1, 0.3, 0.2, 0.4), (0.7, 0.1, 0.15, 0.05)),
        ),
    ),
}


@pytest.mark.parametrize("name, split, unit", [("default", None, "byte"), ("default", 20, "char"), ("odd", 20, "byte")])
def test_no_link_is_lost(spark, name, split, unit):
    model = MODELS[name]
    df = spark.createDataFrame(_records(150, 3), "uid bigint, first_name string, last_name string, email string")
    maxima = block_maxima(stack_rules(df, COLUMNS, id_col="uid"), 3)

    def links(pairs, t):
        scored = link_pairs(score_pairs(compare_pairs(pairs, model, unit=unit), model), t)
        return sorted(map(tuple, scored.select("uid_l", "uid_r", "rule", F.round("match_probability", 9)).collect()))

    every = candidate_pairs(df, COLUMNS, carry=COLUMNS, block_split=None)
    for t in (0.2, 0.9):
        few = reachable_pairs(df, COLUMNS, model, t, carry=COLUMNS, unit=unit, block_split=split, maxima=maxima, dense_block=3)
        assert links(few, t) == links(every, t)
        assert few.count() < every.count()


def test_within(spark):
    df = spark.createDataFrame(_records(90, 5), "uid bigint, first_name string, last_name string, email string").withColumn("g", F.expr("CAST(uid % 2 AS STRING)"))
    model = MODELS["default"]

    def links(pairs):
        return sorted(map(tuple, link_pairs(score_pairs(compare_pairs(pairs, model), model), 0.5).select("uid_l", "uid_r").collect()))

    maxima = block_maxima(stack_rules(df, COLUMNS, id_col="uid", within=["g"]), 3)
    few = reachable_pairs(df, COLUMNS, model, 0.5, within=["g"], carry=COLUMNS, maxima=maxima, dense_block=3)
    assert links(few) == links(candidate_pairs(df, COLUMNS, within=["g"], carry=COLUMNS))


def test_large_blocks_leave_few_pairs(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("0123456789abcdef", k=6)), "same", "".join(rng.choices("0123456789abcdef", k=8)) + "@x.example") for i in range(600)]
    df = spark.createDataFrame(rows, "uid bigint, first_name string, last_name string, email string")
    few = reachable_pairs(df, COLUMNS, MODELS["default"], 0.5, carry=COLUMNS, maxima=[1, 600, 1])
    assert few.count() < 600 * 599 // 2 // 20


def test_large_blocks_are_spread_over_the_shuffle_partitions(spark):
    rows = [(i, f"ann{i // 40}", f"s{i % 40}", f"m{i // 80}@x.example") for i in range(1600)]
    df = spark.createDataFrame(rows, "uid bigint, first_name string, last_name string, email string")
    few = reachable_pairs(df, ["last_name"], MODELS["default"], 0.5, carry=COLUMNS, maxima=[40], dense_block=3)
    assert few.select(F.spark_partition_id().alias("p")).distinct().count() >= 4


def test_a_small_split_copies_no_record_for_every_other(spark):
    df = spark.createDataFrame([(i, "same") for i in range(400)], "uid bigint, s string")
    stacked = stack_rules(df, ["s"], id_col="uid")
    assert _salt(stacked, 3).count() <= 400 * 4
    assert candidate_pairs(df, ["s"], block_split=3).select("uid_l", "uid_r").distinct().count() == 400 * 399 // 2


@pytest.mark.parametrize("name, unit", [("default", "byte"), ("odd", "char")])
def test_pattern_counts(spark, monkeypatch, name, unit):
    df = spark.createDataFrame(_records(120, 9), "uid bigint, first_name string, last_name string, email string")
    profiles = training.profiles_of(df.unionByName(df.where("uid % 5 = 0").withColumn("uid", F.expr("uid + 9000"))), COLUMNS)

    def counts(blocked, split):
        return sorted(map(tuple, training.em_patterns(profiles, MODELS[name], blocked, unit=unit, block_split=split).collect()))

    plain = {c: counts(c, None) for c in COLUMNS}
    monkeypatch.setattr(training, "DENSE_BLOCK", 3)
    monkeypatch.setattr("reunion.operators.dense.DENSE_BLOCK", 3)
    for c in COLUMNS:
        assert counts(c, 15) == plain[c]


@pytest.mark.parametrize("name, split, unit", [("default", None, "byte"), ("odd", 20, "char"), ("odd", 20, "byte")])
def test_all_pairs_with_their_levels(spark, name, split, unit):
    model = MODELS[name]
    rows = _records(120, 9)
    rows += rows[:5] + [(rows[0][0], "cab", "x", "aab@"), (None, "cab", "x", "aab@"), (5001, "", "y", ""), (5002, "", "y", "a")]  # repeated ids, none at all
    df = spark.createDataFrame(rows, "uid bigint, first_name string, last_name string, email string")
    rules = [("first_name", "email"), "last_name"]
    maxima = block_maxima(stack_rules(df, rules, id_col="uid"), 2)
    want = compare_pairs(candidate_pairs(df, rules, carry=COLUMNS, block_split=None), model, unit=unit)
    got = pair_levels(df, rules, model, unit=unit, block_split=split, maxima=maxima, dense_block=3)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    two = pair_levels(df, rules, model, columns=["first_name", "email"], unit=unit, block_split=split, maxima=maxima, dense_block=3)
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, want.select(two.columns).collect()))


def test_large_blocks_are_not_joined(spark, tmp_path, monkeypatch):
    """The pairs of large blocks come from matrices, a row of the join for none of them."""
    from reunion.operators import dense
    from reunion.plans.queries import PLANTED, q_name_levels, q_scored_pairs

    spark.range(0, 600).selectExpr("id * 997 + 5 AS c_custkey", "'BUILDING' AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    joined = []
    real = dense.joined_pairs
    monkeypatch.setattr(dense, "joined_pairs", lambda *a, **k: joined.append(real(*a, **k)) or joined[-1])
    pairs = candidate_pairs(PLANTED.slim(spark, str(tmp_path)), COLUMNS, carry=COLUMNS)
    want = score_pairs(compare_pairs(pairs, PLANTED.model), PLANTED.model)
    names = ["uid_l", "uid_r", "first_name_level", "last_name_level"]
    assert sorted(map(tuple, q_name_levels(spark, str(tmp_path)).collect())) == sorted(map(tuple, want.select(names).collect()))
    scored = want.select("uid_l", "uid_r", F.round("match_probability", 9))
    assert sorted(map(tuple, q_scored_pairs(spark, str(tmp_path)).collect())) == sorted(map(tuple, scored.collect()))
    assert len(joined) == 2 and all(j.count() < 10_000 for j in joined) and pairs.count() > 200_000


def test_rounded_probabilities(spark):
    from reunion.functions.levels import match_probability_sql

    for model in MODELS.values():
        levels = spark.createDataFrame([(a, b, c) for a in range(-1, 5) for b in range(-1, 3) for c in range(-1, 4) if a < model.comparisons[0].n_levels], "first_name_level int, last_name_level int, email_level int")
        got = score_pairs(levels, model, digits=9).select("match_probability")
        assert got.collect() == score_pairs(levels, model).select(F.round("match_probability", 9).alias("match_probability")).collect()
        assert "round" in match_probability_sql(model, ["a", "b", "c"], 9)


def test_pairs_of_large_blocks_are_lists_until_the_last_step(spark):
    """A task returns a row per record and run of records; Spark makes the pairs of them in the step that reads them."""
    df = spark.createDataFrame([(i, f"n{i}", "same", f"m{i}@x") for i in range(500)], "uid bigint, first_name string, last_name string, email string")
    pairs = pair_levels(df, COLUMNS, MODELS["default"], maxima=[1, 500, 1])
    assert pairs.count() == 500 * 499 // 2
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("Union") < plan.index("FlatMapGroupsInArrow")


@pytest.mark.parametrize("encode", [True, False])
def test_few_pairs_are_compared_symbol_by_symbol(monkeypatch, encode):
    import numpy as np

    from reunion.functions.similarity import jaro_winkler
    from reunion.operators import dense

    rng = random.Random(7)
    values = ["".join(rng.choices("0123456789abcdef", k=6)) for _ in range(150)]
    values += ["", "é", "€a", values[0], values[1][::-1], values[2] + "z", values[3][:4], "x" * 40 + values[4], values[5] + "@example"]
    values += [v + "@example" for v in values[:40]] + [v[1:] + "q@example" for v in values[:9]]
    p, r = np.triu_indices(len(values), 1)
    cells = []
    real = dense._scores, dense._edit_distances
    monkeypatch.setattr(dense, "_scores", lambda a, *rest: cells.append(len(a)) or real[0](a, *rest))
    monkeypatch.setattr(dense, "_edit_distances", lambda a, *rest: cells.append(len(a)) or real[1](a, *rest))

    def levenshtein(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for comp in (MODELS["default"].comparisons[0], MODELS["default"].comparisons[2], MODELS["odd"].comparisons[2]):
        bands = dense.bands_of(comp)
        got = dense._exact_levels(dense._Values(values, encode), bands, p, r)
        coded = [v.encode() if encode else v for v in values]
        for a, b, level in zip(p, r, got):
            if coded[a] == coded[b]:
                want = comp.exact_level
            elif comp.kind == "name":
                want = next((lvl for t, lvl in comp.band_levels() if round(jaro_winkler(coded[a], coded[b]), 12) >= t), 0)
            else:
                d = levenshtein(coded[a], coded[b])
                want = next((lvl for t, lvl in comp.band_levels() if d <= t), 0)
            assert level == want, (coded[a], coded[b])
    assert sum(cells) < 3 * len(p) // 4
