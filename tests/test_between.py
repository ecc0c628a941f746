"""Blocks of two relations compared in matrices: the links that all pairs of the blocks give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reunion import Model
from reunion.operators.dense import block_sizes, large_between, reachable_between
from reunion.plans.incremental import KeptEntities
from reunion.plans.score import KnownRecords, score_records, stack
from reunion.operators.blocking import block_maxima

COLUMNS = ["first_name", "last_name", "email"]


def _people(n: int, seed: int, first: int) -> list[tuple]:
    rng = random.Random(seed)

    def word(k: int) -> str:
        return "".join(rng.choice("abcdé") for _ in range(k))

    rows = []
    for i in range(n):
        name = rng.choice([None, "", word(5), word(6)])
        mail = rng.choice([None, f"{word(4)}@x.example", f"{word(5)}@y.example"])
        rows.append((first + i, name, rng.choice(["hot", "hot", "warm", None]), mail, rng.choice(["g", "h"])))
    return rows


def _frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, "id long, first_name string, last_name string, email string, g string").withColumn("id", F.col("id").cast(kind))


def _links(found, kind=int):
    return sorted((r.uid_l, r.uid_r, round(r.match_probability, 12)) for r in found.collect())


@pytest.mark.parametrize("within, split", [([], 5000), (["g"], 60)])
def test_links_of_large_blocks(spark, within, split):
    model = Model.default(COLUMNS, 0.2)
    new, known = _frame(spark, _people(300, 1, 0), "string"), _frame(spark, _people(320, 2, 100))
    for t in (0.3, 0.9):
        records = KnownRecords(known, model, "id", within, "byte", split)
        stacked = stack(new, model, "id", within, "byte")
        _, pairs = records._reachable(stacked, block_maxima(stacked, 3), t)
        every = stacked.alias("l").join(records.stack.alias("r"), ["rule", "key"]).count()
        assert 0 < pairs.count() < every
        got = _links(records.links(stacked, t))
        records.maxima = [0, 0, 0]  # by joins alone
        want = _links(records.links(stacked, t))
        assert got == want and want


def test_large_blocks_between_two_relations(spark):
    left = spark.createDataFrame([(i, "a", 0, 1) for i in range(20)] + [(50, "b", 0, 2)] + [(60 + i, "x" * 300, 0, 3) for i in range(20)], "uid long, c0 string, rule int, key long")
    right = spark.createDataFrame([(i, "a", 0, 1) for i in range(9)] + [(i, "b", 0, 2) for i in range(90)] + [(i, "x", 0, 3) for i in range(20)], "uid long, c0 string, rule int, key long")
    found = large_between(block_sizes(left, ["c0"]), block_sizes(right, ["c0"]), 10)
    assert [(r.key, r._nl, r._nr) for r in found.collect()] == [(1, 20, 9)]  # not that of one record, nor that of a long value
    pairs = reachable_between(left, right, found, ["c0"], Model.default(["c0"]).renamed({"c0": "c0"}), 0.1, block_split=4)
    assert sorted((r.uid_l, r.uid_r) for r in pairs.collect()) == [(i, j) for i in range(20) for j in range(9)]


def test_scores_of_a_hot_block(spark):
    known = spark.createDataFrame([(i, "hot", f"{i:06d}@a") for i in range(300)], "kid long, last_name string, email string")
    new = spark.createDataFrame([(f"n{i}", "hot", f"{i:06d}@b") for i in range(200)], "nid string, last_name string, email string")
    out = score_records(new, known, Model.default(["last_name", "email"], 0.1), new_id="nid", known_id="kid", threshold=0.97)
    rows = out.collect()
    assert len(rows) == 200 and all(f"n{r.match_id}" == r.nid for r in rows)


def test_batches_with_large_blocks(spark, monkeypatch):
    rows = _people(560, 3, 0)
    model = Model.default(COLUMNS, 0.2)

    def entities():
        kept = KeptEntities(model, id_col="id", threshold=0.9)
        for k in (1, 0):
            kept.add(_frame(spark, [r for r in rows if r[0] % 2 == k]))
        return sorted((r.id, r.entity, round(r.match_probability, 12)) for r in kept.entities().collect())

    seen = []

    def reachable(*args, **options):
        seen.append(args)
        return reachable_between(*args, **options)

    monkeypatch.setattr("reunion.plans.score.reachable_between", reachable)
    got = entities()
    assert seen
    monkeypatch.setattr("reunion.plans.score.DENSE_BLOCK", 10**6)
    monkeypatch.setattr("reunion.operators.dense.DENSE_BLOCK", 10**6)
    assert got == entities()
