"""Training steps, model persistence and the SQL surface."""

from __future__ import annotations

import itertools

import pytest

from reunion import Model, resolve, resolved_view
from reunion.operators import training as T
from reunion.plans.queries import PLANTED
from reunion.sources.fixtures import customers, sample_customers
from tests.conftest import SF01


def test_prior_matches_blocked_pairs(spark):
    slim = T._slim(PLANTED.rows(spark, SF01), PLANTED.columns, "record_id")
    prior, col = T.estimate_prior(slim, PLANTED.columns)
    assert col == "first_name"
    assert prior == pytest.approx(215 / 0.7 / (2015 * 2014 / 2), rel=1e-12)


def test_u_buckets():
    assert T.u_buckets(1414) == 1
    assert T.u_buckets(1415) == 2
    assert T.u_buckets(2000) == 2
    assert T.u_buckets(10**6) == 500_000


def test_em_recovers_parameters_from_expected_counts(spark):
    m_true = [[0.05, 0.1, 0.85], [0.1, 0.2, 0.7]]
    base = Model.default(["a", "b"])
    comps = [base.comparisons[0].__class__("a", "edit", (1.0,), (0.3, 0.3, 0.4), (0.8, 0.15, 0.05)),
             base.comparisons[1].__class__("b", "edit", (1.0,), (0.3, 0.3, 0.4), (0.7, 0.2, 0.1))]
    lam = 0.2
    total = 1_000_000
    patterns = []
    for la, lb in itertools.product(range(3), range(3)):
        pm = lam * m_true[0][la] * m_true[1][lb]
        pu = (1 - lam) * comps[0].u[la] * comps[1].u[lb]
        patterns.append((0, la, lb, round(total * (pm + pu))))
    df = spark.createDataFrame(patterns, "pass int, l0 int, l1 int, n long").coalesce(1).cache()
    m, lam_hat, it, converged = T.run_em(df, comps, {0: 0.5}, max_iter=150, tol=1e-5)[0]
    assert converged and it < 150
    assert not T.run_em(df, comps, {0: 0.5}, max_iter=2, tol=1e-9)[0][3]
    assert lam_hat == pytest.approx(lam, abs=5e-3)
    for j in range(2):
        assert m[j] == pytest.approx(m_true[j], abs=2e-2)


def test_training_is_best_effort(spark):
    df = spark.createDataFrame([(i, f"n{i}", f"e{i}") for i in range(20)], "id bigint, name string, email string")
    model = T.train_model(df, Model.default(["name", "email"]), id_col="id")
    assert not any(t.startswith("prior") or t.startswith("em-pass") for t in model.trained)
    assert model.prior == Model.default(["name", "email"]).prior
    assert [c.m for c in model.comparisons] == [c.m for c in Model.default(["name", "email"]).comparisons]
    out = resolve(df, ["name", "email"], id_col="id", train=True)
    assert out.select("cluster_id").distinct().count() == 20


def test_trained_resolve_keeps_rows_and_probabilities_valid(spark):
    rows = PLANTED.rows(spark, SF01)
    out = resolve(rows, PLANTED.columns, id_col="record_id", train=True)
    assert out.count() == rows.count()
    assert out.where("match_probability < 0 OR match_probability > 1 OR match_probability IS NULL").count() == 0


def test_model_json_and_table_round_trip(spark):
    m = Model.default(["first_name", "email"], prior=0.03)
    assert Model.from_json(m.to_json()) == m
    back = Model.from_dataframe(m.to_dataframe(spark))
    assert back.prior == m.prior and back.comparisons == m.comparisons


def test_supplied_model_wins_over_train(spark):
    df = customers(spark)
    m = Model.default(["first_name", "last_name", "email"], prior=0.5)
    a = resolve(df, model=m, train=True, id_col="row_id").orderBy("row_id").collect()
    b = resolve(df, model=m.to_json(), id_col="row_id").orderBy("row_id").collect()
    assert a == b


def test_resolved_view_and_demo_relation(spark):
    sample_customers(spark)
    assert spark.sql("SELECT count(*) FROM sample_customers WHERE last_name = 'Smith'").collect()[0][0] == 3
    resolved_view(spark, "resolved_demo", "SELECT * FROM sample_customers", "first_name,last_name,email", id_col="record_id")
    rows = spark.sql(
        "SELECT expected_entity, count(DISTINCT cluster_id) AS c FROM resolved_demo GROUP BY expected_entity"
    ).collect()
    assert all(r["c"] == 1 for r in rows) and len(rows) == 4
    assert spark.sql("SELECT count(DISTINCT cluster_id) FROM resolved_demo").collect()[0][0] == 4


def test_model_file_and_ordered_output(spark):
    import os
    import tempfile

    df = customers(spark)
    path = os.path.join(tempfile.mkdtemp(prefix="reunion-model-", dir="/tmp"), "model.json")
    m = Model.default(["first_name", "last_name", "email"], prior=0.2)
    m.save(path)
    a = resolve(df, model=path, id_col="row_id", ordered=True)
    assert [r["row_id"] for r in a.collect()] == list(range(7))
    b = resolve(df, model=m, id_col="row_id").orderBy("row_id")
    assert a.collect() == b.collect()


def test_copies_train_without_all_their_pairs(spark):
    """A block of exact copies is one profile: its pairs are counted, not made."""
    rows = [(i, "ann", "a@x") for i in range(3000)] + [(5000 + i, f"n{i % 20}", f"m{i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "uid bigint, name string, email string")
    m = Model.default(["name", "email"])
    profiles = T.profiles_of(df, m.columns)
    got = {tuple(r)[0]: r["n"] for r in T.em_patterns(profiles, m, "name").collect()}
    by = {}
    for i, (_, a, x) in enumerate(rows):
        by.setdefault(a, []).append(x)
    same = sum(v.count(x) * (v.count(x) - 1) // 2 for v in by.values() for x in set(v))
    every = sum(len(v) * (len(v) - 1) // 2 for v in by.values())
    assert got[3] == same and sum(got.values()) == every
    model = T.trained_model(df, ["name", "email"], id_col="uid", max_pairs=2000, iterations=3)
    assert any(t.startswith("u-pairs:") and 500 < int(t[8:]) < 6000 for t in model.trained)
    assert any("not converged" in t or "iterations" in t for t in model.trained)


def test_trained_model_is_handed_out(spark):
    seen = []
    df = spark.createDataFrame([(i, f"n{i % 6}", f"e{i % 5}") for i in range(40)], "id bigint, name string, email string")
    a = resolve(df, ["name", "email"], id_col="id", train=True, train_options={"seed": 3, "iterations": 5}, on_model=seen.append)
    b = resolve(df, model=seen[0], id_col="id")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert seen[0].trained
