"""Any column name, payload and model form: internal names never meet the caller's."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reunion import MatchError, Model, resolve
from reunion.plans.score import score_records
from tests.brute import resolve_brute

OURS = ["key", "rule", "uid", "n", "pid", "root", "best", "p_self", "shared", "proot", "c0", "p0", "a.b", "back`tick", "uid_l", "largest"]
ROWS = [(1, "ann", "x"), (2, "ann", "y"), (3, "anne", "x"), (4, None, "z"), (5, "bob", "z")]


@pytest.mark.parametrize("name", OURS)
def test_compared_column_of_any_name(spark, name):
    df = spark.createDataFrame(ROWS, "id bigint, a string, b string").toDF("id", name, "other")
    out = resolve(df, [name, "other"], id_col="id")
    assert out.columns == ["id", name, "other", "cluster_id", "match_probability"]
    got = {r[0]: (r[3], r[4]) for r in out.collect()}
    model = Model.default(["a", "b"])
    want = resolve_brute([dict(zip(("id", "a", "b"), r)) for r in ROWS], ["a", "b"], "id", 0.5, model)
    kinds = Model.default([name]).comparisons[0].kind
    if kinds == "edit":
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_reserved_names_in_any_case_are_replaced(spark):
    df = spark.createDataFrame([(1, "a", "old", 0.1, "x")], "id bigint, name string, c string, m double, p string").toDF("id", "name", "Cluster_ID", "MATCH_probability", "a.b")
    out = resolve(df, ["name"], id_col="id")
    assert out.columns == ["id", "name", "a.b", "cluster_id", "match_probability"]
    assert [tuple(r) for r in out.collect()] == [(1, "a", "x", "0", 1.0)]
    assert not out.schema["cluster_id"].nullable and not out.schema["match_probability"].nullable


def test_interval_payload_without_id(spark):
    df = spark.sql("SELECT 'ann' AS name, make_interval(1, 2) AS span UNION ALL SELECT 'ann', NULL")
    out = resolve(df, ["name"])
    assert out.schema["span"].dataType.typeName() == "interval" and out.selectExpr("name", "CAST(span AS STRING) AS span", "cluster_id").count() == 2


def test_model_forms_and_blocking(spark, tmp_path):
    df = spark.createDataFrame([(1, "ann", "lee", "x"), (2, "ann", "lee", "x"), (3, "ann", "ng", "x"), (4, "anna", "lee", "y")], "id bigint, name string, surname string, town string")
    m = Model.default(["name", "surname"])
    m = Model(m.prior, m.comparisons, blocking=(("surname", "town"),))
    assert Model.from_json(m.to_json()) == m == Model.from_dataframe(m.to_dataframe(spark))
    m.save(str(tmp_path / "model"))
    want = [tuple(r) for r in resolve(df, model=m, id_col="id").orderBy("id").collect()]
    assert [r[-2] for r in want] == ["0", "0", "1", "2"]
    import json

    for form in (m.to_json(), json.loads(m.to_json()), str(tmp_path / "model")):
        assert [tuple(r) for r in resolve(df, model=form, id_col="id").orderBy("id").collect()] == want
    given = resolve(df, ["name", "surname"], blocking=[["surname", "town"]], id_col="id").orderBy("id").collect()
    assert [tuple(r) for r in given] == want


def test_score_records_checks(spark):
    m = Model.default(["name"])
    known = spark.createDataFrame([(1, "ann")], "kid bigint, name string")
    new = spark.createDataFrame([(7, "ann", "x"), (8, "bo", "y")], "nid bigint, name string, Match_ID string")
    out = score_records(new, known, m, new_id="nid", known_id="kid").orderBy("nid")
    assert out.columns == ["nid", "name", "match_id", "match_probability"]
    assert [r["match_id"] for r in out.collect()] == [1, None]
    with pytest.raises(MatchError, match="unique"):
        score_records(new.withColumn("nid", F.lit(7)), known, m, new_id="nid", known_id="kid")
    with pytest.raises(MatchError, match="threshold must be"):
        score_records(new, known, m, new_id="nid", known_id="kid", threshold=2)
    with pytest.raises(MatchError, match="non-empty"):
        score_records(new, known.limit(0), m, new_id="nid", known_id="kid")


def test_hot_blocks_on_both_sides_are_spread(spark):
    known = spark.createDataFrame([(i, "lee" if i % 4 else "ng", f"e{i % 9}") for i in range(60)], "kid bigint, surname string, mail string")
    new = spark.createDataFrame([(i, "lee" if i % 3 else "ngo", f"e{i % 7}") for i in range(50)], "nid bigint, surname string, mail string")
    m = Model.default(["surname", "mail"])
    plain = sorted(map(tuple, score_records(new, known, m, new_id="nid", known_id="kid", block_split=None).collect()))
    assert plain == sorted(map(tuple, score_records(new, known, m, new_id="nid", known_id="kid", block_split=5).collect()))


def test_golden_levels_factors_and_probability(spark):
    """Written-out numbers, apart from the constants that the engine and its twins share."""
    m = Model.default(["name", "mail"])
    name, mail = m.comparisons
    assert name.factors == pytest.approx((0.0148570, 0.0943338, 0.598973, 3.803169, 486.8056), rel=1e-3)
    assert [len(name.m), len(mail.m)] == [5, 4] and sum(name.u) == pytest.approx(1.0) and sum(mail.m) == pytest.approx(1.0)
    from reunion.operators.scoring import compare_pairs

    pairs = [("martha", "marhta", 3), ("dwayne", "duane", 1), ("dixon", "dicksonx", 1), ("abc", "xyz", 0), ("same", "same", 4), (None, "x", -1), ("ann", "anne", 3)]
    df = spark.createDataFrame([(i, a, b, x, y) for i, (a, b, _) in enumerate(pairs) for x, y in [("k@x", "k@y")]], "i int, name_l string, name_r string, mail_l string, mail_r string")
    got = {r["i"]: (r["name_level"], r["mail_level"]) for r in compare_pairs(df, m).collect()}
    assert [got[i] for i in range(len(pairs))] == [(lv, 2) for *_, lv in pairs]
    edits = [("kitten", "sitten", 2), ("kitten", "sittin", 1), ("kitten", "sitting", 0), ("", "", 3)]
    df = spark.createDataFrame([(i, "a", "a", x, y) for i, (x, y, _) in enumerate(edits)], "i int, name_l string, name_r string, mail_l string, mail_r string")
    assert [r["mail_level"] for r in compare_pairs(df, m).orderBy("i").collect()] == [lv for *_, lv in edits]


def test_probability_with_many_columns(spark):
    """More level patterns than one table holds: the odds are the product of several lookups."""
    from reunion.functions.levels import match_probability_sql

    m = Model.default([f"k{i}" for i in range(8)])
    levels = [3, 0, 2, -1, 1, 3, 0, 2]
    odds = m.prior_odds
    for c, lv in zip(m.comparisons, levels):
        odds *= 1.0 if lv < 0 else c.factors[lv]
    sql = match_probability_sql(m, [str(lv) for lv in levels])
    assert spark.sql(f"SELECT {sql} AS p").collect()[0]["p"] == pytest.approx(odds / (1 + odds), rel=1e-12)
