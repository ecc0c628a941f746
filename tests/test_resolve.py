"""The reference's assertions on the 7-row customer fixture, plus the golden values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reunion import MatchError, resolve
from reunion.sources.fixtures import ANN, COMPARISON_COLUMNS, CUSTOMER_GROUPS, FIVE, THREE, customers, inline

GOLDEN_P = 0.9999916672642869


def _by_row(out):
    return {r["row_id"]: (r["cluster_id"], r["match_probability"]) for r in out.collect()}


def test_recovers_planted_groups(spark):
    df = customers(spark)
    out = resolve(df, COMPARISON_COLUMNS, id_col="row_id")
    rows = out.orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(7))
    assert [r["email"] for r in rows] == [r["email"] for r in df.orderBy("row_id").collect()]
    by = _by_row(out)
    for group in CUSTOMER_GROUPS:
        assert len({by[r][0] for r in group}) == 1
    assert len({by[g[0]][0] for g in CUSTOMER_GROUPS}) == len(CUSTOMER_GROUPS)


def test_golden_ids_and_probabilities(spark):
    by = _by_row(resolve(customers(spark), "first_name,last_name,email", id_col="row_id"))
    assert [by[i][0] for i in range(7)] == ["0", "0", "0", "1", "1", "2", "3"]
    assert [by[i][1] for i in range(5)] == pytest.approx([GOLDEN_P] * 5, abs=1e-15)
    assert by[5][1] == 1.0 and by[6][1] == 1.0


def test_generated_ids_follow_input_order(spark):
    out = resolve(customers(spark), "first_name,last_name,email")
    assert "__reunion_uid" not in out.columns
    by = _by_row(out)
    assert [by[i][0] for i in range(7)] == ["0", "0", "0", "1", "1", "2", "3"]


def test_output_schema_is_passthrough_plus_two(spark):
    df = customers(spark)
    out = resolve(df, "first_name,last_name,email", id_col="row_id")
    assert out.columns == [*df.columns, "cluster_id", "match_probability"]
    assert out.schema["cluster_id"].dataType == T.StringType()
    assert out.schema["match_probability"].dataType == T.DoubleType()
    assert "comment" in out.schema["cluster_id"].metadata
    assert out.count() == df.count()


def test_probability_is_valid(spark):
    out = resolve(customers(spark), COMPARISON_COLUMNS, id_col="row_id")
    assert out.where((F.col("match_probability") < 0) | (F.col("match_probability") > 1)).count() == 0
    assert out.where(F.col("match_probability").isNull()).count() == 0


def test_last_name_only_and_strict(spark):
    df = customers(spark)
    assert resolve(df, "last_name", id_col="row_id").select("cluster_id").distinct().count() == 3
    assert resolve(df, "last_name", id_col="row_id", threshold=0.99).select("cluster_id").distinct().count() == 7


def test_inline_relations(spark):
    out = resolve(inline(spark, ANN), "first_name,last_name")
    assert out.select("cluster_id").distinct().count() == 2
    ps = sorted(r["match_probability"] for r in out.collect())
    assert ps[:2] == pytest.approx([0.9951625725704335] * 2, abs=1e-15)
    three = resolve(inline(spark, THREE), "first_name,last_name,email")
    assert three.select("cluster_id").distinct().count() == 2
    five = resolve(inline(spark, FIVE), "first_name,last_name,email")
    groups = five.groupBy("cluster_id").count().where("count > 1").count()
    assert groups == 2  # John/Jon and Jane/Jayne; Bob stays alone


def test_reserved_columns_replaced(spark):
    df = customers(spark).withColumn("cluster_id", F.lit(42)).withColumn("match_probability", F.lit("x"))
    out = resolve(df, COMPARISON_COLUMNS, id_col="row_id")
    assert out.columns[-2:] == ["cluster_id", "match_probability"]
    assert out.columns.count("cluster_id") == 1
    assert out.schema["cluster_id"].dataType == T.StringType()


def test_empty_input_raises(spark):
    with pytest.raises(MatchError, match="non-empty"):
        resolve(customers(spark).limit(0), COMPARISON_COLUMNS)


def test_missing_column_raises(spark):
    with pytest.raises(MatchError, match="not found"):
        resolve(customers(spark), ["first_name", "nope"])


def test_no_columns_raises(spark):
    with pytest.raises(MatchError, match="no comparison columns"):
        resolve(customers(spark), [])
    with pytest.raises(MatchError, match="no comparison columns"):
        resolve(customers(spark), " , ")


def test_bad_threshold_raises(spark):
    with pytest.raises(MatchError, match="threshold must be"):
        resolve(customers(spark), COMPARISON_COLUMNS, threshold=1.5)
    with pytest.raises(MatchError, match="threshold must be"):
        resolve(customers(spark), COMPARISON_COLUMNS, threshold=float("nan"))


def test_error_order_empty_before_threshold_before_columns(spark):
    empty = customers(spark).limit(0)
    with pytest.raises(MatchError, match="non-empty"):
        resolve(empty, ["nope"], threshold=2.0)
    with pytest.raises(MatchError, match="threshold"):
        resolve(customers(spark), ["nope"], threshold=2.0)


def test_column_names_are_case_sensitive(spark):
    with pytest.raises(MatchError, match="not found"):
        resolve(customers(spark), ["First_Name"])


def test_duplicate_ids_rejected(spark):
    df = customers(spark).withColumn("row_id", F.lit(1))
    with pytest.raises(MatchError, match="unique"):
        resolve(df, COMPARISON_COLUMNS, id_col="row_id")


def test_empty_input_with_id_col_raises(spark):
    with pytest.raises(MatchError, match="non-empty"):
        resolve(customers(spark).limit(0), COMPARISON_COLUMNS, id_col="row_id")
