"""Edge cases: copies, NULLs, empty strings, payload types, thresholds, chains."""

from __future__ import annotations

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from reunion import MatchError, resolve
from tests.brute import resolve_brute


def _check(spark, rows, schema, columns, id_col="id", threshold=0.5, **kw):
    df = spark.createDataFrame(rows, schema)
    out = resolve(df, columns, id_col=id_col, threshold=threshold, **kw)
    got = {r[id_col]: (r["cluster_id"], r["match_probability"]) for r in out.collect()}
    want = resolve_brute([r.asDict() for r in df.collect()], columns, id_col, threshold)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0], (k, got[k], want[k])
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-12)
    return out


SCHEMA = "id bigint, first_name string, last_name string, email string"


def test_exact_copies_and_mixed_noise(spark):
    rng = random.Random(5)
    base = [("ann", "lee", "a@x"), ("bob", "ng", "b@x"), ("cy", "oh", None), (None, None, None)]
    rows = []
    for i in range(60):
        f, l, e = rng.choice(base)
        if rng.random() < 0.3 and f:
            f = f + rng.choice("xyz")
        rows.append((i, f, l, e))
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"])


def test_copies_below_threshold_stay_apart(spark):
    rows = [(1, "ann", "lee", None), (2, "ann", "lee", None), (3, "ann", "lee", None)]
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"], threshold=1.0)
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"], threshold=0.5)


def test_all_null_columns_are_singletons(spark):
    rows = [(i, None, None, None) for i in range(5)]
    out = _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"])
    assert out.select("cluster_id").distinct().count() == 5


def test_one_row(spark):
    out = _check(spark, [(9, "a", "b", "c")], SCHEMA, ["first_name", "last_name", "email"])
    assert [tuple(r) for r in out.select("cluster_id", "match_probability").collect()] == [("0", 1.0)]


def test_empty_strings_block(spark):
    rows = [(1, "", "x", "p"), (2, "", "y", "q"), (3, "a", "z", "r")]
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"], threshold=0.0)


def test_thresholds_zero_and_one(spark):
    rows = [(1, "john", "smith", "j@x"), (2, "jon", "smith", "j@x"), (3, "amy", "smith", "a@x"), (4, "zed", "q", "z@x")]
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"], threshold=0.0)
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"], threshold=1.0)


def test_chain_of_fifty_links(spark):
    rows = [(i, f"n{i}", f"m{i}", f"{i}@x") for i in range(51)]
    # record i shares the surname with i+1 on even i and the email with i+1 on odd i
    fixed = []
    for i in range(51):
        last = f"s{i // 2}" if i % 2 == 0 else f"s{(i - 1) // 2}"
        email = f"e{(i + 1) // 2}"
        fixed.append((i, "same", last, email))
    out = _check(spark, fixed, SCHEMA, ["first_name", "last_name", "email"], threshold=0.5)
    assert out.select("cluster_id").distinct().count() == 1


def test_payload_types_pass_through_unchanged(spark):
    schema = (
        "id bigint, first_name string, n int, d decimal(10,2), ts timestamp, arr array<int>, mp map<string,int>,"
        " st struct<a:int,b:string>"
    )
    ts = datetime.datetime(2024, 1, 2, 3, 4, 5)
    rows = [
        (1, "ann", None, decimal.Decimal("1.50"), ts, [1, 2], {"k": 1}, (1, "x")),
        (2, "ann", 7, None, None, None, None, None),
        (3, "bob", 3, decimal.Decimal("2.00"), ts, [], {}, (None, None)),
    ]
    df = spark.createDataFrame(rows, schema)
    out = resolve(df, ["first_name"], id_col="id")
    assert out.schema.fields[: len(df.columns)] == df.schema.fields
    got = {r["id"]: r for r in out.collect()}
    for r in df.collect():
        assert tuple(got[r["id"]])[: len(df.columns)] == tuple(r)
    assert got[1]["cluster_id"] == got[2]["cluster_id"] != got[3]["cluster_id"]


def test_non_string_comparison_column(spark):
    rows = [(1, 100, "x"), (2, 100, "y"), (3, 101, "y")]
    df = spark.createDataFrame(rows, "id bigint, code int, name string")
    out = resolve(df, ["code", "name"], id_col="id")
    assert out.schema["code"].dataType.simpleString() == "int"
    want = resolve_brute([r.asDict() for r in df.collect()], ["code", "name"], "id", 0.5)
    got = {r["id"]: r["cluster_id"] for r in out.collect()}
    assert got == {k: v[0] for k, v in want.items()}


def test_mixed_case_chooser(spark):
    from reunion.model import Model

    m = Model.default(["First_Name", "EMAIL"])
    assert [c.kind for c in m.comparisons] == ["name", "edit"]
    df = spark.createDataFrame([(1, "Ann", "a"), (2, "Anne", "a")], "id bigint, First_Name string, EMAIL string")
    assert resolve(df, ["First_Name", "EMAIL"], id_col="id").select("cluster_id").distinct().count() == 1
    with pytest.raises(MatchError, match="not found"):
        resolve(df, ["first_name"], id_col="id")


def test_salting_inside_resolve_is_exact(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["al", "alx", "bo"]), "smith", f"{rng.randrange(30)}@x") for i in range(120)]
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"], block_split=7)


def test_within_restricts_blocking(spark):
    rows = [(1, "ann", "lee", "a", "n"), (2, "ann", "lee", "a", "s"), (3, "ann", "lee", "a", "n")]
    df = spark.createDataFrame(rows, "id bigint, first_name string, last_name string, email string, region string")
    out = resolve(df, ["first_name", "last_name", "email"], id_col="id", within=["region"])
    got = {r["id"]: r["cluster_id"] for r in out.collect()}
    assert got[1] == got[3] != got[2]


@pytest.mark.parametrize("threshold", [0.9, 0.99, 0.999])
def test_bound_pruning_keeps_every_link(spark, threshold):
    rng = random.Random(int(threshold * 1000))
    firsts = ["jon", "john", "johnny", "jan", "jane", "janet", "al", "alan"]
    rows = [
        (i, rng.choice(firsts), rng.choice(["smith", "smyth", "doe"]), rng.choice(["a@x", "a@y", "b@x", None]))
        for i in range(80)
    ]
    _check(spark, rows, SCHEMA, ["first_name", "last_name", "email"], threshold=threshold)
