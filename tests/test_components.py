"""Component rounds: hubs are split, rounds end by themselves, intermediates are deleted."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reunion import resolve
from reunion.functions.similarity import batch_jaro_winkler, jaro_winkler
from reunion.operators.components import _stars, connected_components, large_star
from reunion.session import release, write_table, written_folders


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_rounds_over_many_partitions(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(900, 900 + i) for i in range(1, 80)] + [(rng.randrange(2000, 2150), rng.randrange(2000, 2150)) for _ in range(90)]
    edges = [e for e in edges if e[0] != e[1]]
    df = spark.createDataFrame(edges + [(3, 3)], "uid_l long, uid_r long")
    want = union_find(edges)
    for size in (10**6, 40):
        assert {r["node"]: r["root"] for r in connected_components(df, partition_edges=size).collect()} == want
    named = spark.createDataFrame([(f"k{a:05d}", f"k{b:05d}") for a, b in edges], "uid_l string, uid_r string")
    assert {r["node"]: r["root"] for r in connected_components(named).collect()} == {f"k{k:05d}": f"k{v:05d}" for k, v in want.items()}
    assert connected_components(df.limit(0)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=60))
def test_contraction(edges):
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    if not edges:
        return
    a, b = _stars(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))
    assert dict(zip(a.tolist(), b.tolist())) == {k: v for k, v in union_find(edges).items() if k != v}


def test_a_hub_is_split(spark):
    """The final plan of a round's join over a star shows AQE's skew split."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        star = spark.range(1, 300_000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b")).repartition(8)
        edges, _ = write_table(star, "t")
        low, _ = write_table(edges.selectExpr("b AS n", "b AS m").distinct().unionByName(edges.selectExpr("a AS n", "b AS m")), "t")
        out = large_star(edges, low)
        assert len(out.collect()) == 299_999
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_intermediates_are_deleted(spark):
    release(spark)
    df = spark.createDataFrame([(i, f"n{i % 5}", f"m{i % 3}") for i in range(30)], "id long, name string, mail string")
    cached = spark._jsc.sc().getPersistentRDDs().size()
    out = resolve(df, ["name", "mail"], id_col="id")
    rows = sorted(map(tuple, out.collect()))
    assert len(rows) == 30
    # links, the last edges, labels and ids are what the result still reads
    assert len(written_folders(spark)) <= 5
    assert spark._jsc.sc().getPersistentRDDs().size() == cached
    release(spark)
    assert written_folders(spark) == []


def test_persisted_inputs_are_released_on_errors(spark):
    from reunion import MatchError

    cached = spark._jsc.sc().getPersistentRDDs().size()
    with pytest.raises(MatchError):
        resolve(spark.createDataFrame([(1, "a"), (1, "b")], "id long, name string"), ["name"], id_col="id")
    assert spark._jsc.sc().getPersistentRDDs().size() == cached


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.none() | st.text("abcé", max_size=12), st.none() | st.text("abcé", max_size=12)), max_size=12))
def test_jaro_winkler_in_matrices(pairs):
    for encode in (True, False):
        got = batch_jaro_winkler([a for a, _ in pairs], [b for _, b in pairs], encode)
        for (a, b), x in zip(pairs, got.tolist()):
            if a is None or b is None:
                assert np.isnan(x)
            else:
                assert x == (jaro_winkler(a.encode(), b.encode()) if encode else jaro_winkler(a, b))


def test_registered_rounds_run(spark, monkeypatch):
    """The registered query takes several star rounds and gives what one partition gives."""
    from reunion.operators import components
    from reunion.plans.queries import QUERIES

    rounds = []
    star_round = components.star_round
    monkeypatch.setattr(components, "star_round", lambda e: rounds.append(1) or star_round(e))
    got = sorted(map(tuple, QUERIES["components_rounds"].spark(spark, "/root/testdata/sf0.01").collect()))
    assert len(rounds) >= 2
    assert got == sorted(map(tuple, QUERIES["connected_components"].spark(spark, "/root/testdata/sf0.01").collect()))


def test_small_partitions_share_tasks(spark):
    """Partitions of few edges are many; they are contracted by few tasks, each partition by itself."""
    from reunion.operators.components import contracted

    edges = spark.range(4000).selectExpr("id + 1 AS a", "id AS b")
    out = contracted(edges, 4000, 5)
    assert out.rdd.getNumPartitions() <= 8
    assert out.count() > 3000  # one partition of all would be a single star, too, but with one root
    assert out.select("b").distinct().count() > 400
