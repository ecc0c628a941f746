"""Spanning forests, kept components and entities, one-to-one matching, pairs of rule unions: against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reunion import MatchError, Model, resolve
from reunion.model import Comparison
from reunion.operators.components import extend_components
from reunion.operators.matching import one_to_one
from reunion.operators.spanning import entity_counts, forest_edges, maximum_spanning_forest
from reunion.operators.training import estimate_prior_of_rules, signed_column_sets, train_model, union_pair_counts
from reunion.plans.incremental import KeptEntities
from reunion.plans.queries import PLANTED
from reunion.plans.queries_links import THRESHOLDS, q_entities_by_threshold
from reunion.plans.score import match_records

from test_components import union_find  # noqa: E402


def kruskal(edges):
    """The forest of edges (a, b, p): best first, ties by ends."""
    best = {}
    for a, b, p in edges:
        if a != b:
            key = (min(a, b), max(a, b))
            best[key] = max(p, best.get(key, p))
    parent, out = {}, set()

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), p in sorted(best.items(), key=lambda e: (-e[1], e[0])):
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            out.add((a, b, p))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12), st.sampled_from([0.5, 0.7, 0.9])), min_size=1, max_size=40))
def test_forest_of_a_partition(edges):
    edges = sorted({(min(a, b), max(a, b), p) for a, b, p in edges if a != b}, key=lambda e: (-e[2], e[0], e[1]))
    if not edges:
        return
    keep = forest_edges(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))
    assert {e for e, k in zip(edges, keep.tolist()) if k} == kruskal(edges)


def test_forest_over_rounds_and_counts(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(120), rng.randrange(120), rng.choice([0.5, 0.6, 0.75, 0.9, 1.0])) for _ in range(400)]
    edges += [(500 + i, 501 + i, 0.8) for i in range(60)] + [(3, 3, 0.9)]
    df = spark.createDataFrame(edges, "uid_l int, uid_r int, match_probability double").repartition(5)
    want = kruskal(edges)
    for size in (10**6, 30):
        forest = maximum_spanning_forest(df, partition_edges=size)
        assert dict(forest.dtypes)["uid_l"] == "int"
        assert sorted(map(tuple, forest.collect())) == sorted(want)
    thresholds = [0.5, 0.7, 0.9, 1.0]
    got = {r["threshold"]: r["entities"] for r in entity_counts(forest, spark.range(1000), thresholds).collect()}
    for t in thresholds:
        roots = union_find([(a, b) for a, b, p in edges if p >= t and a != b])
        assert got[t] == 1000 - len(roots) + len(set(roots.values()))
    named = df.selectExpr("format_string('k%05d', uid_l) AS x", "format_string('k%05d', uid_r) AS y", "match_probability AS w")
    got = sorted(map(tuple, maximum_spanning_forest(named, "x", "y", "w", partition_edges=30).collect()))
    assert got == sorted((f"k{a:05d}", f"k{b:05d}", p) for a, b, p in want)


def test_entities_at_every_threshold(spark, tmp_path):
    rows = [(k, "BUILDING" if k % 3 else None) for k in range(1, 71)] + [(997 + k, "MACHINERY") for k in range(1, 30)]
    spark.createDataFrame(rows, "c_custkey long, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    got = {r["threshold"]: r["entities"] for r in q_entities_by_threshold(spark, str(tmp_path)).collect()}
    want = {t: PLANTED.resolved(spark, str(tmp_path), t).select("cluster_id").distinct().count() for t in THRESHOLDS}
    assert got == want and len(set(want.values())) > 1


def test_forest_of_no_links(spark):
    none = spark.createDataFrame([], "uid_l long, uid_r long, match_probability double")
    forest = maximum_spanning_forest(none)
    assert forest.collect() == []
    assert [tuple(r) for r in entity_counts(forest, spark.range(3), [0.5]).collect()] == [(0.5, 3)]
    loops = spark.createDataFrame([(1, 1, 0.9), (1, 2, None)], "uid_l long, uid_r long, match_probability double")
    assert maximum_spanning_forest(loops).collect() == []


def test_components_grow_by_batches(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(20)]
    edges = [e for e in edges if e[0] != e[1]]
    rng.shuffle(edges)
    kept = spark.createDataFrame([], "node long, root long")
    for s in range(0, len(edges), 25):
        kept = extend_components(kept, spark.createDataFrame(edges[s : s + 25], "uid_l long, uid_r long"), partition_edges=10)
        assert {r["node"]: r["root"] for r in kept.collect()} == union_find(edges[: s + 25])
    same = extend_components(kept, spark.createDataFrame([], "uid_l long, uid_r long"))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, kept.collect()))


def customers(spark):
    """Records with copies, NULLs, near values and values that chain over the batches."""
    rng = random.Random(5)
    names = ["anna", "anne", "bernd", "berndt", "clara", None]
    rows = [(i, rng.choice(names), f"city{rng.randrange(12)}" if rng.random() < 0.9 else None, f"k{i % 2}") for i in range(90)]
    rows += [(200 + i, "hot", "hot", "k0") for i in range(40)]
    return spark.createDataFrame(rows, "id long, name string, city string, region string")


@pytest.mark.parametrize("within, threshold", [([], 0.3), (["region"], 0.9)])
def test_kept_entities_equal_one_resolve(spark, within, threshold):
    df = customers(spark)
    model = Model.default(["name", "city"], 0.2)
    kept = KeptEntities(model, id_col="id", threshold=threshold, within=within, block_split=7)
    for k in (2, 0, 1):  # smaller ids may come later
        kept.add(df.where(f"id % 3 = {k}"))
    kept.add(df.limit(0))
    got = {r["id"]: (r["entity"], round(r["match_probability"], 12)) for r in kept.entities().collect()}
    whole = resolve(df, model=model, id_col="id", threshold=threshold, within=within).collect()
    first = {}
    for r in whole:
        first[r["cluster_id"]] = min(r["id"], first.get(r["cluster_id"], r["id"]))
    assert got == {r["id"]: (first[r["cluster_id"]], round(r["match_probability"], 12)) for r in whole}
    assert len(set(first.values())) < len(whole)


def test_kept_entities_refuse(spark):
    df = customers(spark)
    model = Model.default(["name", "city"])
    kept = KeptEntities(model.to_json(), id_col="id")
    with pytest.raises(MatchError, match="no records"):
        kept.entities()
    kept.add(df.where("id < 50"))
    before = sorted(map(tuple, kept.entities().collect()))
    with pytest.raises(MatchError, match="unique over all batches"):
        kept.add(df.where("id >= 40"))
    assert sorted(map(tuple, kept.entities().collect())) == before
    with pytest.raises(MatchError):
        kept.add(df.drop("name"))
    near = Model(0.1, (Comparison("name", "edit", (1.0, 2.0), (0.1, 0.1, 0.1, 0.7), (0.7, 0.1, 0.1, 0.1)),), near=(("name", 1),))
    with pytest.raises(MatchError, match="near values"):
        KeptEntities(near, id_col="id")


def greedy(links):
    best = {}
    for a, b, p in links:
        if a is not None and b is not None and p is not None:
            best[a, b] = max(p, best.get((a, b), p))
    left, right, out = set(), set(), []
    for (a, b), p in sorted(best.items(), key=lambda e: (-e[1], e[0])):
        if a not in left and b not in right:
            left.add(a)
            right.add(b)
            out.append((a, b, p))
    return sorted(out)


def test_matching(spark):
    rng = random.Random(3)
    links = [(rng.randrange(40), rng.randrange(40), rng.choice([0.5, 0.5, 0.8, 0.9])) for _ in range(300)]
    links += [(1000, 2000 + i, 0.9) for i in range(50)]  # a hub
    links += [(3000 + i, 3000 + i + d, 0.7) for i in range(12) for d in (0, 1)]  # a chain of ties
    links += [(None, 1, 0.9), (1, None, 0.9), (1, 1, None), links[0]]
    df = spark.createDataFrame(links, "uid_l long, uid_r long, match_probability double").repartition(4)
    for size in (10**6, 30):
        assert sorted(map(tuple, one_to_one(df, task_links=size).collect())) == greedy(links)
    named = df.selectExpr("CAST(uid_l AS STRING) AS x", "uid_r AS y", "match_probability AS w")
    texts = [(None if a is None else str(a), b, p) for a, b, p in links]
    assert sorted(map(tuple, one_to_one(named, "x", "y", "w", task_links=50).collect())) == greedy(texts)
    assert one_to_one(df.limit(0)).collect() == []


def test_match_records_gives_each_known_record_once(spark):
    known = spark.createDataFrame([(1, "anna", "rome"), (2, "anna", "rome"), (3, "bob", "oslo")], "kid long, name string, city string")
    new = spark.createDataFrame(
        [(10, "anna", "rome", "x"), (11, "anna", "rome", "y"), (12, "anna", "rome", "z"), (13, "bob", None, "w"), (14, None, None, None)],
        "nid long, name string, city string, match_id string",
    )
    out = match_records(new, known, Model.default(["name", "city"], 0.5), new_id="nid", known_id="kid", threshold=0.5)
    assert out.columns == ["nid", "name", "city", "match_id", "match_probability"]
    assert {r["nid"]: r["match_id"] for r in out.collect()} == {10: 1, 11: 2, 12: None, 13: 3, 14: None}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=3), min_size=1, max_size=4))
def test_signed_sets_count_every_pair_once(rules):
    sets = signed_column_sets(rules)
    for k in range(4):
        for agree in combinations("abc", k):
            got = sum(n for columns, n in sets.items() if set(columns) <= set(agree))
            assert got == int(any(set(r) <= set(agree) for r in rules))


def test_pairs_of_a_union_of_rules(spark):
    rng = random.Random(9)
    rows = [tuple(rng.choice(["x", "y", "z", None]) for _ in range(3)) for _ in range(70)] + [("hot", "hot", "hot")] * 30
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a string, b string, `c.d` string")
    rules = [("a", "b"), ("c.d",), ("b", "c.d"), ("a", "c.d")]
    at = {"a": 0, "b": 1, "c.d": 2}
    want = sum(any(all(x[at[c]] is not None and x[at[c]] == y[at[c]] for c in r) for r in rules) for x, y in combinations(rows, 2))
    found = union_pair_counts(df, rules).collect()[0]
    assert (int(found["records"]), int(found["pairs"])) == (100, want)
    assert estimate_prior_of_rules(df, rules) == pytest.approx(min(want / 0.7 / 4950, 1.0))
    assert estimate_prior_of_rules(df.limit(0), rules) is None
    assert estimate_prior_of_rules(df.where("a IS NULL"), ["a"]) is None
    trained = train_model(df, Model.default(["a", "b"]), id_col="id", prior_rules=[("a", "b")])
    assert "prior:rules" in trained.trained
    with pytest.raises(ValueError):
        union_pair_counts(df, [])
