import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reunion.llm.queries import QUERIES
from reunion.llm.rtree import PackedTree, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, ID string, tops string"


def brute(rows, is_anchor, positives=5, negatives=5, percent=80, scale=256):
    rows = [r for r in dict.fromkeys((i, None if v is None else tuple(v), y) for i, v, y in rows) if r[0] is not None and r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = [(i, [math.floor(scale * float(x)) for x in v], y) for i, v, y in rows]
    out = []
    for ai, av, ay in rows:
        if not is_anchor(ai):
            continue
        scored = sorted(((-sum(x * z for x, z in zip(av, v)), i, y) for i, v, y in rows if i != ai and len(v) == len(av)))
        for s, p, _ in [x for x in scored if x[2] == ay][:positives]:
            hits = [(i, n) for n, i, y in scored if y != ay and percent * -s <= 100 * -n <= 100 * -s][:negatives]
            out += [(ai, p, k + 1, i, -s, -n) for k, (i, n) in enumerate(hits)]
    return sorted(out)


def mined(spark, rows, parts=4, every=3, **options):
    df = spark.createDataFrame([(i, v, y, "x", "y") for i, v, y in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hard_negatives(df.where(f"vec_id % {every} = 0"), df, **options).collect())


def f32(values):
    return [None if x is None else float(np.float32(x)) for x in values]


def test_odd_rows(spark):
    rng = random.Random(2)
    vec = lambda: f32(rng.choice([-0.5, -0.25, 0.0, 0.125, 0.25, 0.5]) for _ in range(3))
    rows = [(i, vec(), rng.randrange(3)) for i in range(120)]
    same = f32([0.5, 0.25, -0.25])
    rows += [(200 + i, same, i % 2) for i in range(90)]  # copies beyond any k, ties by id
    rows += [(300, None, 1), (303, [], 1), (306, f32([0.5, None, 0.1]), 1), (309, [float("nan"), 0.0, 1.0], 1), (312, [float("inf"), 0.0, 1.0], 1), (315, f32([0.1, 0.1, 0.1]), None)]
    rows += [(None, vec(), 1), (318, [0.0, 0.0, 0.0], 1), (321, f32([0.5, 0.5]), 1), (324, f32([0.5, 0.4]), 2), (327, f32([0.6, 0.4]), 1)]
    rows += [rows[3], rows[3], (6, vec(), 2)]  # a row again, and an id again with another vector
    want = brute(rows, lambda i: i % 3 == 0)
    assert len(want) > 500
    assert mined(spark, rows) == want
    assert mined(spark, rows, parts=7, shard_bytes=1000, leaf=4, fanout=2) == want
    assert mined(spark, []) == []


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, f32(rng.uniform(-2e5, 2e5) for _ in range(4)), i % 2) for i in range(60)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 3 == 0)
    with pytest.raises(Exception, match="(?i)overflow|too large|large"):
        mined(spark, [(3 * i, [1e20, 1e20], i % 2) for i in range(6)])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 6), st.integers(1, 9), st.integers(2, 5), st.integers(0, 10**6))
def test_tree_holds_every_row_in_its_boxes(n, dim, leaf, fanout, seed):
    rng = np.random.default_rng(seed)
    m = np.floor(rng.normal(0, 4, (n, dim)))
    tree = PackedTree(m, leaf, fanout)
    assert sorted(tree.order.tolist()) == list(range(n))
    assert max(np.diff(tree.cuts)) <= leaf
    q = np.floor(rng.normal(0, 4, (5, dim)))
    least, most = tree.bounds(q)

    def rows_of(node):
        if node < tree.leaves:
            return set(tree.order[tree.cuts[node] : tree.cuts[node + 1]].tolist())
        a, b = tree.child[node]
        return set().union(*(rows_of(c) for c in range(a, b)))

    assert rows_of(len(tree.child) - 1) == set(range(n))
    for node in range(len(tree.child)):
        score = q @ m[sorted(rows_of(node))].T
        assert (least[:, node] <= score.min(axis=1)).all() and (score.max(axis=1) <= most[:, node]).all()


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    e = spark.read.parquet(f"{path}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], None if r["label"] is None else (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in e.collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, path).collect())
    assert got == brute(rows, lambda i: i % 100 == 0)
    assert e.where(F.col("vec_id") % 100 == 0).count() >= len({g[0] for g in got}) > 0
