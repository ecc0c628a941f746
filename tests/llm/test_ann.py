import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from reunion.llm.ann import nearest, quantise, tile_search
from reunion.llm.queries import op2_nearest_neighbours

SF001 = "/root/testdata/sf0.001"


def brute(queries, rows, k):
    rows = {(i, tuple(v)) for i, v in rows}
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in queries}):
        scored = sorted(((-float(np.cumsum(np.array(v) * np.array(w))[-1]), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def usable(rows):
    return [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]


def test_whole_table_is_exact(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    want = brute([r for r in usable(rows) if r[0] % 20 == 0], usable(rows), 20)
    got = sorted(map(tuple, op2_nearest_neighbours(spark, SF001).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def test_odd_vectors_copies_and_blocks(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(4)]) for i in range(120)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(200, 260)]  # a common vector
    rows += [(200, [1.0, 1.0, 1.0, 1.0])]  # a repeated row
    odd = [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 1.0, 1.0]), (304, [float("nan"), 1.0, 1.0, 1.0]), (305, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (400, [1.0, 2.0]), (420, [3.0, 2.0]), (440, [1.0, 1.0, 5.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows + odd], "vec_id long, embedding array<double>, vec string, dim string").repartition(4)
    got = sorted(map(tuple, nearest(df.where("vec_id % 20 = 0"), df, k=7, query_block=5, candidate_block=16).collect()))
    want = brute([r for r in usable(rows + odd) if r[0] % 20 == 0], usable(rows + odd), 7)
    assert got == want
    assert not [g for g in got if g[0] == 440]  # nothing of its length
    none = df.limit(0)
    assert nearest(none, none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 9), st.sampled_from([1e-30, 1e-3, 1.0, 1e150]))
def test_bounds_hold(seed, dim, scale):
    rng = np.random.default_rng(seed)
    q, c = rng.normal(size=(3, dim)) * scale, rng.normal(size=(40, dim))
    qc, qs, qn, qe = quantise(q)
    cc, cs, cn, ce = quantise(c)
    near = (qc.astype(float) @ cc.T.astype(float)) * qs[:, None] * cs
    slack = qe[:, None] * (cn + ce) + qn[:, None] * ce + 1e-9 * (qn + qe)[:, None] * (cn + ce)
    assert (np.abs(near - q @ c.T) <= slack).all()
    got = sorted(tile_search(np.arange(3), q, np.arange(100, 140), c, 5))
    for i in range(3):
        s = np.cumsum(q[i] * c, axis=1)[:, -1]
        want = sorted((100 + int(j), float(s[j])) for j in np.lexsort((np.arange(40), -s))[:5])
        assert sorted((v, x) for a, v, x in got if a == i) == want
