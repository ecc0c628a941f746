"""Each stage alone: string similarity, levels, blocking, salting, components, ids."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reunion.functions.similarity import jaro_winkler
from reunion.model import Model
from reunion.operators import candidate_pairs, compare_pairs, connected_components, dense_ids
from reunion.operators.blocking import block_stats


def _rand_words(rng, n, alphabet="abcdeéèxy", lo=0, hi=8):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(lo, hi))) for _ in range(n)]


def test_jaro_winkler_matches_duckdb_bytes(duck):
    rng = random.Random(7)
    a, b = _rand_words(rng, 3000), _rand_words(rng, 3000)
    con = duck("/root/testdata/sf0.001")
    con.execute("CREATE TABLE p AS SELECT * FROM (SELECT unnest(?) AS a, unnest(?) AS b)", [a, b])
    want = [r[0] for r in con.execute("SELECT jaro_winkler_similarity(a, b) FROM p").fetchall()]
    got = [jaro_winkler(x.encode(), y.encode()) for x, y in zip(a, b)]
    assert max(abs(g - w) for g, w in zip(got, want)) < 1e-9


def test_jaro_winkler_known_values():
    assert jaro_winkler("martha", "marhta") == pytest.approx(0.9611111111111111)
    assert jaro_winkler("", "") == 0.0
    assert jaro_winkler(b"h\xc3\xa9llo", b"hello") == pytest.approx(0.84)


def test_levels_match_duckdb_on_documents(spark, duck):
    from tests.conftest import SF001

    from reunion.sources.fixtures import DOCUMENT_MODEL, DOCUMENT_TEXTS_SQL, document_texts

    m = DOCUMENT_MODEL
    slim = document_texts(spark, SF001).withColumnRenamed("doc_id", "uid")
    got = {
        (r["uid_l"], r["uid_r"]): tuple(r[f"{c}_level"] for c in m.columns)
        for r in compare_pairs(candidate_pairs(slim, [("text",), ("n_chars", "lang")], carry=m.columns), m).collect()
    }
    con = duck(SF001)
    pairs = ", ".join(f"levenshtein(l.{c}, r.{c}), l.{c} = r.{c}" for c in m.columns)
    sql = f"""
    WITH d AS ({DOCUMENT_TEXTS_SQL})
    SELECT l.doc_id, r.doc_id, {pairs}
    FROM d l JOIN d r ON l.doc_id < r.doc_id AND (l.text = r.text OR l.n_chars = r.n_chars AND l.lang = r.lang)"""

    def lvl(d, eq):
        return 3 if eq else 2 if d <= 1 else 1 if d <= 2 else 0

    want = {(x[0], x[1]): tuple(lvl(d, eq) for d, eq in zip(x[2::2], x[3::2])) for x in con.execute(sql).fetchall()}
    assert got == want and got


def test_blocking_each_pair_once_and_null_never_blocks(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", None), (4, None, None), (5, None, "x"), (6, "", "")]
    df = spark.createDataFrame(rows, "uid bigint, c1 string, c2 string")
    pairs = [(r["uid_l"], r["uid_r"], r["rule"]) for r in candidate_pairs(df, ["c1", "c2"]).collect()]
    assert sorted(pairs) == [(1, 2, 0), (1, 3, 0), (1, 5, 1), (2, 3, 0), (2, 5, 1)]


def test_salted_blocking_is_exact(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("aab"), rng.choice("xyzw")) for i in range(400)]
    df = spark.createDataFrame(rows, "uid bigint, c1 string, c2 string")
    plain = sorted(tuple(r) for r in candidate_pairs(df, ["c1", "c2"], block_split=None).collect())
    salted = sorted(tuple(r) for r in candidate_pairs(df, ["c1", "c2"], block_split=17).collect())
    assert plain == salted
    assert len(plain) == len(set(p[:2] for p in plain))


def test_block_stats(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, None)], "uid bigint, c string")
    r = block_stats(df, ["c"]).collect()[0]
    assert (r["records"], r["blocks"], r["largest_block"], r["pairs"]) == (4, 2, 3, 3)


def _union_find(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in range(n)}


@pytest.mark.parametrize("shape", ["random", "chain", "hub", "two_chains"])
def test_connected_components_match_union_find(spark, shape):
    rng = random.Random(11)
    n = 300
    if shape == "random":
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(250)]
    elif shape == "chain":
        order = list(range(n))
        rng.shuffle(order)
        edges = list(zip(order, order[1:]))[:50]
    elif shape == "hub":
        edges = [(17, i) for i in range(n) if i != 17]
    else:
        edges = [(i, i + 1) for i in range(0, 60)] + [(i + 1, i) for i in range(100, 160)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame(edges, "uid_l bigint, uid_r bigint")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    uf = _union_find(n, edges)
    nodes = {x for e in edges for x in e}
    assert got == {v: uf[v] for v in nodes}


def test_dense_ids_are_ranks(spark):
    vals = [5, 5, 9, 1, 100, 7, 7, 7]
    df = spark.createDataFrame([(v,) for v in vals], "root bigint")
    got = {r["root"]: r["cluster_id"] for r in dense_ids(df, "root", num_partitions=3).collect()}
    assert got == {1: "0", 5: "1", 7: "2", 9: "3", 100: "4"}


def test_udf_runs_where_workers_cannot_import_the_package():
    """Executors need not have the package installed: the UDF ships its own code."""
    import os
    import subprocess
    import sys
    import tempfile

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from reunion.functions.similarity import jaro_winkler_udf
df = spark.createDataFrame([("martha", "marhta")], "a string, b string")
print("JW", round(df.select(jaro_winkler_udf(df.a, df.b)).collect()[0][0], 6))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", script], cwd=tempfile.mkdtemp(prefix="reunion-cwd-", dir="/tmp"), env=env,
        capture_output=True, text=True, timeout=300,
    )
    assert "JW 0.961111" in out.stdout, out.stderr[-2000:]
