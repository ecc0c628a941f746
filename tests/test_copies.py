"""Links by way of profiles: components and best probabilities as by all pairs of records, without pairs of copies."""

from __future__ import annotations

import random
from itertools import product

from pyspark.sql import functions as F

from reunion.constants import PROB_COL
from reunion.operators.clusters import best_match_probability, copy_profiles, member_links, member_pairs
from reunion.operators.components import connected_components
from reunion.plans.queries import EDITED, _levels, _links, _member_links, _record_pairs, q_edit_levels, q_linked_pairs
from reunion.plans.resolve import copies_probability


def _near_texts(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdef ") for _ in range(40)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = rng.choice(base)
        if rng.random() < 0.4:
            at = rng.randrange(len(t))
            t = t[:at] + rng.choice("xyz") + t[at + rng.randrange(2):]
        text = None if rng.random() < 0.05 else t
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["web", "book"]), str(len(t))))
    return rows


def _results(links):
    nodes = sorted(map(tuple, connected_components(links).select("node", "root").collect()))
    return nodes, sorted((r.uid, r.best) for r in best_match_probability(links).collect())


def test_member_links_give_what_all_pairs_give(spark):
    rows = _near_texts(150, 4)
    rows += [(1000, "q" * 30, "en", "web", "30")] * 2  # one record twice is no pair
    df = spark.createDataFrame(rows, "uid bigint, text string, lang string, source string, n_chars string")
    every = _links(EDITED, df)
    profiles, members = copy_profiles(df, EDITED.model.all_columns)
    links = _links(EDITED, profiles.drop("lo", "hi").withColumnRenamed("pid", "uid"))
    few = member_links(links, profiles, members, copies_probability(EDITED.model), EDITED.threshold)
    assert _results(few) == _results(every)
    pairs = {(r.uid_l, r.uid_r): r[PROB_COL] for r in every.collect()}
    assert all(pairs[r.uid_l, r.uid_r] == r[PROB_COL] for r in few.collect())


def test_repeated_ids(spark):
    # uid 1 holds both texts, 2 and 3 one of them each; 9 holds two near texts alone
    a, b = "abcdefghij klmnop", "abcdefghij klmnoq"
    rows = [(1, a), (1, b), (2, a), (3, b), (9, "zzzzzzzzzzzzzzzz"), (9, "zzzzzzzzzzzzzzzy"), (None, a)]
    df = spark.createDataFrame([(i, t, "en", "web", "17") for i, t in rows], "uid bigint, text string, lang string, source string, n_chars string")
    profiles, members = copy_profiles(df, EDITED.model.all_columns)
    assert profiles.count() == 4 and profiles.select("pid").distinct().count() == 4
    links = _links(EDITED, profiles.drop("lo", "hi").withColumnRenamed("pid", "uid"))
    few = member_links(links, profiles, members, copies_probability(EDITED.model), 0.0)
    assert {(r.uid_l, r.uid_r) for r in few.collect()} == {(1, 2), (1, 3)}
    assert {r.node: r.root for r in connected_components(few).collect()} == {1: 1, 2: 1, 3: 1}


def test_copies_are_not_made_into_pairs(spark, tmp_path):
    n = 300
    docs = spark.range(1, n + 1).select(F.col("id").alias("doc_id"), F.lit("the same short text here").alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit(24).alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = EDITED.rows(spark, str(tmp_path)).count()
    links = _member_links(EDITED, spark, str(tmp_path))
    assert links.count() <= 8 * rows < n * n // 4
    assert links.select(F.explode(F.array("uid_l", "uid_r"))).distinct().count() == rows


def test_record_pairs_are_all_pairs(spark):
    rows = _near_texts(150, 4)
    rows += [(1000, "q" * 30, "en", "web", "30")] * 2 + [(1001, "q" * 30, "en", "web", "30"), (1002, "q" * 29, None, "web", "29"), (None, "q" * 30, "en", "web", "30")]
    df = spark.createDataFrame(rows, "uid bigint, text string, lang string, source string, n_chars string")
    columns = ["uid_l", "uid_r", *[f"{c}_level" for c in EDITED.columns]]
    found = sorted(map(tuple, _record_pairs(EDITED, df, lambda levels: levels).select(columns).collect()))
    assert found == sorted(map(tuple, _levels(EDITED, df).select(columns).collect()))
    assert sum(f[:2] == (1000, 1001) for f in found) == 2


def test_member_pairs_of_several_runs(spark):
    members = spark.createDataFrame([(i, i % 3) for i in range(30)], "uid bigint, pid bigint")
    pairs = spark.createDataFrame([(0, 0, "a"), (1, 0, "b"), (2, 2, "c")], "uid_l bigint, uid_r bigint, v string")
    found = sorted(map(tuple, member_pairs(pairs, members, run=2).collect()))
    of = [range(p, 30, 3) for p in range(3)]
    wanted = [(x, y, v) for l, r, v in ((0, 0, "a"), (2, 2, "c")) for x, y in product(of[l], of[r]) if x < y]
    assert found == sorted(wanted + [(min(x, y), max(x, y), "b") for x, y in product(of[1], of[0])])


def test_record_pairs_carry_no_values(spark, tmp_path):
    docs = spark.range(1, 301).selectExpr("id AS doc_id", "concat('the same short text ', id div 100) AS text", "'en' AS lang", "'web' AS source", "22 AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for query in (q_edit_levels, q_linked_pairs):
        pairs = query(spark, str(tmp_path))
        plan = pairs._jdf.queryExecution().optimizedPlan().toString()
        assert "levenshtein" not in plan and "text#" not in plan  # pairs of records are made from ids alone
        assert pairs.select("uid_l", "uid_r").distinct().count() == pairs.count() >= 300 * 99 // 2
