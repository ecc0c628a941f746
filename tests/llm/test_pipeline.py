from collections import defaultdict

import pytest

import corpus_pipeline
from reunion.llm.common import Scratch
from reunion.session import written_folders

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    scratch, docs = Scratch(spark), spark.read.parquet(f"{SF001}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, SF001), name.replace(" ", "-"))
        out.append((name, docs))
    return out


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in stages[1:]] == ["quality classifier", "SimHash near-dedup", "substring dedup", "personal data", "packing"]
    for _, df in stages[1:-1]:
        assert df.schema == stages[0][1].schema


def test_quality(spark, stages):
    before, after = rows_of(stages[0][1]), rows_of(stages[1][1])
    labels = spark.read.parquet(f"{SF001}/labels.parquet").collect()
    good = [r["doc_id"] in after for r in labels if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["doc_id"] in after for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)
    assert all(after[i] == before[i] for i in after)


def test_near_dedup(stages):
    from .test_simhash import expected

    before, after = rows_of(stages[1][1]), rows_of(stages[2][1])
    want = {c for _, _, c in expected([(i, r["text"]) for i, r in before.items()])}
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_substrings(stages):
    from .test_chunks import brute

    before, after = rows_of(stages[2][1]), rows_of(stages[3][1])
    want = {i: t for i, t, *_ in brute([(i, r["text"]) for i, r in before.items()])}
    assert {i: r["text"] for i, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_personal_data(stages):
    from .test_pii import plain

    before, after = rows_of(stages[3][1]), rows_of(stages[4][1])
    assert set(before) == set(after)
    assert not any(plain(r["text"]) for r in after.values())
    assert sum(bool(plain(r["text"])) for r in before.values()) > 0
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_packing(stages):
    from .test_packing import check_sequences

    docs, pieces = rows_of(stages[4][1]), stages[5][1].collect()
    check_sequences(pieces)
    tokens, total = defaultdict(int), {}
    for p in pieces:
        tokens[p["doc_id"]] += p["length"]
        total[p["doc_id"]] = p["doc_tokens"]
    assert set(tokens) == set(docs) and dict(tokens) == total


def test_run_and_empty(spark):
    before = set(written_folders(spark))
    assert corpus_pipeline.run(spark, SF001).count() > 0
    assert len(set(written_folders(spark)) - before) == 1  # the result alone
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.collect() == []
        if "start" not in docs.columns:
            docs = spark.createDataFrame([], docs.schema)
