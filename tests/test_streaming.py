"""Scoring a stream of new records gives the batch result; resolve rejects streams."""

from __future__ import annotations

import os
import tempfile

import pytest

from reunion import MatchError, resolve
from reunion.plans.queries import PLANTED
from reunion.plans.score import score_records
from reunion.sources.fixtures import new_customers
from reunion.streaming import score_stream, score_stream_to
from tests.conftest import SF001


def test_stream_equals_batch(spark):
    new = new_customers(spark, SF001)
    known = PLANTED.rows(spark, SF001)
    batch = {tuple(r) for r in score_records(new, known, PLANTED.model, new_id="new_id", known_id="record_id").collect()}

    src = tempfile.mkdtemp(prefix="reunion-stream-src-", dir="/tmp")
    new.repartition(4).write.mode("append").parquet(src)
    stream = spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 1).parquet(src)
    seen: list = []
    query = score_stream(
        stream, known, PLANTED.model, new_id="new_id", known_id="record_id",
        sink=lambda df, epoch: seen.extend(tuple(r) for r in df.collect()),
        checkpoint_location=tempfile.mkdtemp(prefix="reunion-stream-ckpt-", dir="/tmp"),
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(seen) == len(batch)
    assert set(seen) == batch
    assert any(r[-2] is not None for r in seen)


def test_resolve_rejects_stream(spark):
    src = tempfile.mkdtemp(prefix="reunion-stream-src-", dir="/tmp")
    new_customers(spark, SF001).write.mode("append").parquet(src)
    stream = spark.readStream.schema(new_customers(spark, SF001).schema).parquet(src)
    with pytest.raises(MatchError, match="batch"):
        resolve(stream, ["first_name"])


def test_salted_scoring_is_exact(spark):
    from reunion.model import Model

    known = spark.createDataFrame(
        [(i, "smith" if i % 3 else "jones", f"e{i % 7}") for i in range(90)], "kid bigint, last_name string, email string"
    )
    new = spark.createDataFrame(
        [(100 + i, "smith" if i % 2 else "jonez", f"e{i % 5}") for i in range(20)], "nid bigint, last_name string, email string"
    )
    m = Model.default(["last_name", "email"])
    plain = sorted(tuple(r) for r in score_records(new, known, m, new_id="nid", known_id="kid", block_split=None).collect())
    salted = sorted(tuple(r) for r in score_records(new, known, m, new_id="nid", known_id="kid", block_split=7).collect())
    assert plain == salted
    assert any(r[-2] is not None for r in plain)


def test_restart_keeps_each_batch_once(spark):
    """A stream that ends after some files goes on from its checkpoint; a batch that is run again replaces its folder."""
    new = new_customers(spark, SF001)
    known = PLANTED.rows(spark, SF001)
    src, out, ckpt = (tempfile.mkdtemp(prefix=f"reunion-stream-{x}-", dir="/tmp") for x in ("src", "out", "ckpt"))

    def run():
        stream = spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 1).parquet(src)
        query = score_stream_to(stream, known, PLANTED.model, out, new_id="new_id", known_id="record_id", checkpoint_location=ckpt, trigger={"availableNow": True}, block_split=3)
        query.awaitTermination()

    new.where("new_id % 2 = 0").repartition(2).write.mode("append").parquet(src)
    run()
    new.where("new_id % 2 = 1").repartition(2).write.mode("append").parquet(src)
    commits = sorted(x for x in os.listdir(f"{ckpt}/commits") if x.isdigit())
    os.remove(f"{ckpt}/commits/{commits[-1]}")  # as if the driver died after the sink, before the commit
    crc = f"{ckpt}/commits/.{commits[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run()
    want = sorted(map(str, score_records(new, known, PLANTED.model, new_id="new_id", known_id="record_id").collect()))
    assert sorted(map(str, spark.read.parquet(out).drop("batch").collect())) == want
