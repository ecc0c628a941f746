import math
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reunion.llm.dsir import EVIDENCE, FEATURES, LEAST_ODDS, PUNCTUATION, SHARPNESS, Resampler, features, gumbel, kth_largest, quality_classes

from .util import odd_documents, odd_texts, prose

SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


def label_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def junk(i):
    return " ".join(f"{w}!!" for w in prose(i, 60).upper().split())


def test_weights_and_choice(spark):
    rows = [(i, prose(i, 80)) for i in range(60)] + [(100 + i, junk(i)) for i in range(20)]
    labels = label_frame(spark, [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(10)] + [(5, None, 0), (None, 1, 0), (999, 1, 0)])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in quality_classes(docs, labels).collect()}
    counts = [np.zeros(FEATURES), np.zeros(FEATURES)]
    for i, t in rows:
        f = np.bincount(features(t.encode(), {}), minlength=FEATURES)
        counts[0] += f
        counts[1] += f * (i < 30)
    p = [(c + 1) / (c + 1).sum() for c in counts]
    for i, t in rows:
        f = features(t.encode(), {})
        assert math.isclose(got[i]["weight"], SHARPNESS * float(np.log(p[1][f] / p[0][f]).mean()), rel_tol=1e-9)
    assert sum(r["kept"] for r in got.values()) == 60  # three quarters of 80
    assert sorted(got, key=lambda i: -got[i]["key"])[:60] == sorted((i for i in got if got[i]["kept"]), key=lambda i: -got[i]["key"])
    assert all(got[i]["kept"] for i in range(60))


def test_held_out_labels(spark):
    """Fitted on half of the labels, the classifier keeps the other half's good documents and rejects its bad ones."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    kept = {r["doc_id"]: r["kept"] for r in quality_classes(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    good = [kept[r["doc_id"]] for r in held if r["quality"] == 1 and r["toxic"] == 0]
    bad = [kept[r["doc_id"]] for r in held if r["quality"] == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.15


def test_held_out_toxic_documents(spark):
    """Toxic documents go, those of good quality too, and the clean ones stay."""
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    kept = {r["doc_id"]: r["kept"] for r in quality_classes(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    clean = [kept[r["doc_id"]] for r in held if r["quality"] == 1 and r["toxic"] == 0]
    toxic = [kept[r["doc_id"]] for r in held if r["quality"] == 1 and r["toxic"] == 1]
    bad = [kept[r["doc_id"]] for r in held if r["quality"] == 0]
    assert len(toxic) > 100 and np.mean(toxic) < 0.2 and np.mean(clean) > 0.95 and np.mean(bad) < 0.15


def test_odd_rows(spark):
    labels = label_frame(spark, [(4, 1, 0), (15, 0, 0), (5, 1, 0), (5, 0, 1)])
    docs = odd_documents(spark)
    got = quality_classes(docs, labels).collect()
    assert len(got) == len(odd_texts())
    model = Resampler(docs, labels)
    kept = model.kept(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in model.verdicts().collect() if r["kept"])
    none = label_frame(spark, [])
    assert all(r["kept"] for r in quality_classes(docs, none).collect())  # nothing to tell by
    assert quality_classes(odd_documents(spark, empty=True), labels).collect() == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(2**62), 2**62) | st.integers(-3, 3), min_size=1, max_size=30), st.integers(1, 30))
def test_kth_largest(spark, values, k):
    df = spark.createDataFrame([(v,) for v in values], "order long")
    got = kth_largest(df, "order", k)
    assert got == (sorted(values, reverse=True)[k - 1] if k <= len(values) else None)


def plain_marks(rows, target):
    """Log odds of word buckets that mark labelled texts outside the target, from the definition; ``target`` has the labelled ids."""
    with_word, size = [Counter(), Counter()], [0, 0]
    for i, t in rows:
        if i in target:
            size[target[i]] += 1
            with_word[target[i]].update(word_buckets(t))
    n, m = size
    out = {}
    for b, x in with_word[0].items():
        y = with_word[1][b]
        odds = math.log(x / n) - math.log((y + 1) / (m + 1))
        evidence = x * math.log(x / (x + y) * (n + m) / n) + (y * math.log(y / (x + y) * (n + m) / m) if y else 0.0)
        if odds >= LEAST_ODDS and evidence >= EVIDENCE:
            out[b] = odds
    return out


def word_buckets(t):
    return {xxhash.xxh64_intdigest(w.strip(PUNCTUATION)) >> 46 for w in t.encode().lower().split()}


def test_keys_and_number_kept(spark):
    """Key = weight - marks + noise for every document, and exactly the k largest keys are kept."""
    bad = "wretched"
    rows = [(i, prose(i, 60 + i % 9) + (f" {bad}!" if i % 4 == 0 else "")) for i in range(120)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(80)]
    target = {i: int(not x) for i, _, x in labels}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in quality_classes(docs, label_frame(spark, labels)).collect()}
    noise = {r["doc_id"]: r["g"] for r in docs.select("doc_id", gumbel(F.lit(1), F.col("doc_id").cast("string"), F.col("text")).alias("g")).collect()}
    marks = plain_marks(rows, target)
    assert set(marks) >= word_buckets(bad)
    for i, t in rows:
        against = SHARPNESS * sum(marks.get(b, 0.0) for b in word_buckets(t))
        assert math.isclose(got[i]["key"], got[i]["weight"] - against + noise[i], rel_tol=1e-9, abs_tol=1e-9)
    k = math.ceil(sum(target.values()) / len(target) * len(rows))
    order = sorted(got, key=lambda i: -got[i]["key"])
    assert {i for i in got if got[i]["kept"]} == set(order[:k])
    assert not any(got[i]["kept"] for i in got if i % 4 == 0)
