"""Quality classifier by importance resampling over hashed n-gram models.

Two generative models over hashed word uni- and bigrams are counted from all documents: the
target (documents that the labels call good and not toxic) and the raw corpus (all documents).
A document's log importance weight is the log ratio of the two models over its n-grams.
Documents are resampled without replacement by Gumbel top-k: weight plus Gumbel noise, which
a hash of id and text draws, and the k largest are kept. k is the share of the target class (good and
not toxic) among the labelled ones, times all documents. The k-th key is found exactly by counting the
keys' bit prefixes, 16 bits a round, so nothing is sorted or gathered.

The weight is per n-gram (an average times ``SHARPNESS``), as sums over texts of 1 to 20,000
words would rank by length. An average hides a few insults in a long text, so words that mark the labelled
documents outside the target (``mark_odds``) count apart: each distinct one lowers the key
by its log odds times ``SHARPNESS``, as if the text were made of it.

Results for odd input: a null text counts as empty, and a text without words has weight zero; labels with
null values or unknown ids are ignored, and a document labelled more than once is good only if
every label says so; without good labels both models are equal and every document is kept; rows with equal
keys at the threshold (repeated rows) are all kept; null ids keep their rows; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_batches, picked, utf8, worker_state

#: Hash buckets of the n-gram models.
FEATURES = 1 << 16
#: Pseudo-count of a bucket.
SMOOTHING = 1.0
SHARPNESS = 200.0
#: Hash buckets of words that mark documents outside the target.
MARKS = 1 << 18
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Such a word's least log-likelihood ratio against equal shares of both classes, and least log odds.
EVIDENCE = 8.0
LEAST_ODDS = 3.0
#: Word hashes kept in a worker's memory before it starts anew.
MEMORY = 500_000


def _hashes() -> dict[bytes, int]:
    return {}


def features(text: bytes, memory: dict[bytes, int]) -> np.ndarray:
    """Buckets of a text's words (A-Z lowered) and of its word pairs, repeats included."""
    import xxhash

    words = text.lower().split()
    for w in set(words).difference(memory):
        memory[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        mixed = np.concatenate([h, pairs ^ (pairs >> np.uint64(31))])
    return (mixed % np.uint64(FEATURES)).astype(np.int64)


def count_models(docs: DataFrame) -> np.ndarray:
    """``(2, FEATURES)``: n-gram counts of all texts and of those with ``target`` set; a task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = worker_state("dsir", _hashes)
        counts = np.zeros((2, FEATURES), np.int64)
        for b in batches:
            if len(memory) > MEMORY:
                memory.clear()
            target = b.column("target").to_pylist()
            for t, good in zip(utf8(b.column("text")), target):
                c = np.bincount(features(t, memory), minlength=FEATURES)
                counts[0] += c
                if good:
                    counts[1] += c
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])], ["bucket", "raw", "good"])

    # FEATURES rows at most
    total = map_batches(docs, run, T._parse_datatype_string("bucket long, raw long, good long")).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toPandas()
    out = np.zeros((2, FEATURES))
    out[0, total.bucket] = total.raw
    out[1, total.bucket] = total.good
    return out


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """log of target over raw probability of each bucket."""
    if not counts[1].any():
        return np.zeros(FEATURES)
    p = counts + SMOOTHING
    return np.log(p[1] / p[1].sum()) - np.log(p[0] / p[0].sum())


def _mark_buckets(text: bytes, memory: dict[bytes, int]) -> np.ndarray:
    """Buckets of a text's distinct words, without the punctuation around them."""
    import xxhash

    words = {w.strip(PUNCTUATION) for w in set(text.lower().split())}
    for w in words.difference(memory):
        memory[w] = xxhash.xxh64_intdigest(w)
    return np.unique(np.fromiter(map(memory.__getitem__, words), np.uint64, len(words)) >> np.uint64(46)).astype(np.int64)


def mark_odds(labelled: DataFrame) -> np.ndarray:
    """Per word bucket the log odds of a document outside the target, 0 where they are weak; ``labelled`` has text and target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = worker_state("dsir", _hashes)
        counts = np.zeros((2, MARKS), np.int64)
        n = np.zeros(2, np.int64)
        for b in batches:
            if len(memory) > MEMORY:
                memory.clear()
            for t, good in zip(utf8(b.column("text")), b.column("target").to_pylist()):
                counts[int(good), _mark_buckets(t, memory)] += 1
                n[int(good)] += 1
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[n[0], counts[0][some]]), pa.array(np.r_[n[1], counts[1][some]])], ["bucket", "other", "good"])

    total = map_batches(labelled, run, T._parse_datatype_string("bucket long, other long, good long")).groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("good").alias("good"))
    # MARKS + 1 rows at most; a bucket without documents outside the target marks nothing
    rows = total.where("bucket < 0 or other > 0").toPandas()
    out, whole = np.zeros(MARKS), rows[rows.bucket < 0]
    if whole.empty or not whole.other.iloc[0] or not whole.good.iloc[0]:
        return out
    n, m = float(whole.other.iloc[0]), float(whole.good.iloc[0])
    rows = rows[rows.bucket >= 0]
    x, y = rows.other.to_numpy(float), rows.good.to_numpy(float)
    odds = np.log(x / n) - np.log((y + 1) / (m + 1))
    evidence = x * np.log(x / (x + y) * (n + m) / n) + y * np.log(np.maximum(y, 1e-300) / (x + y) * (n + m) / m)
    strong = (odds >= LEAST_ODDS) & (evidence >= EVIDENCE)
    out[rows.bucket.to_numpy()[strong]] = odds[strong]
    return out


def weigh(docs: DataFrame, ratio: np.ndarray, marks: np.ndarray, text_at: int) -> DataFrame:
    """``docs`` with columns ``_weight`` and ``_marks``; ``ratio`` and ``marks`` have a fixed size, ``text_at`` is the text's place."""
    sent = cloudpickle.dumps((ratio, marks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (own, odds), memory = cloudpickle.loads(sent), worker_state("dsir", _hashes)
        any_marks = odds.any()
        for b in batches:
            if len(memory) > MEMORY:
                memory.clear()
            out, against = [], []
            for t in utf8(b.column(text_at)):
                f = features(t, memory)
                out.append(float(own[f].mean()) * SHARPNESS if len(f) else 0.0)
                against.append(float(odds[_mark_buckets(t, memory)].sum()) * SHARPNESS if any_marks else 0.0)
            yield b.append_column("_weight", pa.array(out, pa.float64())).append_column("_marks", pa.array(against, pa.float64()))

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField("_weight", T.DoubleType()), T.StructField("_marks", T.DoubleType())]))


def gumbel(*parts: Column) -> Column:
    """Standard Gumbel noise drawn by a hash."""
    u = (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(rows: DataFrame, bits: str, k: int) -> int | None:
    """The k-th largest of a long column, by counting 16-bit prefixes from the top; None if there are fewer rows.

    ``rows`` should be a written table: it is read four times.
    """
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        # the top prefix is signed, the others are not
        part = F.expr(f"cast(shiftright({bits}, {shift}) as long)") if shift == 48 else F.expr(f"shiftrightunsigned({bits}, {shift}) & 65535")
        inside = rows if shift == 48 else rows.where(F.expr(f"shiftright({bits}, {shift + 16})") == F.lit(prefix))
        found = False
        for r in sorted(inside.groupBy(part.alias("p")).count().collect(), key=lambda r: -r["p"]):  # 65,536 rows at most
            if left <= r["count"]:
                prefix = r["p"] if shift == 48 else (prefix << 16) | r["p"]
                found = True
                break
            left -= r["count"]
        if not found:
            return None
    return prefix


class Resampler:
    """The fitted ratio and the key that the last document kept has."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic"):
        self.scratch = Scratch(docs.sparkSession)
        self.id_col, self.text_col = id_col, text_col
        d = picked(docs, id=id_col, text=text_col)
        lab = picked(labels, label_id=label_id_col, quality=quality_col, toxic=toxic_col).where("label_id is not null and quality is not null and toxic is not null")
        of_all = lambda cond: F.min(F.when(F.expr(cond), 1).otherwise(0)) == 1
        lab = self.scratch.write(lab.groupBy("label_id").agg(of_all("quality = 1 and toxic = 0").alias("target"), of_all("quality = 1").alias("good")), "labels")
        marked = d.join(lab, d["id"] == lab["label_id"], "left").select("id", "text", F.coalesce("target", F.lit(False)).alias("target"), "good")
        share = marked.where("good is not null").agg(F.avg(F.col("target").cast("double"))).collect()[0][0]
        self.ratio = log_ratio(count_models(marked.select("text", "target")))
        self.marks = mark_odds(marked.where("good is not null").select("text", "target"))
        self.keys = self.scratch.write(self._keyed(docs).select(F.col("_id").alias("id"), F.col("_weight").alias("weight"), F.col("_key").alias("key")), "keys")
        n = self.keys.count()
        k = n if share is None or not self.ratio.any() else int(np.ceil(share * n))
        self.least = kth_largest(self.keys.select(_ordered("key").alias("order")), "order", k) if k else None

    def _keyed(self, docs: DataFrame) -> DataFrame:
        """``docs`` with its columns numbered ``_c0..``, and ``_id``, ``_weight``, ``_key``."""
        cols = list(docs.columns)
        if cols.count(self.id_col) != 1 or cols.count(self.text_col) != 1:
            raise ValueError(f"columns {self.id_col!r} and {self.text_col!r} must be there once: {cols}")
        at_id, at_text = cols.index(self.id_col), cols.index(self.text_col)
        d = weigh(docs.toDF(*[f"_c{i}" for i in range(len(cols))]), self.ratio, self.marks, at_text)
        noise = gumbel(F.lit(1), F.col(f"_c{at_id}").cast("string"), F.col(f"_c{at_text}"))
        return d.withColumn("_id", F.col(f"_c{at_id}")).withColumn("_key", F.col("_weight") - F.col("_marks") + noise)

    def _keeps(self, key: str) -> Column:
        return F.lit(False) if self.least is None else _ordered(key) >= F.lit(self.least)

    def verdicts(self) -> DataFrame:
        """Per row: id, log importance ``weight``, Gumbel ``key`` (less what marks count) and ``kept``."""
        return self.keys.select(F.col("id").alias(self.id_col), "weight", "key", self._keeps("key").alias("kept"))

    def kept(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that are kept, with their columns as they were."""
        cols = list(docs.columns)
        return self._keyed(docs).where(self._keeps("_key")).select(*[f"_c{i}" for i in range(len(cols))]).toDF(*cols)


def _ordered(col: str) -> Column:
    """A long that orders as the double does, at a resolution of 2^-32."""
    return F.floor(F.greatest(F.least(F.col(col), F.lit(1e9)), F.lit(-1e9)) * float(1 << 32)).cast("long")


def quality_classes(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, log importance ``weight``, Gumbel ``key`` and ``kept``."""
    return Resampler(docs, labels, id_col, text_col).verdicts()
