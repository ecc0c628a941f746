"""Cleaning a corpus for training: five stages over ``documents``, each written as Parquet before the next reads it.

quality classifier -> SimHash near-dedup -> substring dedup -> personal data -> packing.
All but the last return the columns of ``documents``; texts that a stage changes get a new ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reunion.llm.chunks import deduplicated
from reunion.llm.common import Scratch
from reunion.llm.dsir import Resampler
from reunion.llm.packing import pack
from reunion.llm.pii import redacted
from reunion.llm.simhash import representatives
from reunion.session import release, written_folders
from reunion.sources.tables import read_table


def _recounted(before: DataFrame, after: DataFrame) -> DataFrame:
    """The columns and types of ``before``, with ``n_chars`` counted anew."""
    kind = before.schema["n_chars"].dataType
    return after.withColumn("n_chars", F.length("text").cast(kind)).select(*before.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; the others go."""
    return Resampler(docs, read_table(spark, sf_dir, "labels")).kept(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: that of the smallest id."""
    return representatives(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id holds are cut out."""
    return _recounted(docs, deduplicated(docs, report=False))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _recounted(docs, redacted(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("personal data", personal_data_stage),
    ("packing", packing_stage),
]

#: SQL can't express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage wrote goes when the next one's output is written."""
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        earlier = set(written_folders(spark)) - set(scratch.folders)
        before = list(scratch.folders)
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        mine = [f for f in written_folders(spark) if f not in earlier and f not in scratch.folders]
        release(spark, mine + before)
        scratch.folders = [f for f in scratch.folders if f not in before]
    return docs
