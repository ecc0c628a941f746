"""One query per operator over the given tables, with production parameters and whole results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    from .secrets import secrets_report

    return secrets_report(read_table(spark, sf_dir, "documents"))


@query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest rows of ``embeddings`` for each row whose id is divisible by 20."""
    from pyspark.sql import functions as F

    from .ann import nearest

    e = read_table(spark, sf_dir, "embeddings")
    return nearest(e.where(F.col("vec_id") % 20 == 0), e, k=20)


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    from .packing import pack

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    from .pii import personal_data

    return personal_data(read_table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and robust outliers of all ``documents``."""
    from .rules import quality_rules

    return quality_rules(read_table(spark, sf_dir, "documents"))


@query
def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all ``documents``: 4-word shingles, links at 4 or fewer differing bits."""
    from .simhash import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded by byte-level BPE, and decoded again."""
    import public_tokenizers

    from .bpe import round_trip

    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op8_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all ``documents`` under a suffix tree, and their unigram base."""
    from .pst import lm_scores

    return lm_scores(read_table(spark, sf_dir, "documents"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance resampling of all ``documents`` towards those that ``labels`` call good."""
    from .dsir import quality_classes

    return quality_classes(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with passages cut out that another document (or the text before) holds."""
    from .chunks import substring_report

    return substring_report(read_table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` with the commonest word one code point away, and the root of its chain."""
    from .spelling import spelling_variants

    return spelling_variants(read_table(spark, sf_dir, "documents"))


@query
def op12_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded by SentencePiece, and decoded again."""
    import public_tokenizers

    from .pieces import round_trip

    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives next below each of the 5 positives of every row of ``embeddings`` whose id is divisible by 100."""
    from pyspark.sql import functions as F

    from .rtree import hard_negatives

    e = read_table(spark, sf_dir, "embeddings")
    e = e.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(e.where(F.col("vec_id") % 100 == 0), e)


ORACLE_SQL: dict[str, str] = oracle.SQL
