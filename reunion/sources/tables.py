"""Reading the given parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_cache: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir`` as a lazy DataFrame (column pruning and filters reach the scan).

    The DataFrame (its file listing and schema) is reused within a session.
    """
    path = table_path(sf_dir, name)
    key = (str(spark._jsparkSession.sessionUUID()), path)
    df = _cache.get(key)
    if df is None:
        df = _cache[key] = spark.read.parquet(path)
    return df


def stream_table(spark: SparkSession, sf_dir: str, name: str, files: int = 1) -> DataFrame:
    """The files of a table as a stream, ``files`` of them a batch."""
    schema = read_table(spark, sf_dir, name).schema
    # as a pattern, so that a table of one file will do as well as a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(os.path.join(sf_dir, f"{name}.parque[t]"))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register tables as temp views under their own names, for SQL use."""
    for n in names:
        if os.path.exists(table_path(sf_dir, n)):
            read_table(spark, sf_dir, n).createOrReplaceTempView(n)
