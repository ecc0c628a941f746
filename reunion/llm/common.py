"""Helpers shared by the operators: column handling, Arrow batches, worker state, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, write_table

#: Rows of one Arrow batch: bounds a Python worker's memory when some texts are very long.
ARROW_ROWS = 1000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names; extra columns never clash.

    Positional renaming keeps this right for tables holding names that differ only in case.
    """
    cols = list(df.columns)
    for name in names.values():
        if cols.count(name) != 1:
            raise ValueError(f"column {name!r} must be there once, found {cols.count(name)} in {cols}")
    renamed = df.toDF(*[f"_c{i}" for i in range(len(cols))])
    return renamed.select(*[F.col(f"_c{cols.index(name)}").alias(new) for new, name in names.items()])


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short, as one text may be very long."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def utf8(col: pa.Array) -> list[bytes]:
    """A text column as bytes, null as empty."""
    return [b if b is not None else b"" for b in col.cast(pa.binary()).to_pylist()]


def texts(col: pa.Array) -> list[str]:
    """A text column as strings, null as empty."""
    return [t if t is not None else "" for t in col.to_pylist()]


def worker_state(key: str, make: Callable[[], object]) -> object:
    """A value kept in a Python worker from task to task (functions shipped by value get new globals for each task).

    A worker keeps one value: that of the operator that ran last, so stages don't add up in its memory.
    """
    import sys
    import types

    home = sys.modules.setdefault("_reunion_llm_worker", types.ModuleType("_reunion_llm_worker"))
    if getattr(home, "held", (None, None))[0] != key:
        home.held = (None, None)  # let go of the other before the new one is made
        home.held = (key, make())
    return home.held[1]


class Scratch:
    """Tables written under the session's shared checkpoint folder, to cut lineage and to be read more than once.

    ``reunion.session.release(spark)`` deletes them when results have been written.
    """

    def __init__(self, spark: SparkSession):
        ensure_checkpoint_dir(spark)
        self.folders: list[str] = []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        out, folder = write_table(df, label, "zstd")
        self.folders.append(folder)
        return out

    def write_and_clear(self, df: DataFrame, label: str) -> DataFrame:
        """Like :meth:`write`; the shuffle files behind the table go as soon as it is written, not when the driver collects garbage."""
        conf = df.sparkSession.conf
        before = conf.get(SHUFFLE_CLEANUP)
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            return self.write(df, label)
        finally:
            conf.set(SHUFFLE_CLEANUP, before)


def partitions_for(size: float, each: float) -> int:
    """How many groups of about ``each`` units hold ``size`` units; at least one."""
    return max(1, int(-(-size // each)))
