"""Streaming scorer: new records from a stream, matched against a static known relation.

Each micro-batch is scored with :func:`reunion.plans.score.score_records` inside
``foreachBatch`` (a stateless stream-static join per batch, so no state grows). The known
side is stacked and salted once and reused by every batch; the checkpoint location makes
the query restart from where it stopped after a failure.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..constants import DEFAULT_THRESHOLD
from ..model import Model
from ..operators.blocking import DEFAULT_BLOCK_SPLIT
from ..plans.resolve import check_inputs, read_model
from ..plans.score import KnownRecords, score_records


def score_stream(
    stream_df: DataFrame,
    known_df: DataFrame,
    model: Model | str,
    *,
    new_id: str,
    known_id: str,
    sink: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    threshold: float = DEFAULT_THRESHOLD,
    unit: str = "byte",
    within: Sequence[str] = (),
    block_split: int | None = DEFAULT_BLOCK_SPLIT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a streaming query writing scored micro-batches through ``sink(batch_df, epoch_id)``."""
    if not stream_df.isStreaming:
        raise ValueError("score_stream needs a streaming DataFrame; use score_records for a batch")
    spark = stream_df.sparkSession
    model = read_model(model, spark)
    check_inputs(known_df, [*model.all_columns, *within], threshold, known_id)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = KnownRecords(known_df, model, known_id, within, unit, block_split).persist(partitions)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        sink(score_records(batch, None, model, new_id=new_id, known_id=known_id, threshold=threshold, unit=unit, within=within, known=known), epoch_id)

    writer = stream_df.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    query = writer.start()
    threading.Thread(target=_release, args=(query, known), daemon=True).start()
    return query


def score_stream_to(
    stream_df: DataFrame, known_df: DataFrame, model: Model | str, path: str, *, new_id: str, known_id: str, checkpoint_location: str, **options
) -> StreamingQuery:
    """:func:`score_stream` into a Parquet table, each batch exactly once.

    A batch has a folder of its own, ``batch=<epoch>``. A batch that is run again after a failure has the same rows
    (the checkpoint fixes its files) and replaces its folder, so nothing is lost or doubled.
    """

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={epoch_id}")

    return score_stream(stream_df, known_df, model, new_id=new_id, known_id=known_id, sink=sink, checkpoint_location=checkpoint_location, **options)


def _release(query: StreamingQuery, known: KnownRecords) -> None:
    """Let go of the known side when the stream has ended, well or not."""
    try:
        query.awaitTermination()
    except Exception:  # the caller sees the failure on the query itself
        pass
    known.unpersist()
