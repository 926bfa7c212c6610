"""Start a stream on what has arrived and wait until it is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillmark.session import shuffles_released


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    """Hand every micro-batch and its number to ``each``, which must be repeatable."""

    def released(batch: DataFrame, number: int) -> None:
        with shuffles_released(batch.sparkSession):
            each(batch, number)

    writer = stream.writeStream.outputMode(mode).foreachBatch(released)
    return _finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_append(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> StreamingQuery:
    """Append to a stored table, each input row exactly once."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(partition_by) if partition_by else writer
    return _finish(writer.trigger(availableNow=True).start())


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query
