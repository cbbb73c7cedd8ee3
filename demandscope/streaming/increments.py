"""Batch operators over growing inputs: an extension, not part of the batch pipeline's coverage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def apply_to_increments(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Runs ``operator`` on each micro-batch and writes its rows under the batch's number, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
