"""Incremental folder ingest with Structured Streaming."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.warehouse import Warehouse
from ..sources.batches import FILE_PATTERN, FILE_PREFIX, ordered_batches


def load_new_files(
    warehouse: Warehouse,
    folder: str,
    checkpoint: str,
    pattern: str = FILE_PATTERN,
    prefix: str = FILE_PREFIX,
    computed_at: datetime | None = None,
) -> StreamingQuery:
    """Start a query that loads every file not seen before and then stops.

    The stream carries file names only: batches have different headers, and a
    streaming CSV would read all of them by position under one schema. The file
    content is not read by the stream, because the column holding it is pruned.
    The new batches of a micro-batch are merged in one step, in natural name order. A
    micro-batch repeated after a failure, or a further part file of a known batch,
    replays the whole batch.
    """
    spark = warehouse.spark
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path")
    )

    def load(files: DataFrame, _epoch: int) -> None:
        warehouse.load_files(ordered_batches(files, pattern, prefix), computed_at)

    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
