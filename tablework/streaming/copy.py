"""Incremental copies and running counts with Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablework.sinks.tables import drop_old_versions, swap_table

def stream_copy(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    target: str | None = None,
    path: str | None = None,
    interval: str | None = None,
) -> StreamingQuery | None:
    """Append the rows that are new since the last run to a table or to a parquet folder.

    The checkpoint remembers what was copied. Without ``interval`` the call drains the source and
    returns; with one (e.g. ``"5 seconds"``) the running query is handed to the caller.
    """
    writer = spark.readStream.table(source).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    if path is not None:
        q = writer.format("parquet").start(path)
    else:
        q = writer.toTable(target)
    if interval:
        return q
    q.awaitTermination()
    return None


def stream_counts(spark: SparkSession, source: str, keys: Sequence[str], target: str, checkpoint: str) -> None:
    """Running group counts, written in full (complete mode) after every batch.

    Parquet has no complete mode of its own, hence each batch replaces the table.
    """
    counts = spark.readStream.table(source).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))

    def replace(batch: DataFrame, _: int) -> None:
        swap_table(batch, target)
        drop_old_versions(spark, target)

    q = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(replace)
        .start()
    )
    q.awaitTermination()


def stream_to_memory(stream: DataFrame, name: str | None = None) -> str:
    """Drain a small stream into an in-memory view and return its name.

    The view lives on the driver: meant for looking at a bounded aggregate, not for copies.
    """
    name = name or f"mem_{uuid.uuid4().hex[:8]}"
    mode = "append"
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return name
