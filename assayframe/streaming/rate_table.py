"""Rates kept up to date in a durable table.

The table holds mergeable counts per (dimension, key): rows, YES, decided, NA and
Unknown. Every micro-batch adds its own counts to the published ones in one small
aggregate, writes the sum to a fresh folder and replaces the pointer file by one rename.
The folder's name carries the stream and the batch, so sum and guard change together:

* a batch that is repeated after a stop (the counts were published, the stream's own
  progress was not) finds its number there and is not added again;
* a batch that failed before the rename left nothing behind that readers see;
* a batch of another stream, or one that leaves a gap (the table or the checkpoint was
  lost), fails clearly instead of giving wrong rates.

A stopped and repeated stream therefore equals the batch job over the same lines. Work
per batch grows with the batch and the number of groups, not with what came before. Null
keys are a group; a batch without rows changes no count.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from assayframe.operators.rates import COUNTS, group_counts, merge_counts
from assayframe.sources.clean import current_folder, point

SCHEMA = "dimension string, key string, " + ", ".join(f"{c} long" for c in COUNTS)
_STREAM_ID = "sql.streaming.queryId"       # set by Spark for the thread that runs a batch


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The published counts; no rows where nothing was published yet."""
    folder = current_folder(spark, path)
    return spark.createDataFrame([], SCHEMA) if folder == path else spark.read.schema(SCHEMA).parquet(folder)


def applied_batch(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """(stream, batch) whose counts were added last; None where nothing was published."""
    folder = current_folder(spark, path)
    if folder == path:
        return None
    _, stream, batch, _ = folder.rsplit("/", 1)[1].split("_")
    return stream, int(batch)


def add_batch(batch: DataFrame, number: int, path: str, keys: Sequence[str], stream: str) -> bool:
    """Add the counts of one micro-batch to the table. False when they are in it already."""
    spark, last = batch.sparkSession, applied_batch(batch.sparkSession, path)
    if last is not None and last[0] != stream:
        raise ValueError(f"{path} holds the counts of stream {last[0]}, not of {stream}")
    if last == (stream, number):
        return False
    expected = last[1] + 1 if last else 0
    if number != expected:
        raise ValueError(f"{path}: batch {number} does not follow, expected {expected}")
    fresh = group_counts(batch, keys)
    merged = merge_counts(read_counts(spark, path), fresh) if last else fresh
    name = f"data-_{stream}_{number}_{uuid.uuid4().hex}"
    merged.write.parquet(f"{path.rstrip('/')}/{name}")
    point(spark, path, name)
    return True


def keep_counts(df: DataFrame, path: str, keys: Sequence[str] = ("category", "country", "maker"),
                checkpoint: str | None = None, available_now: bool = True,
                processing_time: str | None = None) -> StreamingQuery:
    """Keep the counts of a stream of cleaned records in the table at ``path``. Progress
    and counts belong together: without ``checkpoint`` it is ``path/_checkpoint``. Older
    folders stay until ``sources.clean.drop_old`` is called."""
    def add(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty(_STREAM_ID)
        add_batch(batch, number, path, list(keys), stream)

    writer = df.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint or f"{path.rstrip('/')}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()
