"""Incremental runs as file streams: what has been processed is in the checkpoint, so a second run does only what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_available(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, fmt: str = "json", files_per_batch: int = 1000) -> None:
    """Runs ``work`` over files of ``source`` that no run with this checkpoint has seen, appends to Parquet, and ends."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(source)
    query = work(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start(sink)
    query.awaitTermination()


def run_batches(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame, int], None], checkpoint: str, fmt: str = "json", files_per_batch: int = 1000) -> None:
    """The same with a batch function, for work that a stream can't express, such as keeping the best row of a key."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(source)
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
