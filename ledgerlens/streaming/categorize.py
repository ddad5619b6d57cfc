"""Categorise payments as their files arrive (C6 on a stream).

The analysis is batch-only; this wrapper lets the same categorisation run
continuously: a file-source stream of payment Parquet files with the
declared schema, and ``foreachBatch`` applying ``payments_with_category`` to
each micro-batch.  Each batch classifies its own distinct descriptions
(a description's category depends only on its text and the dictionary), so
no state is carried between batches.

Output is idempotent: batch ``k`` overwrites its own ``batch=k`` folder, so a
batch replayed after a failure replaces its earlier attempt instead of
appending duplicates.  Progress is tracked in a checkpoint location on
shared storage (by default under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.text import payments_with_category, release_classified
from ledgerlens.schema import PAYMENT_SCHEMA
from ledgerlens.session import checkpoint_dir


def payment_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over payment Parquet files landing in ``source_dir``."""
    reader = spark.readStream.schema(PAYMENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def categorized_batches(
    spark: SparkSession,
    source_dir: str,
    dictionary: DataFrame,
    sink_dir: str,
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; every micro-batch is categorised and written once."""
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/stream-categorize"
    sink = sink_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = payments_with_category(batch, dictionary)
        out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        release_classified(batch)

    writer = (
        payment_stream(spark, source_dir, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
