"""Scheduled runs as a file stream: every trigger adds what is new since the last one."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from leadloom.operators.gates import promote
from leadloom.schemas import LEADS
from leadloom.sources.tables import TableStore


def stream_name(checkpoint: str) -> str:
    """Name under which a stream files its batches: one per checkpoint, which numbers them."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


def start_promotion_stream(
    spark: SparkSession, staging_path: str, store: TableStore, checkpoint: str, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Add new staged lead files to ``leads``, skipping keys that are stored already.

    The stream position lives in ``checkpoint``. Every micro-batch is written under its number and
    compared with all leads but its own, so a batch replayed after a failure replaces what it had
    written: nothing comes twice, rows without a key included.
    """
    name = stream_name(checkpoint)

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        store.write_batch("leads", name, batch_id, lambda stored: promote(batch, stored))

    staged = spark.readStream.schema(LEADS).option("maxFilesPerTrigger", files_per_batch).parquet(staging_path)
    return (
        staged.writeStream.foreachBatch(add_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
