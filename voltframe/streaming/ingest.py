"""Structured Streaming ingest: landing CSV(.gz) files -> bronze parquet,
exactly once per file, drained with ``availableNow`` and stopped.

No watermark is used on purpose: readings for any past interval may arrive
in any later file and are applied downstream by key (upsert), never dropped.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from voltframe.sources.landing import stream_readings


def start_ingest(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append every new landing file to the bronze parquet folder.

    The checkpoint records which files were committed, so a restart picks up
    only new files; the parquet sink's own log makes the append idempotent.
    """
    return (stream_readings(spark, landing, max_files_per_trigger)
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(bronze_path))


def ingest_available(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                     max_files_per_trigger: int | None = None) -> dict:
    """Drain the landing folder and stop; returns the last progress report."""
    q = start_ingest(spark, landing, bronze_path, checkpoint, max_files_per_trigger)
    q.awaitTermination()
    progress = q.lastProgress or {}
    return {"batchId": progress.get("batchId"), "numInputRows": progress.get("numInputRows", 0)}


def ingest_readings(spark: SparkSession, landing: str, out: str, ckpt: str) -> dict:
    """Landing extracts -> bronze parquet, drained and stopped."""
    return ingest_available(spark, landing, out, ckpt)
