"""Streaming consumer of a change log written by ``SilverChain``.

The change log is a parquet folder partitioned by ``_commit_version``; a
file stream over it (with its own checkpoint) hands every committed version
to a downstream ``foreachBatch`` exactly once, keeping only the rows a
consumer applies (inserts and update post-images), and of several versions of
a key in one batch the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltframe.operators.changes import latest_per_key, postimages
from voltframe.operators.readings import READING_KEY


def stream_changes(spark: SparkSession, log_path: str, schema=None) -> DataFrame:
    if schema is None:
        schema = spark.read.parquet(log_path).schema  # includes _commit_version
    return spark.readStream.schema(schema).parquet(log_path)


def consume_changes(spark: SparkSession, log_path: str, checkpoint: str,
                    handle: Callable[[DataFrame, int], None], keys=READING_KEY) -> None:
    """Apply ``handle(postimages, batch_id)`` to everything new in the log. Keys
    whose last change in the batch is a delete are left out."""
    def last(batch: DataFrame, batch_id: int) -> None:
        after = batch.filter("_change_type <> 'update_preimage'")
        handle(postimages(latest_per_key(after, list(keys))).select(*batch.columns), batch_id)
    q = (stream_changes(spark, log_path).writeStream
         .foreachBatch(last).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
