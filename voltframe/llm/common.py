"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.session import ensure_checkpoint_dir

#: ASCII white space (space, tab, LF, VT, FF, CR): what separates words.
WORD_SEPARATOR = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder that ``spark.checkpoint.dir``
    names and read it back: computed once, lineage cut, safe against the loss
    of executors. For tables too large for ``checkpoint()``'s row format."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder; Spark's cleaner drops the files
    when the frame is no longer used."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Null-safe identity of a row for joins: is the id missing, the id, a hash
    of the text. Rows that agree in all three hold the same document, so they
    also get the same result."""
    return [F.col(id_col).isNull().alias("__k_null"),
            F.coalesce(F.col(id_col), F.lit(0)).alias("__k_id"),
            F.xxhash64(F.col(text_col)).alias("__k_text")]


KEY = ["__k_null", "__k_id", "__k_text"]


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` has two long columns ``a`` and ``b``; self loops and nulls are
    ignored. Returns ``(id, root)`` for every id that has an edge to another
    one, ``root`` being the smallest id of its component. Each step is a
    grouped minimum (combined before its shuffle) and an equi-join whose large
    partitions AQE can split, so a hub costs no single task. Every round is
    checkpointed. An empty ``edges`` gives an empty result."""
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = checkpointed(e)
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = checkpointed(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def on_workers(spark: SparkSession) -> None:
    """Let Python workers that see the driver's files import this package from
    where the driver did. On a cluster ship it with ``--py-files`` instead."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def by_value(use: Callable[[list], pa.Array], rows: int = 256) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """An iterator of Arrow arrays to one of results; ``use`` sees Python values
    of ``rows`` rows at a time, so a worker holds no second copy of a batch."""
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield pa.concat_arrays([use(array.slice(at, rows).to_pylist())
                                    for at in range(0, max(len(array), 1), rows)])
    return run
