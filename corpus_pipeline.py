"""Corpus pipeline: quality, line dedup, near dedup, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and gives it, read again, to
the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import on_workers, stored, table
from voltframe.llm.lines import line_dedup
from voltframe.llm.mixing import mix
from voltframe.llm.packing import pack
from voltframe.llm.quality import quality_filter, train
from voltframe.llm.simhash import keep_one_per_group

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier doesn't reject; it is fitted on the
    rated documents of the input tables."""
    on_workers(spark)
    model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_filter(docs.select(*COLUMNS), model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines removed; ``n_chars`` follows the text."""
    return (line_dedup(docs.select(*COLUMNS)).drop("n_lines", "n_removed")
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    on_workers(spark)
    return keep_one_per_group(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the languages' tokens meet the target weights."""
    return mix(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces, with their token ids."""
    on_workers(spark)
    return pack(docs.select(*COLUMNS))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_dedup), ("mixing", mixing),
          ("packing", packing)]

#: No SQL: the classifier, the fingerprints and the tokenizer can't be said in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
