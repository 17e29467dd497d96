"""Parquet tables addressed by path.

``DayTable`` is a folder partitioned by one text column (a day). A merge
computes the complete new content of the partitions that a batch touches;
``replace`` puts it in place with Spark's dynamic partition overwrite, which
leaves all other partitions alone. The new content must not be read from the
table itself while it is replaced: write it elsewhere first (see
``streaming/chain.py``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.operators.changes import upsert
from voltframe.session import scratch_folder


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet folder (files of several schemas are merged), or None if
    nothing has been written there yet."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to a new scratch folder and read from there: what several
    later steps need is worked out once, and their plans begin here."""
    folder = scratch_folder(df.sparkSession, tag)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class DayTable:
    def __init__(self, spark: SparkSession, path: str, part_col: str = "day"):
        self.spark, self.path, self.part_col = spark, path.rstrip("/"), part_col

    def read(self, schema=None, partitions=None) -> DataFrame:
        """Current rows; ``partitions`` limits the read to those partition values
        (other folders are pruned). Before the first write the table is empty and
        has ``schema``, without which reading it is an error."""
        df = read_if_there(self.spark, self.path)
        if df is None:
            if schema is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], schema)
        df = df.withColumn(self.part_col, F.col(self.part_col).cast("string"))
        return df if partitions is None else df.filter(F.col(self.part_col).isin(list(partitions)))

    def touched(self, df: DataFrame) -> list[str]:
        """Partition values present in a batch (the few days it covers)."""
        return [r[0] for r in df.select(self.part_col).distinct().collect()]

    def merged(self, source: DataFrame, keys, touched: list[str] | None = None) -> DataFrame:
        """The complete new content of the partitions that ``source`` touches:
        matching keys take the source row, others are inserted; on the first
        write just the source. Merging the same source again gives the same
        content. ``touched`` (the partition values of ``source``) saves a job
        when the caller knows them."""
        touched = self.touched(source) if touched is None else touched
        current = self.read(source.schema, partitions=touched)
        # a column that only one side has is null on the other
        both = lambda a, b: a.unionByName(b.limit(0), allowMissingColumns=True)
        return upsert(both(current, source), both(source, current), list(keys) + [self.part_col])

    def replace(self, content: DataFrame) -> None:
        """Put complete partitions in place of those of the same values."""
        (content.hint("rebalance", self.part_col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.part_col).parquet(self.path))

    def upsert(self, source: DataFrame, keys) -> None:
        """Merge a batch in one call. The new content is checkpointed in the
        shared folder before the partitions that it was read from are replaced;
        ``streaming/chain.py`` has the form that survives a driver's end."""
        from voltframe.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        self.replace(self.merged(source, keys).checkpoint())


def month_of(col: str):
    return F.date_format(F.col(col), "yyyy-MM")


def day_of(col: str):
    return F.date_format(F.col(col), "yyyy-MM-dd")


# ---- plain path tables (overwrite, schema evolution, catalogue names)

def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Parquet write; a partitioned write is preceded by a ``rebalance`` on
    the partition columns, so AQE sizes the files and splits a hot partition
    value over several tasks instead of writing one file per task per value."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder whose files were appended with growing schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def union_evolving(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Expose a parquet folder under a catalogue name, with the partitions that
    it has now."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int) -> None:
    """Write a catalogue table bucketed by a column, one file a bucket. Joins on
    the column and aggregations whose key holds it then need no exchange."""
    (df.repartition(buckets, column).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, column).format("parquet").saveAsTable(name))
