"""The incremental silver chain as a ``foreachBatch`` sink.

Each micro-batch of new bronze rows is cleaned, indexed, stripped of
submeters and folded into the hourly tables:

  bronze batch -> cleaned (upsert by reading key; change rows to the change log)
               -> indexed (upsert by reading key)
               -> hourly: only the (meter, hour) groups the batch touches
                  are re-aggregated from the indexed table and upserted by
                  the hourly key
               -> load-control analysis (optional): the groups of the
                  touched hours, recomputed and upserted by group key
               -> no-submeter readings (upsert by slot-index key) and the
                  main-meter hourly partitions (the rewritten hourly
                  partitions without submeters)

All tables are partitioned by day. A batch has two steps. First the complete
new content of the partitions it touches is staged, with its change rows, and a
row in ``progress`` says so. Then the staged partitions are put in place by
dynamic partition overwrite, the change rows under (query id, batch id), and
another row says that. A batch that died in the first step starts anew; one
that died in the second puts the same staged partitions in place again; one that
Spark replays after both does nothing. Ids are kept for each query id, so a new
or reset checkpoint skips nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.timeindex import LOCAL_TZ
from voltframe.functions.timeindex import require_whole_hours
from voltframe.operators import changes as C
from voltframe.operators import hourly as H
from voltframe.operators import readings as R
from voltframe.operators.loadcontrol import load_control_analysis
from voltframe.operators.quality import observed, require_no_nulls, require_unique
from voltframe.operators.submeters import NOSUB_KEY, exclude_submeters
from voltframe.plans.incremental import LC_KEY, rebuild_hours
from voltframe.sources.tables import DayTable, day_of, read_if_there

STAGED, APPLIED = 1, 2


class SilverChain:
    def __init__(self, spark: SparkSession, root: str, submeter_map: DataFrame | None = None,
                 tz: str = LOCAL_TZ, gates: bool = True, lc_points: DataFrame | None = None,
                 program_map: DataFrame | None = None, program_col: str = "BI_LOAD_TYPE", parts: int | None = None):
        self.spark, self.root, self.tz, self.gates = spark, root.rstrip("/"), tz, gates
        require_whole_hours(tz)
        self.submeter_map = submeter_map
        self.parts = parts  # of a batch's readings, see ``clean_readings``
        self.cleaned = DayTable(spark, f"{self.root}/cleaned")
        self.indexed = DayTable(spark, f"{self.root}/indexed")
        self.nosub = DayTable(spark, f"{self.root}/nosub")
        self.hourly = DayTable(spark, f"{self.root}/hourly")
        self.hourly_nosub = DayTable(spark, f"{self.root}/hourly_nosub")
        self.lc_points, self.program_map, self.program_col = lc_points, program_map, program_col
        # (the analysis has a ``Day`` column, so its partition column is named
        # differently: column names are case-insensitive)
        self.lc_analysis = DayTable(spark, f"{self.root}/lc_analysis", part_col="local_date")
        self.metrics: dict[int, dict] = {}

    # ---- progress: one row for each step of a batch
    def progress(self) -> DataFrame:
        """``scope, batch_id, version, step``; ``step`` is STAGED or APPLIED."""
        rows = read_if_there(self.spark, f"{self.root}/progress")
        return rows if rows is not None else self.spark.createDataFrame(
            [], "scope string, batch_id long, version long, step int")

    def _done(self, scope: str, batch_id: int, version: int, step: int) -> None:
        self.spark.createDataFrame([(scope, batch_id, version, step)],
                                   "scope string, batch_id long, version long, step int") \
            .coalesce(1).write.mode("append").parquet(f"{self.root}/progress")

    def applied(self, batch_id: int, scope: str = "batch") -> bool:
        return not self.progress().filter((F.col("scope") == scope) & (F.col("batch_id") == batch_id)
                                          & (F.col("step") == APPLIED)).isEmpty()

    # ---- one micro-batch
    def apply(self, bronze_batch: DataFrame, batch_id: int, scope: str = "batch") -> None:
        mine = (F.col("scope") == scope) & (F.col("batch_id") == batch_id)
        step, version, last = self.progress().agg(
            F.max(F.when(mine, F.col("step"))), F.max(F.when(mine, F.col("version"))), F.max("version")).first()
        if step == APPLIED:
            return
        staged = f"{self.root}/staged/scope={scope}"  # a batch's stage is that of the one before it no more
        if step is None:
            version = (last or 0) + 1
            self._stage(bronze_batch, batch_id, version, staged)
            self._done(scope, batch_id, version, STAGED)
        self._put_in_place(batch_id, version, scope, staged)
        self._done(scope, batch_id, version, APPLIED)

    def _stage(self, bronze_batch: DataFrame, batch_id: int, version: int, staged: str) -> None:
        """New content of every touched partition of every table, as of after
        this batch; empty for a batch without readings."""
        def stage(name: str, df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{staged}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{staged}/{name}")

        raw, seen = observed(bronze_batch, f"bronze_{batch_id}")
        cleaned, kept = observed(R.clean_readings(R.drop_header_rows(raw), parts=self.parts), f"cleaned_{batch_id}")
        # the batch is reused by every stage below
        cleaned = stage("batch", cleaned.withColumn("day", day_of("StartDateTime")))
        self.metrics[batch_id] = {"bronze_rows": seen.get.get("rows"), "cleaned_rows": kept.get.get("rows")}
        days = self.cleaned.touched(cleaned)  # UTC days: what every reading-keyed table rewrites
        key = R.READING_KEY
        if self.gates:
            require_unique(cleaned, key + ["day"], "cleaned batch")
        current = self.cleaned.read(cleaned.schema, partitions=days).select(*cleaned.columns)
        stage("changes", C.upsert_changes(current, cleaned, [*key, "day"], version)
              .withColumn("_commit_timestamp", F.current_timestamp()))
        now = stage("cleaned", self.cleaned.merged(cleaned, key, days))
        if self.gates:
            require_unique(now, [*key, "day"], "cleaned readings of the touched days")
        indexed = R.index_readings(cleaned.drop("day")).withColumn("day", day_of("StartDateTime"))
        if self.gates:
            require_no_nulls(indexed, ["StartMeterSampleIndex", "EndMeterSampleIndex"], "indexed batch")
        # indexing is per reading: the index of what was merged is the merge of the indexed
        upstream = stage("indexed", R.index_readings(now.drop("day")).withColumn("day", day_of("StartDateTime"))).drop("day")
        # with whole-hour zone offsets a local hour lies inside one UTC day, so
        # the touched days hold every reading of every touched hour
        hours = H.with_local_parts(indexed.drop("day"), "StartMeterSampleIndex", self.tz)
        hour_days = [r[0] for r in hours.select(
            F.format_string("%04d-%02d-%02d", "LocalYear", "LocalMonth", "LocalDay")).distinct().collect()]
        rebuilt = rebuild_hours(upstream, indexed.drop("day"), self.tz).withColumn(
            "day", F.format_string("%04d-%02d-%02d", "LocalYear", "LocalMonth", "LocalDay"))
        hourly = stage("hourly", self.hourly.merged(rebuilt, H.HOURLY_KEY, hour_days))
        if self.lc_points is not None and self.program_map is not None:
            stage("lc_analysis", self.lc_analysis.merged(self._controlled(upstream, hours), LC_KEY, hour_days))
        if self.submeter_map is not None:
            nosub = exclude_submeters(indexed, self.submeter_map)
            stage("nosub", self.nosub.merged(nosub, NOSUB_KEY, days))
            # exclusion commutes with the hourly rollup (it is per meter)
            stage("hourly_nosub", exclude_submeters(hourly, self.submeter_map))

    def _controlled(self, upstream: DataFrame, hours: DataFrame) -> DataFrame:
        """Load-control analysis groups of the touched hours, recomputed from
        every reading of those hours: late readings for past events are folded
        in, and no hour is written partially."""
        hour = ["MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel", "Year", "Month", "Day", "HourEnding"]
        touched = (hours.withColumnsRenamed({"LocalYear": "Year", "LocalMonth": "Month", "LocalDay": "Day"})
                   .select(*hour).distinct())
        return (load_control_analysis(self.lc_points, self.program_map, upstream, self.program_col, tz=self.tz)
                .join(touched, hour, "left_semi")
                .withColumn("local_date", F.format_string("%04d-%02d-%02d", "Year", "Month", "Day")))

    def _put_in_place(self, batch_id: int, version: int, scope: str, staged: str) -> None:
        tables = {"cleaned": self.cleaned, "indexed": self.indexed, "hourly": self.hourly}
        if self.lc_points is not None and self.program_map is not None:
            tables["lc_analysis"] = self.lc_analysis
        if self.submeter_map is not None:
            tables |= {"nosub": self.nosub, "hourly_nosub": self.hourly_nosub}
        for name, table in tables.items():
            table.replace(self.spark.read.parquet(f"{staged}/{name}"))
        # a consumer may see the rows of a batch that died here twice; they are
        # changes by key, so applying them again changes nothing
        (self.spark.read.parquet(f"{staged}/changes").write.mode("overwrite")
         .parquet(f"{self.root}/cleaned_changes/scope={scope}/batch={batch_id}"))

    def change_log(self) -> DataFrame:
        """All change rows so far (``_commit_version`` counts the batches)."""
        return self.spark.read.parquet(f"{self.root}/cleaned_changes")

    def run(self, bronze_path: str, checkpoint: str, schema=None,
            max_files_per_trigger: int | None = None):
        """Drain new bronze files through the chain (``availableNow``); with
        ``max_files_per_trigger`` a backlog is applied as several bounded
        micro-batches instead of one."""
        reader = self.spark.readStream.format("parquet")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if schema is None:
            schema = self.spark.read.parquet(bronze_path).schema

        def apply(df: DataFrame, batch_id: int) -> None:
            # the id that Spark keeps in the checkpoint: a reset checkpoint has a new one
            query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            self.apply(df, batch_id, query or "batch")
        q = (reader.schema(schema).load(bronze_path).writeStream
             .foreachBatch(apply)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return q
