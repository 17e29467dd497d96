"""The batch dataflow from fixtures to gold tables, as lazy DataFrames.

``Pipeline`` wires the operators in the order of the reference jobs
(bronze -> cleaned -> indexed -> no-submeters -> hourly -> gold) without
materialising anything; each query in the catalogue picks the stage it
needs and Catalyst prunes the rest.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.operators import changes as C
from voltframe.operators import hourly as H
from voltframe.operators import loadcontrol as L
from voltframe.operators import peaks as P
from voltframe.operators import readings as R
from voltframe.operators import submeters as S
from voltframe.operators import usage as U
from voltframe.session import use_utc
from voltframe.sources.fixtures import Fixtures


class Pipeline:
    """Use ``Pipeline.of(spark, dir)``: one shared instance per session and
    folder, so every query starts from the same analysed stage plans."""

    _shared: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Pipeline":
        key = (id(getattr(spark, "_jsparkSession", spark)), sf_dir.rstrip("/"))
        p = cls._shared.get(key)
        if p is None or p.spark is not spark:
            p = cls._shared[key] = cls(spark, sf_dir)
        use_utc(spark)
        return p

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.fx = Fixtures.of(spark, sf_dir)

    @cached_property
    def bronze(self) -> DataFrame:
        return self.fx.fx_bronze

    @cached_property
    def cleaned(self) -> DataFrame:
        return R.clean_readings(self.bronze)

    @cached_property
    def indexed(self) -> DataFrame:
        return R.index_readings(self.cleaned)

    @cached_property
    def submeter_map(self) -> DataFrame:
        return S.build_submeter_map(self.fx.fx_meter_info)

    @cached_property
    def nosub(self) -> DataFrame:
        return S.exclude_submeters(self.indexed, self.submeter_map)

    @cached_property
    def hourly(self) -> DataFrame:
        return H.hourly_usage(self.indexed)

    @cached_property
    def hourly_nosub(self) -> DataFrame:
        return H.hourly_usage(self.nosub)

    @cached_property
    def totals(self) -> DataFrame:
        # one aggregation from the readings (equal to aggregating hourly_nosub)
        return U.system_hourly_totals(self.nosub)

    # ---- load control
    @cached_property
    def lc_periods(self) -> DataFrame:
        return L.index_lc_periods(self.fx.fx_lc_text)

    @cached_property
    def lc_points(self) -> DataFrame:
        return L.expand_lc_periods(self.lc_periods)

    # ---- load control with events that grow, on readings over the clock changes
    @cached_property
    def indexed_dst(self) -> DataFrame:
        return R.index_readings(R.clean_readings(self.fx.fx_bronze_dst, parts=self.fx.parts("events")))

    @cached_property
    def lc_periods_wide(self) -> DataFrame:
        return L.index_lc_periods(self.fx.fx_lc_text_wide)

    @cached_property
    def lc_parts(self) -> int:
        """Partitions for the events' intervals: an event has some eight, cut by bins."""
        return self.fx.parts("orders", 25_000)

    # ---- peaks
    @cached_property
    def peaks(self) -> DataFrame:
        return P.peak_parts(self.fx.fx_peaks)

    @cached_property
    def indexed_peaks(self) -> DataFrame:
        return P.index_peaks(self.peaks)

    # Peak queries only need the hours that end at a peak: those hours are
    # found first (readings ending at a peak slot; the slot set is bounded by
    # the peaks) and only their readings are aggregated. Same rows as
    # joining the full hourly tables to the peaks.
    @cached_property
    def peak_hours(self) -> DataFrame:
        return H.hours_ending_at(self.indexed, self.indexed_peaks)

    @cached_property
    def hourly_at_peaks(self) -> DataFrame:
        return H.hourly_usage_in_hours(self.indexed, self.peak_hours)

    @cached_property
    def hourly_nosub_at_peaks(self) -> DataFrame:
        return H.hourly_usage_in_hours(self.nosub, self.peak_hours)

    @cached_property
    def hourly_nosub_in_peak_clock_hours(self) -> DataFrame:
        """Hours named by the peak's own local date and hour (dropout check)."""
        hours = self.indexed_peaks.select(F.col("CoincidYear").alias("LocalYear"),
                                          F.col("CoincidMonth").alias("LocalMonth"),
                                          F.col("CoincidDay").alias("LocalDay"),
                                          F.col("CoincidHour").alias("HourEnding"))
        return H.hourly_usage_in_hours(self.nosub, hours)

    @cached_property
    def peak_lc_rows(self) -> DataFrame:
        return P.peak_by_lc_meter(self.hourly_at_peaks, self.indexed_peaks, self.fx.fx_load_types)

    # ---- change batches: an early file and a later, overlapping file that
    # carries validated (VEE-filled) values
    # (both dealt out by key into the same partitions, so they meet there)
    @cached_property
    def batch1(self) -> DataFrame:
        return R.clean_readings(self.bronze.filter(F.dayofmonth("StartDateTime") <= 20), parts=self.fx.parts("events"))

    @cached_property
    def batch2(self) -> DataFrame:
        b2 = (self.bronze.filter(F.dayofmonth("StartDateTime") >= 10)
              .withColumn("VEEValue", F.coalesce("VEEValue", "AMIValue")))
        return R.clean_readings(b2, parts=self.fx.parts("events"))

    @cached_property
    def upserted(self) -> DataFrame:
        return C.upsert(self.batch1, self.batch2, R.READING_KEY)

    @cached_property
    def change_log(self) -> DataFrame:
        v1 = C.initial_load_changes(self.batch1, 1)
        v2 = C.upsert_changes(self.batch1, self.batch2, R.READING_KEY, 2)
        v3 = C.delete_changes(self.upserted, F.col("AMIValue") == 0, 3)
        return v1.unionByName(v2).unionByName(v3)


def out(df: DataFrame, double=(), bigint=(), int_=()) -> DataFrame:
    """Cast result columns to the types both engines report identically."""
    casts = {c: F.col(c).cast("double") for c in double}
    casts.update({c: F.col(c).cast("bigint") for c in bigint})
    casts.update({c: F.col(c).cast("int") for c in int_})
    return df.withColumns(casts) if casts else df
