"""Volume and duplicate diagnostics over readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _start_day(df: DataFrame) -> DataFrame:
    s = F.col("StartDateTime")
    return (df.withColumn("Year", F.year(s)).withColumn("Month", F.month(s))
              .withColumn("Day", F.dayofmonth(s)))


def daily_diagnostics(indexed: DataFrame) -> DataFrame:
    """Readings per meter per (UTC) day of the start time."""
    return (_start_day(indexed).groupBy("MeterNumber", "Year", "Month", "Day")
            .agg(F.count(F.lit(1)).alias("count")))


def daily_counts(readings: DataFrame) -> DataFrame:
    return (_start_day(readings.filter(F.col("MeterNumber").isNotNull()))
            .groupBy("Year", "Month", "Day")
            .agg(F.count(F.lit(1)).alias("TotalDataPointsPerDay")))


def substation_daily_counts(readings: DataFrame) -> DataFrame:
    return (_start_day(readings.filter(F.col("MeterNumber").isNotNull()))
            .groupBy("Year", "Month", "Day", "SubstationCode")
            .agg(F.count(F.lit(1)).alias("TotalDataPointsPerSubstationPerDay")))


def duplicate_timestamps(readings: DataFrame) -> DataFrame:
    """Meters with more than one entry for the same start time."""
    return (_start_day(readings.filter(F.col("MeterNumber").isNotNull()))
            .groupBy("Year", "Month", "Day", "MeterNumber", "StartDateTime")
            .agg(F.count(F.lit(1)).alias("EntriesPerTimestamp"))
            .filter(F.col("EntriesPerTimestamp") > 1))


def reading_span(readings: DataFrame) -> DataFrame:
    return readings.agg(F.min("StartDateTime").alias("FirstSampleTime"),
                        F.max("EndDateTime").alias("LastSampleTime"))


def unit_counts(readings: DataFrame) -> DataFrame:
    return readings.groupBy("UnitOfMeasure").agg(F.count(F.lit(1)).alias("count"))


def distinct_meters(readings: DataFrame) -> DataFrame:
    return readings.agg(F.count(F.lit(1)).alias("RowCount"),
                        F.countDistinct("MeterNumber").alias("MeterCount"))


def index_bounds(indexed: DataFrame) -> DataFrame:
    """Lowest start index and highest end index (the high-water mark)."""
    return indexed.agg(F.min("StartMeterSampleIndex").alias("FirstStartIndex"),
                       F.max("EndMeterSampleIndex").alias("LastEndIndex"))


def distinct_end_times(readings: DataFrame) -> DataFrame:
    return readings.select("EndDateTime").distinct().orderBy("EndDateTime")


def volume_checks(readings: DataFrame) -> dict[str, DataFrame]:
    """The data-volume and duplicate checks over landing readings: points per
    day, points per day and substation, and meters with more than one entry
    for one start time."""
    return {"daily_counts": daily_counts(readings),
            "substation_daily_counts": substation_daily_counts(readings),
            "duplicate_timestamps": duplicate_timestamps(readings)}
