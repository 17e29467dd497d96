"""The 5-minute calendar as a generated dimension.

The calendar is arithmetic on the slot index (no driver-side list of
timestamps, no global row_number); weekend and holiday flags come from the
local date, the latter by a broadcast join to the rule-built holiday table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.holidays import holiday_flag, us_holidays
from voltframe.functions.timeindex import (CALENDAR_FIRST_YEAR, CALENDAR_LAST_YEAR,
                                           CALENDAR_START_EPOCH, LOCAL_TZ,
                                           MAX_INDEX, date_parts, index_to_utc, serial_index,
                                           to_local, weekend_flag)

SLOTS_PER_DAY = 288


def calendar_columns(idx: DataFrame, tz: str = LOCAL_TZ, holidays: DataFrame | None = None) -> DataFrame:
    """MeterSampleIndex -> UTC and local timestamps, their parts and flags."""
    cal = (idx.withColumn("UTCTimeStamp", index_to_utc("MeterSampleIndex"))
              .withColumn("LocalTimeStamp", to_local("UTCTimeStamp", tz))
              .select("UTCTimeStamp", *date_parts("UTCTimeStamp", "UTC"), "LocalTimeStamp",
                      *date_parts("LocalTimeStamp", "Local"), "MeterSampleIndex")
              .withColumn("Weekend", weekend_flag("LocalTimeStamp")))
    if holidays is None:
        holidays = us_holidays(cal.select(F.col("LocalYear").alias("Year")).distinct())
    return holiday_flag(cal, "LocalTimeStamp", holidays)


def build_calendar(spark: SparkSession, first_year: int = CALENDAR_FIRST_YEAR,
                   last_year: int = CALENDAR_LAST_YEAR, tz: str = LOCAL_TZ,
                   num_partitions: int | None = None) -> DataFrame:
    """Every 5-minute UTC slot from Jan 1 of ``first_year`` to the end of
    ``last_year`` (within the index horizon), generated in parallel."""
    def slot(y, m, d, hh, mm):  # same rule as serial_index, for a literal
        secs = int(_dt.datetime(y, m, d, hh, mm, tzinfo=_dt.timezone.utc).timestamp())
        return (secs - CALENDAR_START_EPOCH) // 300 + 1
    first = max(1, slot(first_year, 1, 1, 0, 0))
    last = min(MAX_INDEX, slot(last_year, 12, 31, 23, 55))
    ids = spark.range(first, last + 1, numPartitions=num_partitions).select(
        F.col("id").cast("int").alias("MeterSampleIndex"))
    years = spark.range(first_year, last_year + 2).select(F.col("id").cast("int").alias("Year"))
    return calendar_columns(ids, tz, us_holidays(years))


def calendar_for_days(days: DataFrame, date_col: str = "Date", tz: str = LOCAL_TZ) -> DataFrame:
    """Calendar slots of the given UTC dates (288 per date, expanded on the
    executors): the calendar a batch of readings actually touches."""
    d = days.select(F.col(date_col).cast("date").alias("_d")).distinct()
    first = serial_index(F.col("_d").cast("timestamp"))
    idx = (d.select(F.explode(F.sequence(first, first + SLOTS_PER_DAY - 1)).alias("MeterSampleIndex"))
            .filter(F.col("MeterSampleIndex").isNotNull()))
    return calendar_columns(idx, tz)
