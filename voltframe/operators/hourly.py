"""Hourly usage per meter and the first-generation (v1) gold aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.text import pct_difference
from voltframe.functions.timeindex import (CALENDAR_FIRST_YEAR, CALENDAR_LAST_YEAR, LOCAL_TZ, hour_ending,
                                           index_to_local, index_to_utc)
from voltframe.operators.readings import READING_VALUES

HOURLY_KEY = ["MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel",
              "LocalYear", "LocalMonth", "LocalDay", "HourEnding"]


def with_local_parts(df: DataFrame, index_col: str = "StartMeterSampleIndex",
                     tz: str = LOCAL_TZ, unplaced: str = "error") -> DataFrame:
    """Local calendar parts of a slot index and the hour ending (1..24).

    A row without an index has no calendar slot: its time is missing, off the
    5-minute grid or outside the calendar's years. That is an error; with
    ``unplaced="drop"`` such rows are left out. All parts come from the slot
    *start*, so hour ending 24 stays on the start's local day.
    """
    if unplaced not in ("error", "drop"):
        raise ValueError(f"unplaced must be 'error' or 'drop', not {unplaced!r}")
    local = index_to_local(F.col(index_col), tz)
    there = F.col(index_col).isNotNull()
    if unplaced == "error":
        there = F.when(there, F.lit(True)).otherwise(F.raise_error(F.lit(
            f"a reading has no slot: {index_col} is null (time missing, off the 5-minute grid or outside "
            f"{CALENDAR_FIRST_YEAR}-{CALENDAR_LAST_YEAR})")).cast("boolean"))
    return (df.filter(there)
              .withColumn("_local", local)
              .withColumns({"LocalYear": F.year("_local"), "LocalMonth": F.month("_local"),
                            "LocalDay": F.dayofmonth("_local"), "HourEnding": hour_ending("_local")})
              .drop("_local"))


def hourly_usage(indexed: DataFrame, tz: str = LOCAL_TZ, drop_copies: bool = False,
                 parts: int | None = None) -> DataFrame:
    """Per meter/unit/direction/channel and local hour: summed AMI and VEE
    and the last slot index of the hour.

    On the autumn DST day two UTC hours share HourEnding 2 and are summed.
    The indexed table is unique on the reading key (gated upstream), so the
    full-row de-duplication pass is opt-in (``drop_copies``) rather than a
    shuffle of the largest table on every run.

    With ``parts`` the readings are dealt out by hour into so many partitions and
    summed inside them, so a task's memory follows the rows of a partition.
    Without, they are summed on both sides of the exchange, which saves little on
    readings that are dealt out by their start (``clean_readings``).
    """
    src = with_local_parts(indexed.dropDuplicates() if drop_copies else indexed, "StartMeterSampleIndex", tz)
    if parts:
        src = src.select(*HOURLY_KEY, *READING_VALUES, "EndMeterSampleIndex").repartition(parts, *HOURLY_KEY)
    return src.groupBy(*HOURLY_KEY).agg(*hourly_aggs())


def hourly_aggs():
    return [F.sum("AMIValue").alias("HourlyAMIValue"),
            F.sum("VEEValue").alias("HourlyVEEValue"),
            F.max("EndMeterSampleIndex").alias("EndMeterSampleIndex")]


def _v1_parts(cleaned: DataFrame) -> DataFrame:
    end = F.col("EndDateTime")
    return cleaned.select(F.year(end).alias("Year"), F.month(end).alias("Month"),
                          F.dayofmonth(end).alias("Day"), F.hour(end).alias("HourEnding"),
                          "AMIValue", "VEEValue")


def totals_by_hour(cleaned: DataFrame) -> DataFrame:
    """v1: totals by hour-of-day of the end time (0..23, session time) with
    the VEE-AMI difference and its share of AMI."""
    t = (_v1_parts(cleaned).groupBy("HourEnding")
         .agg(F.sum("AMIValue").alias("TotalAMIValue"), F.sum("VEEValue").alias("TotalVEEValue")))
    return (t.withColumn("AMI_VEE_kWhDifference", F.col("TotalVEEValue") - F.col("TotalAMIValue"))
             .withColumn("AMI_VEE_PercentDifference",
                         pct_difference("TotalAMIValue", "TotalVEEValue")))


def totals_by_day_hour(cleaned: DataFrame) -> DataFrame:
    """v1: totals by year, month, day and hour of the end time."""
    return (_v1_parts(cleaned).groupBy("Year", "Month", "Day", "HourEnding")
            .agg(F.sum("AMIValue").alias("TotalAMIValue"), F.sum("VEEValue").alias("TotalVEEValue")))


def rows_by_month(cleaned: DataFrame) -> DataFrame:
    return _v1_parts(cleaned).groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("count"))


HOUR_PARTS = ["LocalYear", "LocalMonth", "LocalDay", "HourEnding"]


def hourly_usage_in_hours(indexed: DataFrame, hours: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """``hourly_usage`` restricted to the given local hours (LocalYear,
    LocalMonth, LocalDay, HourEnding): readings outside them are dropped
    before the aggregation shuffle (map-side if AQE finds the hours small)."""
    h = hours.select(*HOUR_PARTS).distinct()
    return (with_local_parts(indexed, "StartMeterSampleIndex", tz)
            .join(h, HOUR_PARTS, "left_semi")
            .groupBy(*HOURLY_KEY).agg(*hourly_aggs()))


def hours_ending_at(indexed: DataFrame, slots: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Local hours of the readings that end at one of ``slots`` (a column
    ``MeterSampleIndex``): every hourly group whose last slot is one of them
    lies in these hours."""
    s = slots.select(F.col("MeterSampleIndex").alias("_s")).distinct()
    ends = indexed.join(s, F.col("EndMeterSampleIndex") == F.col("_s"), "left_semi")
    return with_local_parts(ends, "StartMeterSampleIndex", tz).select(*HOUR_PARTS).distinct()


SLOTS_PER_DAY = 288


def start_days(slots: DataFrame, longest_slots: int, slot_col: str = "MeterSampleIndex") -> DataFrame:
    """Distinct UTC days (``day``) on which a reading of at most ``longest_slots``
    slots may start that ends at one of ``slots``."""
    last = F.to_date(index_to_utc(F.col(slot_col) - 1))
    first = F.to_date(index_to_utc(F.col(slot_col) - max(longest_slots, 1)))
    return (slots.filter(F.col(slot_col) > 0)
            .select(F.explode(F.sequence(first, last)).alias("day")).distinct())


def hourly_usage_ending_at(by_day: DataFrame, slots: DataFrame, longest_slots: int, tz: str = LOCAL_TZ) -> DataFrame:
    """The rows of ``hourly_usage`` that can end at one of ``slots``, from a table
    of indexed readings partitioned by the UTC day of their start (``day``).

    Both reads of the table are joined to the few days of the slots, which Spark
    turns into dynamic partition pruning: other days aren't read. A zone at whole
    hours from UTC has each local hour inside one UTC day, so the days hold all
    readings of the hours found."""
    days = start_days(slots, longest_slots)
    near = by_day.join(F.broadcast(days), "day", "left_semi").drop("day")
    return hourly_usage_in_hours(near, hours_ending_at(near, slots, tz), tz)
