"""System-level usage metrics over hourly per-meter usage (gold tier)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_calendar_names(hourly: DataFrame) -> DataFrame:
    return hourly.withColumnsRenamed({"LocalYear": "Year", "LocalMonth": "Month", "LocalDay": "Day"})


def hourly_totals(hourly: DataFrame) -> DataFrame:
    """All meters, units, channels and directions summed per local day-hour."""
    return (as_calendar_names(hourly).groupBy("Year", "Month", "Day", "HourEnding")
            .agg(F.sum("HourlyAMIValue").alias("AllMetersDayHourAMIValue"),
                 F.sum("HourlyVEEValue").alias("AllMetersDayHourVEEValue")))


def system_hourly_totals(indexed: DataFrame, tz: str | None = None) -> DataFrame:
    """Same rows as ``hourly_totals(hourly_usage(indexed))`` in one aggregation.

    The totals' keys (local day and hour) are a function of the per-meter
    hourly keys and the sums are exact, so summing readings directly equals
    summing the per-meter hourly sums; map-side partial aggregation then
    shuffles (day x hour)-sized partials instead of a meter x hour table.
    """
    from voltframe.functions.timeindex import LOCAL_TZ
    from voltframe.operators.hourly import with_local_parts
    h = with_local_parts(indexed, "StartMeterSampleIndex", tz or LOCAL_TZ)
    return (as_calendar_names(h).groupBy("Year", "Month", "Day", "HourEnding")
            .agg(F.sum("AMIValue").alias("AllMetersDayHourAMIValue"),
                 F.sum("VEEValue").alias("AllMetersDayHourVEEValue")))


def _mean(c: str):
    # exact sum, then one division: independent of summation order
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def month_hour_profile(totals: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Per (Year, Month, HourEnding): total, mean and median over the days.

    A month has at most 31 values per hour, far below ``accuracy``, so the
    percentile is exact (the lower median).
    """
    return (totals.groupBy("Year", "Month", "HourEnding")
            .agg(F.sum("AllMetersDayHourAMIValue").alias("AllMetersMonthHourTotalAMIValue"),
                 _mean("AllMetersDayHourAMIValue").alias("AllMetersMonthHourMeanAMIValue"),
                 F.percentile_approx("AllMetersDayHourAMIValue", 0.5, accuracy)
                  .alias("AllMetersMonthHourMedianAMIValue"),
                 F.sum("AllMetersDayHourVEEValue").alias("AllMetersMonthHourTotalVEEValue"),
                 _mean("AllMetersDayHourVEEValue").alias("AllMetersMonthHourMeanVEEValue"),
                 F.percentile_approx("AllMetersDayHourVEEValue", 0.5, accuracy)
                  .alias("AllMetersMonthHourMedianVEEValue")))


def month_hour_rank(totals: DataFrame) -> DataFrame:
    """Hours of each month ranked by mean VEE (1 = highest); ties by hour.

    The window partitions hold at most 24 rows (one month of hour profiles).
    """
    w = Window.partitionBy("Year", "Month").orderBy(
        F.col("AllMetersMonthHourMeanVEEValue").desc_nulls_last(), F.col("HourEnding").asc())
    return month_hour_profile(totals).withColumn("MonthRank", F.row_number().over(w))


def daily_rank(totals: DataFrame) -> DataFrame:
    """Hours of each day ranked by total VEE (1 = highest); ties by hour."""
    w = Window.partitionBy("Year", "Month", "Day").orderBy(
        F.col("AllMetersDayHourVEEValue").desc_nulls_last(), F.col("HourEnding").asc())
    return totals.withColumn("DailyRank", F.row_number().over(w))


def top_hours(totals: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` system hours with the largest VEE total (a top-k report)."""
    return totals.orderBy(F.col("AllMetersDayHourVEEValue").desc_nulls_last(),
                          "Year", "Month", "Day", "HourEnding").limit(n)


def ami_vee_report(hourly: DataFrame, by) -> DataFrame:
    """Count of hours where AMI and VEE differ and the summed absolute
    difference, grouped by ``by`` (e.g. ["HourEnding"], ["DATE"], ["Year", "Month"])."""
    ami, vee = F.col("HourlyAMIValue"), F.col("HourlyVEEValue")
    hours = as_calendar_names(hourly).withColumn("DATE", F.make_date("Year", "Month", "Day"))
    out = hours.groupBy(*by).agg(F.count_if(ami != vee).alias("DIFF_COUNT_SUM"),
                                 F.sum(F.abs(ami - vee)).alias("VEE_AMI_DIFF_SUM"))
    if list(by) == ["HourEnding"]:
        out = out.withColumn("DIFF_COUNT_AVG", F.try_divide(
            F.col("VEE_AMI_DIFF_SUM").cast("double"), F.col("DIFF_COUNT_SUM").cast("double")))
    return out
