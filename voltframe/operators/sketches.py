"""Mergeable sketches: usage quantiles (KLL) and sets of meters (theta).

A day's sketch is a few kilobytes whatever the number of meters. Months are
merged from days, so a batch costs the sketches of the days that it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a KLL sketch, and the rank error that its quantiles stay within (the
#: normalised error of this size is about 0.7 % with 99 % confidence, merged or not).
KLL_K = 400
RANK_ERROR = 0.02
#: log2 of the entries of a theta sketch: exact up to so many distinct meters, then
#: with a relative standard error of 2 ** (-LG_ENTRIES / 2) of the union.
LG_ENTRIES = 12

DAY = ["LocalYear", "LocalMonth", "LocalDay"]
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def day_sketches(hourly: DataFrame, by: str = "UnitOfMeasure", value: str = "HourlyVEEValue") -> DataFrame:
    """``by``, day and the KLL sketch of the day's hourly values (nulls don't count)."""
    return (hourly.filter(F.col(value).isNotNull()).groupBy(by, *DAY)
            .agg(F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K).alias("sketch")))


def with_days(sketches: DataFrame, fresh: DataFrame) -> DataFrame:
    """Sketches of all days, those of the days in ``fresh`` taken from there."""
    days = F.broadcast(fresh.select(*DAY).distinct())  # calendar days
    return sketches.join(days, DAY, "left_anti").unionByName(fresh)


def month_quantiles(sketches: DataFrame, by: str = "UnitOfMeasure", quantiles=QUANTILES) -> DataFrame:
    """``by, LocalYear, LocalMonth, Quantile, Value`` from the days' sketches."""
    months = sketches.groupBy(by, "LocalYear", "LocalMonth").agg(
        F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"))
    each = F.array(*[F.struct(F.lit(float(x)).alias("Quantile"),
                              F.kll_sketch_get_quantile_double("sketch", F.lit(float(x))).alias("Value"))
                     for x in quantiles])
    return months.select(by, "LocalYear", "LocalMonth", F.explode(each).alias("q")).select(
        by, "LocalYear", "LocalMonth", "q.Quantile", "q.Value")


def rank_errors(quantiles: DataFrame, hourly: DataFrame, by: str = "UnitOfMeasure",
                value: str = "HourlyVEEValue") -> DataFrame:
    """``quantiles`` with ``Hours`` (values in the month) and ``RankError``: how far
    the quantile is from the exact ranks of its value, as a share of the hours."""
    month = [by, "LocalYear", "LocalMonth"]
    there = hourly.filter(F.col(value).isNotNull()).select(*month, F.col(value).cast("double").alias("x"))
    # equal values are one row; each meets the month's few quantiles
    counted = there.groupBy(*month, "x").agg(F.count(F.lit(1)).alias("n"))
    got = (counted.join(F.broadcast(quantiles), month)
           .groupBy(*month, "Quantile").agg(
               F.first("Value").alias("Value"), F.sum("n").alias("Hours"),
               F.sum(F.when(F.col("x") < F.col("Value"), F.col("n")).otherwise(0)).alias("under"),
               F.sum(F.when(F.col("x") <= F.col("Value"), F.col("n")).otherwise(0)).alias("upto")))
    low, high = F.col("under") / F.col("Hours"), F.col("upto") / F.col("Hours")
    return (got.withColumn("RankError", F.greatest(F.lit(0.0), low - F.col("Quantile"), F.col("Quantile") - high))
            .drop("under", "upto"))


def meter_sets(readings: DataFrame, programs: DataFrame, submeters: DataFrame, by: str = "UnitOfMeasure") -> DataFrame:
    """Distinct meters per ``by``: with readings, with a programme too, without one,
    that are submeters, and of readings or programmes together. Sets are theta
    sketches; union, intersection and difference work on the sketches alone."""
    def sketch(df: DataFrame, col: str, name: str) -> DataFrame:
        return df.agg(F.theta_sketch_agg(F.col(col).cast("long"), LG_ENTRIES).alias(name))
    read = readings.groupBy(by).agg(F.theta_sketch_agg(F.col("MeterNumber").cast("long"), LG_ENTRIES).alias("r"))
    # one row each
    sets = (read.join(F.broadcast(sketch(programs, "BI_MTR_NBR", "p")))
            .join(F.broadcast(sketch(submeters, "BI_MTR_NBR", "s"))))

    def size(s):
        return F.theta_sketch_estimate(s)
    return sets.select(by, size("r").alias("ReadingMeters"), size(F.theta_intersection("r", "p")).alias("WithProgram"),
                       size(F.theta_difference("r", "p")).alias("WithoutProgram"),
                       size(F.theta_intersection("r", "s")).alias("Submeters"),
                       size(F.theta_union("r", "p", LG_ENTRIES)).alias("ReadingOrProgram"))


def submeters_without_main(meter_info: DataFrame, submeter_map: DataFrame) -> DataFrame:
    """One row: distinct submeters, those mapped to a main meter, those without."""
    subs = (meter_info.filter(F.col("BI_MTR_CONFIG") == "S")
            .agg(F.theta_sketch_agg(F.col("BI_MTR_NBR").cast("long"), LG_ENTRIES).alias("s")))
    mapped = submeter_map.agg(F.theta_sketch_agg(F.col("BI_MTR_NBR").cast("long"), LG_ENTRIES).alias("m"))
    both = subs.join(F.broadcast(mapped))
    return both.select(F.theta_sketch_estimate("s").alias("Submeters"),
                       F.theta_sketch_estimate(F.theta_intersection("s", "m")).alias("Mapped"),
                       F.theta_sketch_estimate(F.theta_difference("s", "m")).alias("WithoutMain"))
