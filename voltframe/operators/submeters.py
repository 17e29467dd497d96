"""Submeter -> main-meter map and submeter exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


METER_INFO_COLUMNS = ["BI_ACCT", "BI_MTR_NBR", "BI_MTR_POS_NBR", "BI_MTR_CONFIG"]
# the no-submeter table is keyed by slot indices rather than timestamps
NOSUB_KEY = ["MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel",
             "StartMeterSampleIndex", "EndMeterSampleIndex"]


def normalize_meter_info(meter_info: DataFrame) -> DataFrame:
    """Ids arrive as text in the CSV export; cast them once at the source."""
    return meter_info.select(
        F.col("BI_ACCT").try_cast("int").alias("BI_ACCT"),
        F.col("BI_MTR_NBR").try_cast("int").alias("BI_MTR_NBR"),
        F.col("BI_MTR_POS_NBR").try_cast("int").alias("BI_MTR_POS_NBR"),
        F.col("BI_MTR_CONFIG").cast("string").alias("BI_MTR_CONFIG"))


def build_submeter_map(meter_info: DataFrame, main_position: int = 1) -> DataFrame:
    """Each submeter (config 'S') paired with the position-1 meter(s) of its
    account: BI_ACCT, BI_MTR_NBR, BI_MTR_POS_NBR, BI_MTR_CONFIG, MainMeter.

    The position filter sits on the account-side input, so only main meters
    are joined (no all-pairs expansion inside a large account).
    """
    mi = normalize_meter_info(meter_info)
    subs = mi.filter(F.col("BI_MTR_CONFIG") == "S")
    mains = (mi.filter(F.col("BI_MTR_POS_NBR") == main_position)
             .select("BI_ACCT", F.col("BI_MTR_NBR").alias("MainMeter")))
    return subs.join(mains, "BI_ACCT", "inner").select(*METER_INFO_COLUMNS, "MainMeter")


def submeter_map_checks(meter_info: DataFrame, submeter_map: DataFrame) -> DataFrame:
    """Check table (Check, Position, Count): submeters, mapped rows,
    submeters without a main meter, submeters mapped more than once, and
    submeters per position."""
    mi = normalize_meter_info(meter_info)
    subs = mi.filter(F.col("BI_MTR_CONFIG") == "S")

    def total(df, name):
        return df.agg(F.count(F.lit(1)).alias("Count")).select(
            F.lit(name).alias("Check"), F.lit(None).cast("int").alias("Position"), "Count")

    without_main = subs.join(submeter_map.select("BI_MTR_NBR"), "BI_MTR_NBR", "left_anti")
    dup = (submeter_map.groupBy("BI_MTR_NBR").agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1))
    per_pos = (subs.groupBy("BI_MTR_POS_NBR").agg(F.count(F.lit(1)).alias("Count"))
               .select(F.lit("submeters_at_position").alias("Check"),
                       F.col("BI_MTR_POS_NBR").alias("Position"), "Count"))
    return (total(subs, "submeters").unionByName(total(submeter_map, "mapped"))
            .unionByName(total(without_main, "without_main"))
            .unionByName(total(dup, "mapped_more_than_once"))
            .unionByName(per_pos))


def exclude_submeters(readings: DataFrame, submeter_map: DataFrame) -> DataFrame:
    """Readings of main meters only (left anti join on the meter number). AQE
    broadcasts the submeter set if its size at run time allows."""
    subs = submeter_map.select(F.col("BI_MTR_NBR").alias("_sub")).distinct()
    return readings.join(subs, F.col("MeterNumber") == F.col("_sub"), "left_anti")
