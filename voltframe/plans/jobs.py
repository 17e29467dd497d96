"""Batch jobs: the three entry points of the reference as runnable Spark
jobs that read their inputs, apply the quality gates and write parquet
tables (overwrite), one folder per table under ``out_root``.

A. readings:     bronze -> cleaned -> indexed -> no-submeters -> hourly
                 (all / no-subs) -> hourly totals, month-hour rank, daily
                 rank, daily diagnostics
B. load control: event text -> periods -> points -> controlled-hours analysis
C. peaks:        workbook cells -> coincident peaks + monthly substation
                 load -> indexed peaks -> peak totals, peak rows by
                 load-control meter, year-month dimension

Stages that feed several outputs are written first and read back, so every
output job starts from a table rather than from the full lineage (and a lost
executor only recomputes from the last written table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.operators import diagnostics as D
from voltframe.operators import hourly as H
from voltframe.operators import loadcontrol as L
from voltframe.operators import peaks as P
from voltframe.operators import readings as R
from voltframe.operators import submeters as S
from voltframe.operators import usage as U
from voltframe.operators.quality import require_no_nulls, require_unique
from voltframe.session import ensure_checkpoint_dir
from voltframe.sources.tables import write_table


class Outputs:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame, partition_by=None) -> DataFrame:
        write_table(df, self.path(name), "overwrite", partition_by)
        return self.spark.read.parquet(self.path(name))


def _by_day(df: DataFrame) -> DataFrame:
    """Reading tables are partitioned by the UTC day of the reading start, so
    day and time-range filters prune partitions."""
    return df.withColumn("day", F.to_date("StartDateTime"))


READING_PARTS = ["day"]
HOURLY_PARTS = ["LocalYear", "LocalMonth"]


def run_readings_job(spark: SparkSession, bronze: DataFrame, meter_info: DataFrame,
                     out_root: str, gates: bool = True) -> dict[str, DataFrame]:
    o = Outputs(spark, out_root)
    cleaned = R.clean_readings(R.drop_header_rows(bronze))
    if gates:
        # computed once: the gate and the write both read the checkpoint (in
        # the shared folder named by spark.checkpoint.dir)
        ensure_checkpoint_dir(spark)
        cleaned = cleaned.checkpoint()
        require_unique(cleaned, R.READING_KEY, "cleaned readings")
    cleaned = o.write("cleaned", _by_day(cleaned), READING_PARTS).drop("day")
    indexed = R.index_readings(cleaned)
    if gates:
        require_no_nulls(indexed, ["StartMeterSampleIndex", "EndMeterSampleIndex"], "indexed readings")
    indexed = o.write("indexed", _by_day(indexed), READING_PARTS).drop("day")
    smap = o.write("submeter_map", S.build_submeter_map(meter_info))
    nosub = o.write("nosub", _by_day(S.exclude_submeters(indexed, smap)), READING_PARTS).drop("day")
    hourly = o.write("hourly", H.hourly_usage(indexed), HOURLY_PARTS)
    # exclusion is per meter and the hourly groups include the meter, so the
    # main-meter hourly table comes from the hourly table, not a second pass
    # over the readings
    hourly_nosub = o.write("hourly_nosub", S.exclude_submeters(hourly, smap), HOURLY_PARTS)
    out = {"cleaned": cleaned, "indexed": indexed, "submeter_map": smap, "nosub": nosub,
           "hourly": hourly, "hourly_nosub": hourly_nosub,
           "daily_diagnostics": o.write("daily_diagnostics", D.daily_diagnostics(indexed))}
    out.update(refresh_usage_gold(spark, hourly_nosub, out_root))
    return out


def refresh_usage_gold(spark: SparkSession, hourly_nosub: DataFrame, out_root: str) -> dict[str, DataFrame]:
    """Gold usage tables from the (incrementally maintained) hourly table:
    system totals per local day-hour, the month-hour profile ranked by mean
    VEE, and the hours of each day ranked by VEE."""
    o = Outputs(spark, out_root)
    totals = o.write("hourly_totals", U.hourly_totals(hourly_nosub))
    return {"hourly_totals": totals,
            "month_hour_rank": o.write("month_hour_rank", U.month_hour_rank(totals)),
            "daily_rank": o.write("daily_rank", U.daily_rank(totals))}


def run_load_control_job(spark: SparkSession, lc_text: DataFrame, meter_map: DataFrame,
                         indexed: DataFrame, out_root: str, program_col: str = "BI_LOAD_TYPE",
                         gates: bool = True) -> dict[str, DataFrame]:
    o = Outputs(spark, out_root)
    periods = L.index_lc_periods(lc_text)
    if gates:
        require_no_nulls(periods, ["StartMeterSampleIndex", "EndMeterSampleIndex"], "load-control periods")
    periods = o.write("lc_periods", periods)
    points = o.write("lc_points", L.expand_lc_periods(periods))
    return {"lc_periods": periods, "lc_points": points,
            "lc_analysis": o.write("lc_analysis", L.load_control_analysis(points, meter_map, indexed,
                                                                          program_col))}


def run_peak_job(spark: SparkSession, cells: DataFrame, hourly: DataFrame, hourly_nosub: DataFrame,
                 load_types: DataFrame, rates: DataFrame, out_root: str) -> dict[str, DataFrame]:
    o = Outputs(spark, out_root)
    peaks = o.write("coincident_peaks", P.coincident_peaks(cells))
    load = o.write("monthly_substation_load", P.monthly_substation_load(cells))
    ipk = o.write("indexed_peaks", P.index_peaks(peaks))
    rows = o.write("peak_by_lc_meter", P.peak_by_lc_meter(hourly, ipk, load_types))
    return {"coincident_peaks": peaks, "monthly_substation_load": load, "indexed_peaks": ipk,
            "peak_total": o.write("peak_total", P.peak_total(hourly_nosub, ipk)),
            "peak_by_lc_meter": rows,
            "year_month_dim": o.write("year_month_dim", P.year_month_dim(rows, rates))}
