"""Incremental maintenance of the hourly and load-control tables.

A change batch touches some (meter, unit, direction, channel, local hour)
groups. Only those whole hours are re-aggregated from the upstream table and
upserted into the hourly table -- late or corrected readings for any past
hour are absorbed, and no partial hour is written. New load-control points
are folded in the same way (``update_lc_analysis``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.timeindex import LOCAL_TZ, STEP_MINUTES
from voltframe.operators import changes as C
from voltframe.operators import hourly as H
from voltframe.operators.loadcontrol import load_control_analysis


def rebuild_hours(upstream_indexed: DataFrame, changed_indexed: DataFrame,
                  tz: str = LOCAL_TZ) -> DataFrame:
    """Hourly rows of every hour touched by ``changed_indexed``, recomputed
    from ``upstream_indexed`` (which already contains the changes)."""
    def with_hour(df):
        return H.with_local_parts(df, "StartMeterSampleIndex", tz)
    scope = C.reaggregation_scope(upstream_indexed, changed_indexed, H.HOURLY_KEY, with_hour)
    return (scope.groupBy(*H.HOURLY_KEY)
            .agg(*H.hourly_aggs()))


def apply_hourly(hourly: DataFrame, upstream_indexed: DataFrame, changed_indexed: DataFrame,
                 tz: str = LOCAL_TZ) -> DataFrame:
    """New hourly table = old hourly table upserted with the rebuilt hours."""
    return C.upsert(hourly, rebuild_hours(upstream_indexed, changed_indexed, tz), H.HOURLY_KEY)


# ------------------------------------------------------------ load control

SLOTS_PER_HOUR = 60 // STEP_MINUTES
LC_KEY = ["BI_ACCT", "BI_SRV_LOC_NBR", "MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel",
          "Year", "Month", "Day", "HourEnding", "LoadControlEventID", "BI_LOAD_TYPE"]


def update_lc_analysis(existing: DataFrame | None, points: DataFrame, meter_map: DataFrame,
                       indexed: DataFrame, since_index: int | Column, program_col: str = "BI_LOAD_TYPE",
                       tz: str = LOCAL_TZ, analysis=load_control_analysis, keep=None) -> DataFrame:
    """Fold everything after ``since_index`` into the analysis table.

    Groups (meter, local hour, event, load type) that have a reading ending
    after ``since_index`` are recomputed from *all* their readings and upserted
    on the group key -- no partial hour is appended (the reference appends
    the rows after its cut-off, so an hour split by it gets two rows).
    A group's readings start inside one hour, so none of them ends earlier than
    an hour and the longest sample before ``since_index``; that length comes from
    the readings themselves. Fulfilment at a slot only depends on the events at
    that slot. ``analysis`` is ``load_control_analysis`` with points or
    ``load_control_intervals`` with periods. The upsert reads the recomputed
    groups twice; ``keep`` (``tables.stored``, say) may store them in between.
    """
    since = since_index if isinstance(since_index, Column) else F.lit(since_index)
    longest = indexed.agg(F.coalesce(F.max(F.col("EndMeterSampleIndex") - F.col("StartMeterSampleIndex")),
                                     F.lit(0))).scalar()
    fresh = (analysis(points, meter_map, indexed, program_col, since_index=since - SLOTS_PER_HOUR - longest, tz=tz)
             .filter(F.col("EndMeterSampleIndex") > since))
    fresh = keep(fresh) if keep else fresh
    if existing is None:
        return fresh
    return C.upsert(existing, fresh, LC_KEY)
