"""Load-control (demand-response) events: indexing, expansion, fulfilment
and the controlled-hours analysis.

Scale notes
-----------
* Event periods expand to points with ``explode(sequence)`` on the executors
  (each event row expands in its own task).
* Fulfilment ("every programme of the meter is under control at this slot")
  depends only on the meter's programme *profile* -- the multiset of its
  programmes. It is computed once per (profile, slot) and joined to meters,
  instead of joining every point to every meter of the programme map.
* The analysis filters the readings map-side (fulfilled slots, meter
  profiles) and joins them to dimension-sized, de-duplicated programme-map
  rows and points, so the readings are shuffled once, for the aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.text import event_id, parse_local_datetime, program_id
from voltframe.functions.timeindex import (LOCAL_TZ, local_wall_instants, sample_minutes,
                                           serial_index)
from voltframe.operators.hourly import with_local_parts

LC_TEXT_COLUMNS = ["Date", "Program", "StartTime", "StopTime"]


def _local_index(local_col: str, out_col: str, tz: str, ambiguous: str = "all"):
    """Slots whose local wall time equals ``local_col``: with
    ``ambiguous="all"`` an explode_outer of the 0, 1 or 2 slots (left-join
    semantics against the calendar; the autumn overlap fans out), with
    ``"first"``/``"last"`` the earlier/later slot only (null in the gap)."""
    slots = F.transform(local_wall_instants(F.col(local_col), tz), lambda u: serial_index(u))
    if ambiguous == "all":
        return F.explode_outer(slots).alias(out_col)
    if ambiguous not in ("first", "last"):
        raise ValueError(f"ambiguous must be 'all', 'first' or 'last', not {ambiguous!r}")
    return F.try_element_at(slots, F.lit(1 if ambiguous == "first" else -1)).alias(out_col)


def index_lc_periods(events: DataFrame, tz: str = LOCAL_TZ, ambiguous: str = "all") -> DataFrame:
    """Landing text (Date, Program, StartTime, StopTime; local time) ->
    periods with start/end slot indices, length and event id.

    A local time in the spring DST gap gets a null index; one in the autumn
    overlap gets both slots (two rows), exactly like a join on local
    calendar parts. Stop time shares the start's date.
    """
    ts = (events.select(*LC_TEXT_COLUMNS).dropDuplicates()
          .withColumn("StartDateTime", parse_local_datetime("Date", "StartTime"))
          .withColumn("EndDateTime", parse_local_datetime("Date", "StopTime")))
    with_start = ts.select("*", _local_index("StartDateTime", "StartMeterSampleIndex", tz, ambiguous))
    both = with_start.select("*", _local_index("EndDateTime", "EndMeterSampleIndex", tz, ambiguous))
    return (both
            .withColumn("TotalTime_Minutes",
                        sample_minutes("StartMeterSampleIndex", "EndMeterSampleIndex"))
            .withColumn("ProgramId", program_id("Program"))
            .withColumn("LoadControlEventID", event_id("Program", "StartDateTime", "EndDateTime")))


def period_quality(periods: DataFrame) -> DataFrame:
    """Periods the expansion cannot use: a missing index (spring gap, off
    grid, outside the calendar) or a stop before the start (midnight)."""
    return periods.filter(F.col("StartMeterSampleIndex").isNull()
                          | F.col("EndMeterSampleIndex").isNull()
                          | (F.col("TotalTime_Minutes") < 0))


def expand_lc_periods(periods: DataFrame, start_offset: int = -48,
                      end_offset: int = 48) -> DataFrame:
    """Period -> one row per slot in [start+start_offset, end+end_offset].

    ``LoadControlEvent`` is 1 inside (start, end] and 0 in the shoulders.
    A period whose padded range is empty (stop before start) yields no
    points; periods without indices yield none either.
    """
    p = periods.filter(F.col("StartMeterSampleIndex").isNotNull()
                       & F.col("EndMeterSampleIndex").isNotNull())
    lo = F.col("StartMeterSampleIndex") + start_offset
    hi = F.col("EndMeterSampleIndex") + end_offset
    pts = (p.filter(lo <= hi)
           .select("LoadControlEventID", "Program",
                   F.explode(F.sequence(lo, hi)).alias("MeterSampleIndex")))
    # every point is flagged against the bounds of its event id
    bounds = p.select("LoadControlEventID", "StartMeterSampleIndex", "EndMeterSampleIndex")
    flag = F.when((F.col("MeterSampleIndex") > F.col("StartMeterSampleIndex"))
                  & (F.col("MeterSampleIndex") <= F.col("EndMeterSampleIndex")), F.lit(1)
                  ).otherwise(F.lit(0))
    return (pts.join(bounds, "LoadControlEventID", "inner")
            .select("LoadControlEventID", "Program", "MeterSampleIndex",
                    flag.alias("LoadControlEvent")))


# ------------------------------------------------------------------ fulfilment

def program_map(meter_map: DataFrame, program_col: str) -> DataFrame:
    """Programme-map columns; ids exported as text are cast once here (T8)."""
    ids = {c: F.col(c).try_cast("int").alias(c) for c in ("BI_ACCT", "BI_SRV_LOC_NBR", "BI_MTR_NBR")}
    return meter_map.select(ids["BI_ACCT"], ids["BI_SRV_LOC_NBR"], ids["BI_MTR_NBR"], "BI_LOAD_TYPE",
                            F.col(program_col).alias("_prog"))


def meter_profiles(meter_map: DataFrame, program_col: str = "BI_LOAD_TYPE",
                   distinct_types: bool = False) -> DataFrame:
    """Per meter: its profile key and ProgramCount.

    ProgramCount counts map rows with a load type (the reference's
    ``count(BI_LOAD_TYPE)``). The profile lists, per programme, how many rows
    count (``w``) and how many rows exist (``e``); meters with equal profiles
    have equal fulfilment. Entries per meter are bounded by the number of
    distinct programmes.

    ``distinct_types=True`` counts each (programme, load type) of a meter
    once, so duplicate map rows do not inflate the counts (the reference
    counts rows); pair it with ``profile_fulfilment(..., distinct_types=True)``
    so that overlapping events of one programme count once per slot.
    """
    m = program_map(meter_map, program_col)
    if distinct_types:
        m = m.dropDuplicates(["BI_MTR_NBR", "_prog", "BI_LOAD_TYPE"])
    pc = m.groupBy("BI_MTR_NBR").agg(F.count("BI_LOAD_TYPE").alias("ProgramCount"))
    entries = (m.filter(F.col("_prog").isNotNull())
               .groupBy("BI_MTR_NBR", "_prog")
               .agg(F.count("BI_LOAD_TYPE").alias("w"), F.count(F.lit(1)).alias("e"))
               .groupBy("BI_MTR_NBR")
               .agg(F.array_sort(F.collect_list(F.struct("_prog", "w", "e"))).alias("entries")))
    return (entries.join(pc, "BI_MTR_NBR")
            .withColumn("ProfileKey", F.to_json(F.struct("entries", "ProgramCount"))))


def profile_fulfilment(points: DataFrame, profiles: DataFrame,
                       distinct_types: bool = False) -> DataFrame:
    """(ProfileKey, MeterSampleIndex, ProgramCount, Count, ProgramDiff, Meters)
    for every slot where at least one programme of the profile has a point.

    ``Count`` = number of (map row with a load type, point) pairs a meter of
    the profile has at the slot, as in the reference's row counting.
    """
    prof = profiles.groupBy("ProfileKey", "ProgramCount", "entries").agg(
        F.count(F.lit(1)).alias("Meters"))
    cover = points.groupBy("Program", "MeterSampleIndex").agg(F.count(F.lit(1)).alias("cover"))
    if distinct_types:
        cover = cover.withColumn("cover", F.lit(1).cast("bigint"))
    ent = prof.select("ProfileKey", "ProgramCount", "Meters",
                      F.explode("entries").alias("x")).select(
        "ProfileKey", "ProgramCount", "Meters", F.col("x._prog").alias("Program"),
        F.col("x.w").alias("w"))
    return (ent.join(cover, "Program")
            .groupBy("ProfileKey", "MeterSampleIndex", "ProgramCount", "Meters")
            .agg(F.sum(F.col("w") * F.col("cover")).alias("Count"))
            .withColumn("ProgramDiff", F.col("ProgramCount") - F.col("Count")))


def fulfilled_by_meter(points: DataFrame, meter_map: DataFrame,
                       program_col: str = "BI_LOAD_TYPE", distinct_types: bool = False) -> DataFrame:
    """Per meter: number of fully controlled slots and their first/last index."""
    prof = meter_profiles(meter_map, program_col, distinct_types)
    per_profile = (profile_fulfilment(points, prof, distinct_types).filter(F.col("ProgramDiff") == 0)
                   .groupBy("ProfileKey")
                   .agg(F.count(F.lit(1)).alias("FulfilledPoints"),
                        F.min("MeterSampleIndex").alias("FirstIndex"),
                        F.max("MeterSampleIndex").alias("LastIndex")))
    return prof.select("BI_MTR_NBR", "ProfileKey").join(per_profile, "ProfileKey").drop("ProfileKey")


def shortfall_distribution(points: DataFrame, meter_map: DataFrame,
                           program_col: str = "BI_LOAD_TYPE") -> DataFrame:
    """How many (meter, slot) pairs miss 0, 1, 2, ... of their programmes."""
    pf = profile_fulfilment(points, meter_profiles(meter_map, program_col))
    return pf.groupBy("ProgramDiff").agg(F.sum("Meters").alias("count"))


LC_GROUP = ["BI_ACCT", "BI_SRV_LOC_NBR", "MeterNumber", "UnitOfMeasure", "FlowDirection",
            "Channel", "LocalYear", "LocalMonth", "LocalDay", "HourEnding",
            "LoadControlEventID", "BI_LOAD_TYPE"]


def load_control_analysis(points: DataFrame, meter_map: DataFrame, indexed: DataFrame,
                          program_col: str = "BI_LOAD_TYPE", since_index: int = 1,
                          tz: str = LOCAL_TZ, direction: str = "F", channel: int = 1,
                          distinct_types: bool = False) -> DataFrame:
    """Hourly readings of meters while *all* their programmes are controlled.

    Points after ``since_index`` are paired with the programme map; a
    (meter, slot) is fulfilled when the matched row count equals the meter's
    programme count; forward channel-1 readings ending at a fulfilled slot
    are summed per local hour and event (event flag = min over the hour).

    Readings are only filtered and joined against dimension-sized inputs: the
    fulfilled slots (at most one row per calendar slot, broadcast), the
    programme map with meter profiles, the points and the fulfilled (profile,
    slot) pairs; AQE picks these joins at run time.
    """
    pts = points.filter(F.col("MeterSampleIndex") > since_index)
    prof = meter_profiles(meter_map, program_col, distinct_types)
    ok = (profile_fulfilment(pts, prof, distinct_types).filter(F.col("ProgramDiff") == 0)
          .select("ProfileKey", F.col("MeterSampleIndex").alias("_i")))
    # Slots where any profile is fulfilled: at most one row per calendar slot
    # (MAX_INDEX ints), so broadcasting it is bounded; it trims the readings
    # map-side, before any shuffle, to the few slots under control.
    slots = F.broadcast(ok.select(F.col("_i").alias("_slot")).distinct())
    rd = (indexed.filter((F.col("FlowDirection") == direction) & (F.col("Channel") == channel)
                         & F.col("EndMeterSampleIndex").isNotNull())
          .join(slots, F.col("EndMeterSampleIndex") == F.col("_slot"), "left_semi"))
    # distinct (account, location, type, programme) rows per meter, with the
    # meter's profile; AQE picks the joins from the sides' sizes at run time
    mp = (program_map(meter_map, program_col).dropDuplicates()
          .join(prof.select("BI_MTR_NBR", "ProfileKey"), "BI_MTR_NBR"))
    pt = (pts.select(F.col("Program").alias("_pp"), F.col("MeterSampleIndex").alias("_pi"),
                     "LoadControlEventID", "LoadControlEvent").dropDuplicates())
    # readings of map meters at slots where their profile is fulfilled
    rd = (rd.join(mp, F.col("MeterNumber") == F.col("BI_MTR_NBR"))
          .join(ok.select(F.col("ProfileKey").alias("_pk"), F.col("_i").alias("_oi")),
                (F.col("ProfileKey") == F.col("_pk")) & (F.col("EndMeterSampleIndex") == F.col("_oi")),
                "left_semi"))
    joined = rd.join(pt, (F.col("_prog") == F.col("_pp")) & (F.col("EndMeterSampleIndex") == F.col("_pi")))
    return controlled_hours(joined, indexed.columns, tz)


def controlled_hours(joined: DataFrame, reading_columns: list[str], tz: str = LOCAL_TZ) -> DataFrame:
    """Readings paired with the events that control them -> sums per local hour
    and event.

    An event id reached through two programmes would pair a reading with the
    same (event, type) twice: only distinct rows count.
    """
    cols = [*reading_columns, "BI_ACCT", "BI_SRV_LOC_NBR", "BI_LOAD_TYPE", "LoadControlEventID", "LoadControlEvent"]
    return (with_local_parts(joined.select(*cols).dropDuplicates(), "StartMeterSampleIndex", tz)
            .groupBy(*LC_GROUP)
            .agg(F.sum("AMIValue").alias("HourlyAMIValue"),
                 F.sum("VEEValue").alias("HourlyVEEValue"),
                 F.max("EndMeterSampleIndex").alias("EndMeterSampleIndex"),
                 F.min("LoadControlEvent").alias("LoadControlEvent"))
            .withColumnsRenamed({"LocalYear": "Year", "LocalMonth": "Month", "LocalDay": "Day"}))


# ------------------------------------------------------- customer-system lookup

def meter_program_rows(service: DataFrame, lm_srv: DataFrame, lm_dvc: DataFrame,
                       ref: DataFrame, mtr: DataFrame) -> DataFrame:
    """Active electric services x load-management devices x meters (all
    join rows, before DISTINCT)."""
    s = service.filter((F.col("BI_TYPE_SRV_GRP") == "ELEC") & F.col("BI_DISC_DT").isNull()).alias("s")
    l, d, r, m = lm_srv.alias("l"), lm_dvc.alias("d"), ref.alias("r"), mtr.alias("m")
    return (s.join(l, F.col("s.BI_SRV_LOC_NBR") == F.col("l.BI_SRV_LOC_NBR"))
             .join(d, F.col("l.BI_ACCT") == F.col("d.BI_ACCT"))
             .join(r, F.col("d.BI_LOAD_TYPE") == F.col("r.BI_LOAD_TYPE"))
             .join(m, (F.col("s.BI_ACCT") == F.col("m.BI_ACCT"))
                   & (F.col("s.BI_SRV_LOC_NBR") == F.col("m.BI_SRV_LOC_NBR"))
                   & (F.col("d.BI_MTR_POS_NBR") == F.col("m.BI_MTR_POS_NBR")))
             .select(F.col("s.BI_SRV_LOC_NBR"), F.col("s.BI_ACCT"), F.col("s.BI_CON_DT"),
                     F.col("s.BI_PRIM_RATE_SCHED"), F.col("d.BI_LOAD_TYPE"),
                     F.col("r.BI_LOAD_TYPE_DESC"), F.col("d.BI_MTR_POS_NBR"), F.col("m.BI_MTR_NBR")))


def meter_programs(*tables: DataFrame) -> DataFrame:
    return meter_program_rows(*tables).distinct()


def meters_by_load_type(*tables: DataFrame) -> DataFrame:
    return (meter_program_rows(*tables).groupBy("BI_LOAD_TYPE")
            .agg(F.count("BI_MTR_NBR").alias("METERCOUNT")))
