"""Load-control analysis on intervals: a sweep over the ends of the events in
place of one row for every slot of every event.

1. An event is a few segments (shoulder, controlled, shoulder) with the number
   of points that each of its slots would have.
2. Coverage of a programme: every segment adds its weight where it begins and
   takes it back where it ends; the running sum of what is added up per slot is
   the coverage, run-length coded.
3. Fulfilment of a profile (meters with the same programmes): the same sweep over
   the weighted coverages of its programmes; intervals whose sum equals the
   profile's programme count are fulfilled.
4. Readings meet the intervals by profile and bin, with the slot in the interval.

Everything is cut at the borders of bins of ``BIN`` slots, so a running sum sees
one (key, bin) with at most one row a slot, however many events fall there, and
the range joins have an equality key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.timeindex import LOCAL_TZ
from voltframe.operators.loadcontrol import controlled_hours, meter_profiles, program_map

BIN = 288  # slots: one day


def event_segments(periods: DataFrame, start_offset: int = -48, end_offset: int = 48,
                   since_index: int | Column = 1) -> DataFrame:
    """``Program, LoadControlEventID, lo, hi, weight, on, off``: disjoint runs of
    slots of each event after ``since_index``. ``weight`` is the number of points
    that ``expand_lc_periods`` has at each slot, ``on`` and ``off`` whether points
    with and without the event's flag are among them.

    An event id has several periods when its local times fall into the autumn
    overlap or the landing text names it twice; each of its points is flagged
    against each of its periods, so all periods of an id are swept together.
    """
    start, end = F.col("StartMeterSampleIndex"), F.col("EndMeterSampleIndex")
    one = F.struct("Program", start.alias("s"), end.alias("e"), (start + start_offset).alias("lo"),
                   (end + end_offset).alias("hi"))
    ids = (periods.filter(start.isNotNull() & end.isNotNull())
           .groupBy("LoadControlEventID").agg(F.collect_list(one).alias("bounds")))
    rows = ids.select("LoadControlEventID", "bounds",
                      F.explode(F.array_distinct(F.transform("bounds", lambda b: b["Program"]))).alias("Program"))
    rows = rows.filter(F.col("Program").isNotNull()).withColumn("ranges", F.filter(
        "bounds", lambda b: (b["Program"] == F.col("Program")) & (b["lo"] <= b["hi"])))
    ends = F.concat(F.transform("ranges", lambda r: r["lo"]), F.transform("ranges", lambda r: r["hi"] + 1),
                    F.transform("bounds", lambda b: b["s"] + 1), F.transform("bounds", lambda b: b["e"] + 1))
    rows = rows.withColumn("cuts", F.array_sort(F.array_distinct(ends)))

    def segment(cut: Column, i: Column) -> Column:
        flagged = lambda b: (b["s"] < cut) & (cut <= b["e"])
        covering = F.size(F.filter("ranges", lambda r: (r["lo"] <= cut) & (cut <= r["hi"])))
        return F.struct(cut.alias("lo"), (F.try_element_at("cuts", i + 2) - 1).alias("hi"),
                        (covering * F.size("bounds")).cast("long").alias("weight"),
                        F.exists("bounds", flagged).alias("on"),
                        F.exists("bounds", lambda b: ~flagged(b)).alias("off"))
    found = F.filter(F.transform("cuts", segment), lambda x: (x["weight"] > 0) & x["hi"].isNotNull())
    since = since_index if isinstance(since_index, Column) else F.lit(since_index)
    return (rows.select("Program", "LoadControlEventID", F.explode(found).alias("x"))
            .select("Program", "LoadControlEventID", F.greatest(F.col("x.lo"), since + 1).cast("int").alias("lo"),
                    F.col("x.hi").cast("int").alias("hi"), "x.weight", "x.on", "x.off")
            .filter("lo <= hi"))


def bin_of(slot: Column) -> Column:
    return F.floor(slot / BIN).cast("int")


def in_bins(intervals: DataFrame) -> DataFrame:
    """Intervals ``lo .. hi`` cut at the borders of bins, with their ``bin``."""
    bins = F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi"))))
    return (intervals.withColumn("bin", bins)
            .withColumns({"lo": F.greatest("lo", F.col("bin") * BIN),
                          "hi": F.least("hi", F.col("bin") * BIN + BIN - 1)}))


def swept(intervals: DataFrame, keys: list[str], sums: list[str], parts: int | None = None) -> DataFrame:
    """``keys, bin, lo, hi, sums``: the sums over the intervals that cover a slot,
    run-length coded, where the first of them or another isn't zero. With ``parts``
    the intervals are dealt out by key and bin into so many partitions, in which
    they are both added up and swept."""
    cut = in_bins(intervals.select(*keys, "lo", "hi", *sums))
    if parts:
        cut = cut.repartition(parts, *keys, "bin")
    step = F.explode(F.array(F.struct(F.col("lo").alias("at"), *[F.col(s).alias(s) for s in sums]),
                             F.struct((F.col("hi") + 1).alias("at"), *[(-F.col(s)).alias(s) for s in sums])))
    steps = (cut.select(*keys, "bin", step.alias("x")).select(*keys, "bin", "x.*")
             .filter(F.col("at") < (F.col("bin") + 1) * BIN)
             .groupBy(*keys, "bin", "at").agg(*[F.sum(s).alias(s) for s in sums]))
    along = Window.partitionBy(*keys, "bin").orderBy("at")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = steps.select(*keys, "bin", F.col("at").alias("lo"),
                        (F.coalesce(F.lead("at").over(along), (F.col("bin") + 1) * BIN) - 1).alias("hi"),
                        *[F.sum(s).over(so_far).alias(s) for s in sums])
    some = F.lit(False)
    for s in sums:
        some = some | (F.col(s) != 0)
    return runs.filter(some)


def program_coverage(segments: DataFrame, distinct_types: bool = False, parts: int | None = None) -> DataFrame:
    """``Program, bin, lo, hi, cover``: points of a programme at each slot of the
    interval (1 for any number with ``distinct_types``)."""
    cover = swept(segments.withColumnRenamed("weight", "cover"), ["Program"], ["cover"], parts)
    return cover.withColumn("cover", F.lit(1).cast("long")) if distinct_types else cover


def numbered_profiles(profiles: DataFrame) -> DataFrame:
    """``meter_profiles`` with the smallest meter of each profile for its key: the
    key's text holds all programmes, too long to go with every interval."""
    first = profiles.groupBy("ProfileKey").agg(F.min("BI_MTR_NBR").alias("_first"))
    return profiles.join(first, "ProfileKey").drop("ProfileKey").withColumnRenamed("_first", "ProfileKey")


def fulfilled_intervals(coverage: DataFrame, profiles: DataFrame, parts: int | None = None) -> DataFrame:
    """``ProfileKey, bin, lo, hi``: where the points of a profile's programmes are
    as many as its programmes, and at least one of them has a point."""
    entry = (profiles.groupBy("ProfileKey", "ProgramCount").agg(F.first("entries").alias("entries"))
             .select("ProfileKey", "ProgramCount", F.explode("entries").alias("x"))
             .select("ProfileKey", "ProgramCount", F.col("x._prog").alias("Program"), F.col("x.w").alias("w")))
    hits = entry.join(coverage, "Program").select(
        "ProfileKey", "ProgramCount", "lo", "hi", (F.col("w") * F.col("cover")).alias("hits"), F.col("cover").alias("n"))
    return (swept(hits, ["ProfileKey", "ProgramCount"], ["hits", "n"], parts)
            .filter((F.col("hits") == F.col("ProgramCount")) & (F.col("n") > 0))
            .select("ProfileKey", "bin", "lo", "hi"))


def load_control_intervals(periods: DataFrame, meter_map: DataFrame, indexed: DataFrame,
                           program_col: str = "BI_LOAD_TYPE", since_index: int | Column = 1, tz: str = LOCAL_TZ,
                           direction: str = "F", channel: int = 1, distinct_types: bool = False,
                           parts: int | None = None) -> DataFrame:
    """``load_control_analysis`` of the same events, from their periods
    (``index_lc_periods``) in place of their points: equal row for row.

    The days with a fulfilled interval (at most one row a calendar day, so
    broadcast) trim the readings before any shuffle. ``parts``: see ``swept``.
    """
    segments = event_segments(periods, since_index=since_index)
    profiles = numbered_profiles(meter_profiles(meter_map, program_col, distinct_types))
    fulfilled = fulfilled_intervals(program_coverage(segments, distinct_types, parts), profiles, parts)
    days = F.broadcast(fulfilled.select(F.col("bin").alias("_day")).distinct())
    slot = F.col("EndMeterSampleIndex")
    readings = (indexed.filter((F.col("FlowDirection") == direction) & (F.col("Channel") == channel) & slot.isNotNull())
                .withColumn("_bin", bin_of(slot)).join(days, F.col("_bin") == F.col("_day"), "left_semi"))
    meters = (program_map(meter_map, program_col).dropDuplicates()
              .join(profiles.select("BI_MTR_NBR", "ProfileKey"), "BI_MTR_NBR"))
    when = fulfilled.select(F.col("ProfileKey").alias("_key"), F.col("bin").alias("_fbin"), F.col("lo").alias("_flo"),
                            F.col("hi").alias("_fhi"))
    under = (readings.join(meters, F.col("MeterNumber") == F.col("BI_MTR_NBR"))
             .join(when, (F.col("ProfileKey") == F.col("_key")) & (F.col("_bin") == F.col("_fbin"))
                   & slot.between(F.col("_flo"), F.col("_fhi"))))
    flags = F.explode(F.filter(F.array(F.when(F.col("on"), F.lit(1)), F.when(F.col("off"), F.lit(0))),
                               lambda x: x.isNotNull()))
    events = in_bins(segments).select(F.col("Program").alias("_pp"), F.col("bin").alias("_ebin"),
                                      F.col("lo").alias("_elo"), F.col("hi").alias("_ehi"), "LoadControlEventID",
                                      flags.alias("LoadControlEvent"))
    joined = under.join(events, (F.col("_prog") == F.col("_pp")) & (F.col("_bin") == F.col("_ebin"))
                        & slot.between(F.col("_elo"), F.col("_ehi")))
    return controlled_hours(joined, indexed.columns, tz)
