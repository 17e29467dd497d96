"""Load control on intervals equals load control on points, row for row."""

import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from voltframe.operators import intervals as I
from voltframe.operators import loadcontrol as L
from voltframe.plans.incremental import update_lc_analysis
from voltframe.plans.pipeline import Pipeline


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_segments_have_the_points_of_the_expansion(spark):
    """Overlap fan-out, a stop before the start, an id named twice, two programmes of one id."""
    text = spark.createDataFrame([
        ("11/3/2024", "IR1", "1:30", "5:00"), ("11/3/2024", "IR1", "0:30", "1:15"), ("3/10/2024", "IR1", "2:30", "5:00"),
        ("1/5/2024", "A B", "6:00", "9:00"), ("1/5/2024", "A_B", "6:00", "9:00"), ("01/05/2024", "A B", "6:00", "9:00"),
        ("1/6/2024", "DF1", "22:00", "1:00"), ("1/6/2024", "DF1", "9:00", "5:30"), ("1/6/2024", "DF1", "7:00", "8:00"),
        (None, "DF1", "7:00", "8:00")], "Date string, Program string, StartTime string, StopTime string")
    periods = L.index_lc_periods(text)
    points = L.expand_lc_periods(periods)
    want = points.groupBy("Program", "LoadControlEventID", "MeterSampleIndex").agg(
        F.count(F.lit(1)).alias("weight"), (F.max("LoadControlEvent") == 1).alias("on"),
        (F.min("LoadControlEvent") == 0).alias("off"))
    got = I.event_segments(periods).select("Program", "LoadControlEventID", F.explode(F.sequence("lo", "hi")), "weight",
                                           "on", "off")
    assert rows(got) == rows(want)
    cover = I.program_coverage(I.event_segments(periods)).select("Program", F.explode(F.sequence("lo", "hi")), "cover")
    assert rows(cover) == rows(points.groupBy("Program", "MeterSampleIndex").count())


@pytest.mark.parametrize("distinct_types", [False, True])
def test_intervals_equal_points(spark, distinct_types):
    p = Pipeline.of(spark, SF_SMALL)
    for periods, programs, col, indexed in ((p.lc_periods_wide, p.fx.fx_load_types_wide, "Program", p.indexed_dst),
                                            (p.lc_periods, p.fx.fx_load_types, "BI_LOAD_TYPE", p.indexed)):
        want = L.load_control_analysis(L.expand_lc_periods(periods), programs, indexed, col,
                                       distinct_types=distinct_types)
        got = I.load_control_intervals(periods, programs, indexed, col, distinct_types=distinct_types)
        assert got.columns == want.columns and rows(got) == rows(want)
        assert want.count() > 0


def test_incremental_takes_the_sample_length_from_the_readings(spark):
    """Samples of three hours: a group's first reading ends long before the cut."""
    p = Pipeline.of(spark, SF_SMALL)
    long = p.indexed.withColumn("StartMeterSampleIndex", F.col("StartMeterSampleIndex") - 33)
    for analysis, events in ((L.load_control_analysis, p.lc_points), (I.load_control_intervals, p.lc_periods)):
        full = analysis(events, p.fx.fx_load_types, long)
        last = full.agg(F.max("EndMeterSampleIndex")).first()[0]
        cut = last - 1500
        old = analysis(events, p.fx.fx_load_types, long.filter(F.col("EndMeterSampleIndex") <= cut))
        got = update_lc_analysis(old, events, p.fx.fx_load_types, long, cut, analysis=analysis)
        assert 0 < old.count() < full.count()
        assert rows(got.select(full.columns)) == rows(full)


def test_sweep_sums_one_bin_of_a_key_at_a_time(spark):
    from voltframe.plans.explain import plan_text
    p = Pipeline.of(spark, SF_SMALL)
    plan = plan_text(I.program_coverage(I.event_segments(p.lc_periods_wide)))
    assert "partial_sum" in plan  # deltas are added up before they are shuffled
    assert any("Window" in line and "bin" in line for line in plan.splitlines())


def test_dealt_sweeps_give_the_same_intervals(spark):
    p = Pipeline.of(spark, SF_SMALL)
    args = (p.lc_periods_wide, p.fx.fx_load_types_wide, p.indexed_dst, "Program")
    got = I.load_control_intervals(*args, parts=5)
    assert rows(got) == rows(I.load_control_intervals(*args))
    from voltframe.plans.explain import plan_text
    # one exchange for a sweep, and the profile's text goes with no interval
    sweeps = [ln for ln in plan_text(got).splitlines() if "Exchange hashpartitioning" in ln and "bin" in ln and ", 5)" in ln]
    assert sweeps and not any("Window" in ln and "entries" in ln for ln in plan_text(got).splitlines())


def test_incremental_runs_start_from_tables(spark):
    """The result's own plan is the upsert of two tables, whatever led to them."""
    from voltframe.plans.catalog import QUERIES
    from voltframe.plans.explain import plan_text
    plan = plan_text(QUERIES["lc_incremental"](spark, SF_SMALL))
    assert "Window" not in plan and "events.parquet" not in plan
    assert plan.count("lc-existing") and plan.count("lc-fresh")
