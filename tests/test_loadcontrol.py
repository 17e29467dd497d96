import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from voltframe.operators import loadcontrol as L
from voltframe.operators import peaks as P
from voltframe.operators import readings as R

TEXT = "Date string, Program string, StartTime string, StopTime string"


def test_periods_dst_fanout_gap_and_midnight(spark):
    ev = spark.createDataFrame([
        ("11/3/2024", "Irr A", "1:00", "3:00"),    # 01:00 occurs twice -> two rows
        ("3/10/2024", "Irr A", "2:00", "4:00"),    # 02:00 does not exist -> null index
        ("1/5/2024", "WH 1", "22:00", "2:00"),     # stop shares the date -> negative length
        ("1/5/2024", "WH 1", "22:00", "2:00"),     # exact duplicate line
        ("1/6/2024", "WH 1", "bad", "2:00"),       # unparsable -> null
    ], TEXT)
    p = L.index_lc_periods(ev)
    rows = p.collect()
    fall = [r for r in rows if r.Date == "11/3/2024"]
    assert len(fall) == 2 and len({r.StartMeterSampleIndex for r in fall}) == 2
    assert all(r.LoadControlEventID == "Irr_A_2024-11-03 01:00:00_2024-11-03 03:00:00" for r in fall)
    spring = [r for r in rows if r.Date == "3/10/2024"]
    assert len(spring) == 1 and spring[0].StartMeterSampleIndex is None
    mid = [r for r in rows if r.Date == "1/5/2024"]
    assert len(mid) == 1 and mid[0].TotalTime_Minutes == -20 * 60
    assert L.period_quality(p).count() == 3  # spring gap, midnight, unparsable
    pts = L.expand_lc_periods(p)
    assert pts.filter(F.col("LoadControlEventID").startswith("WH_1_2024-01-05")).count() == 0


def test_expand_counts_and_flags(spark):
    ev = spark.createDataFrame([("1/5/2024", "P", "6:00", "10:00")], TEXT)
    pts = L.expand_lc_periods(L.index_lc_periods(ev)).collect()
    assert len(pts) == 48 + 97
    assert sum(r.LoadControlEvent for r in pts) == 48
    # the direct range-join form gives the same flags
    p = L.index_lc_periods(ev).first()
    assert all(r.LoadControlEvent == int(p.StartMeterSampleIndex < r.MeterSampleIndex <= p.EndMeterSampleIndex)
               for r in pts)


MAP = "BI_ACCT int, BI_SRV_LOC_NBR int, BI_MTR_NBR int, BI_LOAD_TYPE string"


def brute_force_fulfilled(points, meter_map):
    """The reference form: every point joined to every map row of its
    programme, counted per (slot, meter), compared with the programme count."""
    mts = points.join(meter_map, points.Program == meter_map.BI_LOAD_TYPE)
    dups = mts.groupBy("MeterSampleIndex", "BI_MTR_NBR").agg(F.count("BI_LOAD_TYPE").alias("Count"))
    pc = meter_map.groupBy("BI_MTR_NBR").agg(F.count("BI_LOAD_TYPE").alias("ProgramCount"))
    d = pc.join(dups, "BI_MTR_NBR").withColumn("ProgramDiff", F.col("ProgramCount") - F.col("Count"))
    return d


def test_fulfilment_cases(spark):
    ev = spark.createDataFrame([
        ("1/5/2024", "A", "6:00", "8:00"),
        ("1/5/2024", "B", "7:00", "9:00"),
        ("1/6/2024", "A", "6:00", "8:00"),
        ("1/6/2024", "A", "7:00", "8:00"),   # overlapping events of one programme
    ], TEXT)
    pts = L.expand_lc_periods(L.index_lc_periods(ev), 0, 0)
    mm = spark.createDataFrame([
        (1, 1, 10, "A"),                    # one programme
        (2, 2, 20, "A"), (2, 2, 20, "C"),   # two programmes, one ever active
        (3, 3, 30, "A"), (3, 3, 30, "B"),   # two programmes, both active at times
        (4, 4, 40, "A"), (4, 4, 40, None),  # a row without a load type
    ], MAP)
    bf = brute_force_fulfilled(pts, mm)
    want = sorted(tuple(r) for r in bf.filter("ProgramDiff = 0").groupBy("BI_MTR_NBR").agg(
        F.count(F.lit(1)), F.min("MeterSampleIndex"), F.max("MeterSampleIndex")).collect())
    got = sorted(tuple(r) for r in L.fulfilled_by_meter(pts, mm).select(
        "BI_MTR_NBR", "FulfilledPoints", "FirstIndex", "LastIndex").collect())
    assert got == want
    want_sf = sorted(tuple(r) for r in bf.groupBy("ProgramDiff").count().collect())
    got_sf = sorted(tuple(r) for r in L.shortfall_distribution(pts, mm).collect())
    assert got_sf == want_sf


def test_analysis_matches_reference_form(spark):
    ev = spark.createDataFrame([("1/5/2024", "A", "6:00", "8:00"), ("1/5/2024", "B", "7:00", "9:00")], TEXT)
    pts = L.expand_lc_periods(L.index_lc_periods(ev))
    mm = spark.createDataFrame([(1, 1, 10, "A"), (3, 3, 30, "A"), (3, 3, 30, "B")], MAP)
    rows = []
    start = dt.datetime(2024, 1, 5, 10, 0)  # 04:00 local
    for m in (10, 30, 99):
        for i in range(12 * 9):
            s = start + dt.timedelta(minutes=5 * i)
            for d in ("F", "R"):
                rows.append((m, "KWH", d, 1, s, s + dt.timedelta(minutes=5), Decimal("1.00"), Decimal("1.00")))
    rd = R.index_readings(spark.createDataFrame(rows, "MeterNumber int, UnitOfMeasure string, FlowDirection string, "
                                                "Channel int, StartDateTime timestamp, EndDateTime timestamp, "
                                                "AMIValue decimal(18,2), VEEValue decimal(18,2)"))
    got = L.load_control_analysis(pts, mm, rd)
    # reference form
    bf = brute_force_fulfilled(pts, mm).filter("ProgramDiff = 0").select("BI_MTR_NBR", "MeterSampleIndex")
    mts = pts.join(mm, pts.Program == mm.BI_LOAD_TYPE)
    fts = mts.join(bf, ["BI_MTR_NBR", "MeterSampleIndex"]).select(
        "BI_ACCT", "BI_SRV_LOC_NBR", "BI_MTR_NBR", "MeterSampleIndex", "LoadControlEventID", "BI_LOAD_TYPE",
        "LoadControlEvent").distinct()
    r2 = rd.filter("FlowDirection = 'F' AND Channel = 1")
    j = r2.join(fts, (r2.EndMeterSampleIndex == fts.MeterSampleIndex) & (r2.MeterNumber == fts.BI_MTR_NBR))
    assert got.count() > 0
    assert got.agg(F.sum("HourlyAMIValue")).first()[0] == j.agg(F.sum("AMIValue")).first()[0]
    assert set(r.MeterNumber for r in got.collect()) == {10, 30}


def test_peaks_index_dst(spark):
    pk = spark.createDataFrame([(dt.datetime(2024, 11, 3, 1, 0),), (dt.datetime(2024, 3, 10, 2, 0),),
                                (dt.datetime(2024, 7, 13, 15, 0),)], "CoincidTime timestamp")
    ip = P.index_peaks(P.peak_parts(pk)).collect()
    assert sorted(r.CoincidDay for r in ip) == [3, 3, 13]
    assert [r.MeterSampleIndex for r in ip if r.CoincidDay == 13] == [371473]


def test_incremental_lc_analysis_equals_full(spark):
    from sf_dirs import SF_SMALL
    from voltframe.plans.incremental import LC_KEY, update_lc_analysis
    from voltframe.plans.pipeline import Pipeline
    p = Pipeline(spark, SF_SMALL)
    pts, mm, ix = p.lc_points, p.fx.fx_load_types, p.indexed
    full = L.load_control_analysis(pts, mm, ix)
    # cut in the middle of an hour of an event: readings and points arrive in two runs
    cut = pts.filter("LoadControlEvent = 1").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY MeterSampleIndex)")).first()[0] + 5
    first = update_lc_analysis(None, pts.filter(F.col("MeterSampleIndex") <= cut), mm,
                               ix.filter(F.col("EndMeterSampleIndex") <= cut), since_index=1)
    second = update_lc_analysis(first, pts, mm, ix, since_index=cut)
    cols = full.columns
    assert sorted(map(tuple, second.select(cols).collect())) == sorted(map(tuple, full.collect()))
    assert second.groupBy(*LC_KEY).count().filter("count > 1").count() == 0


def test_ambiguous_policy(spark):
    ev = spark.createDataFrame([("11/3/2024", "A", "1:00", "3:00"), ("3/10/2024", "A", "2:00", "4:00")], TEXT)
    all_rows = L.index_lc_periods(ev).filter("Date = '11/3/2024'").collect()
    first = L.index_lc_periods(ev, ambiguous="first").collect()
    last = L.index_lc_periods(ev, ambiguous="last").collect()
    fall = sorted(r.StartMeterSampleIndex for r in all_rows)
    assert [r.StartMeterSampleIndex for r in first if r.Date == "11/3/2024"] == [fall[0]]
    assert [r.StartMeterSampleIndex for r in last if r.Date == "11/3/2024"] == [fall[1]]
    assert [r.StartMeterSampleIndex for r in first if r.Date == "3/10/2024"] == [None]
    pk = spark.createDataFrame([(dt.datetime(2024, 11, 3, 1, 0),)], "CoincidTime timestamp")
    assert P.index_peaks(P.peak_parts(pk), ambiguous="first").count() == 1


def _reference_analysis(pts, mm, rd):
    bf = brute_force_fulfilled(pts, mm).filter("ProgramDiff = 0").select("BI_MTR_NBR", "MeterSampleIndex")
    mts = pts.join(mm, pts.Program == mm.BI_LOAD_TYPE)
    fts = mts.join(bf, ["BI_MTR_NBR", "MeterSampleIndex"]).select(
        "BI_ACCT", "BI_SRV_LOC_NBR", "BI_MTR_NBR", "MeterSampleIndex", "LoadControlEventID", "BI_LOAD_TYPE",
        "LoadControlEvent").distinct()
    r2 = rd.filter("FlowDirection = 'F' AND Channel = 1")
    j = r2.join(fts, (r2.EndMeterSampleIndex == fts.MeterSampleIndex) & (r2.MeterNumber == fts.BI_MTR_NBR))
    from voltframe.operators.hourly import with_local_parts
    return (with_local_parts(j).groupBy(*L.LC_GROUP).agg(
        F.sum("AMIValue").alias("HourlyAMIValue"), F.sum("VEEValue").alias("HourlyVEEValue"),
        F.max("EndMeterSampleIndex").alias("EndMeterSampleIndex"),
        F.min("LoadControlEvent").alias("LoadControlEvent"))
        .withColumnsRenamed({"LocalYear": "Year", "LocalMonth": "Month", "LocalDay": "Day"}))


def test_analysis_with_event_id_shared_by_two_programmes(spark):
    # "A B" and "A_B" at the same times produce the same event id
    ev = spark.createDataFrame([("1/5/2024", "A B", "6:00", "8:00"), ("1/5/2024", "A_B", "6:00", "8:00"),
                                ("1/5/2024", "C", "6:30", "7:30")], TEXT)
    pts = L.expand_lc_periods(L.index_lc_periods(ev))
    mm = spark.createDataFrame([(1, 1, 10, "A B"), (1, 1, 10, "A_B"), (2, 2, 20, "C"), (2, 2, 20, "C")], MAP)
    rows = []
    start = dt.datetime(2024, 1, 5, 10, 0)
    for m in (10, 20):
        for i in range(12 * 6):
            s = start + dt.timedelta(minutes=5 * i)
            rows.append((m, "KWH", "F", 1, s, s + dt.timedelta(minutes=5), Decimal("1.00"), Decimal("2.00")))
    rd = R.index_readings(spark.createDataFrame(rows, "MeterNumber int, UnitOfMeasure string, FlowDirection string, "
                                                "Channel int, StartDateTime timestamp, EndDateTime timestamp, "
                                                "AMIValue decimal(18,2), VEEValue decimal(18,2)"))
    got = L.load_control_analysis(pts, mm, rd)
    want = _reference_analysis(pts, mm, rd)
    assert got.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_analysis_on_autumn_dst_day(spark):
    # event 0:30-3:00 local on 2024-11-03: 01:xx happens twice
    ev = spark.createDataFrame([("11/3/2024", "A", "0:30", "3:00")], TEXT)
    pts = L.expand_lc_periods(L.index_lc_periods(ev))
    mm = spark.createDataFrame([(1, 1, 10, "A")], MAP)
    rows = []
    start = dt.datetime(2024, 11, 3, 4, 0)  # 23:00 CDT Nov 2
    for i in range(12 * 7):
        s = start + dt.timedelta(minutes=5 * i)
        rows.append((10, "KWH", "F", 1, s, s + dt.timedelta(minutes=5), Decimal("1.00"), Decimal("1.00")))
    rd = R.index_readings(spark.createDataFrame(rows, "MeterNumber int, UnitOfMeasure string, FlowDirection string, "
                                                "Channel int, StartDateTime timestamp, EndDateTime timestamp, "
                                                "AMIValue decimal(18,2), VEEValue decimal(18,2)"))
    got = L.load_control_analysis(pts, mm, rd)
    want = _reference_analysis(pts, mm, rd)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    he2 = [r for r in got.collect() if r.Day == 3 and r.HourEnding == 2]
    assert he2 and sum(r.HourlyAMIValue for r in he2) == Decimal("24.00")  # two UTC hours
