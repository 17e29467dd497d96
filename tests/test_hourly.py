import datetime as dt
from decimal import Decimal

from voltframe.operators import hourly as H
from voltframe.operators import readings as R
from voltframe.operators import usage as U

SCHEMA = ("MeterNumber int, UnitOfMeasure string, FlowDirection string, Channel int, "
          "StartDateTime timestamp, EndDateTime timestamp, AMIValue decimal(18,2), VEEValue decimal(18,2)")


def _readings(spark, start, n, step=15):
    rows = []
    for i in range(n):
        s = start + dt.timedelta(minutes=step * i)
        rows.append((7, "KWH", "F", 1, s, s + dt.timedelta(minutes=step), Decimal("1.00"), Decimal("2.00")))
    return R.index_readings(spark.createDataFrame(rows, SCHEMA))


def test_autumn_dst_two_hours_in_hour_ending_2(spark):
    # 2024-11-03 06:00-08:00 UTC = 01:00 CDT, 01:00 CST, 02:00 CST
    h = H.hourly_usage(_readings(spark, dt.datetime(2024, 11, 3, 6, 0), 12))
    got = {(r.LocalDay, r.HourEnding): r.HourlyAMIValue for r in h.collect()}
    assert got == {(3, 2): Decimal("8.00"), (3, 3): Decimal("4.00")}


def test_spring_gap(spark):
    # 2024-03-10 07:45-08:15 UTC = 01:45 CST, then 03:00 CDT
    h = H.hourly_usage(_readings(spark, dt.datetime(2024, 3, 10, 7, 45), 2))
    assert sorted((r.HourEnding, r.HourlyAMIValue) for r in h.collect()) == [(2, Decimal("1.00")), (4, Decimal("1.00"))]


def test_hour_ending_24_stays_on_start_day(spark):
    # 05:00 UTC Jan 2 = 23:00 CST Jan 1
    h = H.hourly_usage(_readings(spark, dt.datetime(2024, 1, 2, 5, 0), 4)).collect()
    assert [(r.LocalDay, r.HourEnding) for r in h] == [(1, 24)]
    assert h[0].EndMeterSampleIndex == _readings(spark, dt.datetime(2024, 1, 2, 5, 45), 1).first().EndMeterSampleIndex


def test_hourly_sum_equals_reading_sum(spark):
    ix = _readings(spark, dt.datetime(2024, 1, 5, 0, 0), 200)
    h = H.hourly_usage(ix)
    assert h.agg({"HourlyAMIValue": "sum"}).first()[0] == ix.agg({"AMIValue": "sum"}).first()[0]


def test_rank_ties_break_on_hour(spark):
    rows = [(2024, 1, 1, he, Decimal("1.00"), Decimal("5.00")) for he in (3, 1, 2)]
    t = spark.createDataFrame(rows, "Year int, Month int, Day int, HourEnding int, "
                                    "AllMetersDayHourAMIValue decimal(18,2), AllMetersDayHourVEEValue decimal(18,2)")
    got = sorted((r.HourEnding, r.DailyRank) for r in U.daily_rank(t).collect())
    assert got == [(1, 1), (2, 2), (3, 3)]
    assert U.top_hours(t, 2).count() == 2


def test_direct_totals_equal_two_level(spark):
    from sf_dirs import SF_SMALL
    from voltframe.plans.pipeline import Pipeline
    p = Pipeline.of(spark, SF_SMALL)
    a = U.system_hourly_totals(p.nosub)
    b = U.hourly_totals(p.hourly_nosub)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))


def test_v1_percent_difference_zero_ami_is_null(spark):
    rows = [(1, "KWH", "F", 1, dt.datetime(2024, 1, 1, 5, 0), dt.datetime(2024, 1, 1, 5, 15),
             Decimal("0.00"), Decimal("1.00")),
            (1, "KWH", "F", 1, dt.datetime(2024, 1, 1, 6, 0), dt.datetime(2024, 1, 1, 6, 15),
             Decimal("2.00"), Decimal("3.00"))]
    t = {r.HourEnding: r for r in H.totals_by_hour(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert t[5].AMI_VEE_PercentDifference is None and t[5].AMI_VEE_kWhDifference == Decimal("1.00")
    assert t[6].AMI_VEE_PercentDifference == 0.5


def test_ami_vee_report_counts_differences(spark):
    hourly = spark.createDataFrame([
        (1, "KWH", "F", 1, 2024, 1, 2, 5, Decimal("1.00"), Decimal("1.00"), 10),
        (1, "KWH", "F", 1, 2024, 1, 2, 6, Decimal("1.00"), Decimal("3.00"), 22),
        (2, "KWH", "F", 1, 2024, 1, 2, 6, Decimal("1.00"), None, 22),
    ], "MeterNumber int, UnitOfMeasure string, FlowDirection string, Channel int, LocalYear int, "
       "LocalMonth int, LocalDay int, HourEnding int, HourlyAMIValue decimal(18,2), "
       "HourlyVEEValue decimal(18,2), EndMeterSampleIndex int")
    by_hour = {r.HourEnding: r for r in U.ami_vee_report(hourly, ["HourEnding"]).collect()}
    assert by_hour[5].DIFF_COUNT_SUM == 0 and by_hour[5].DIFF_COUNT_AVG is None
    assert by_hour[6].DIFF_COUNT_SUM == 1 and by_hour[6].VEE_AMI_DIFF_SUM == Decimal("2.00")
    by_date = U.ami_vee_report(hourly, ["DATE"]).first()
    assert by_date.DATE == dt.date(2024, 1, 2) and by_date.DIFF_COUNT_SUM == 1


def test_hourly_in_hours_with_no_hours_is_empty(spark):
    ix = _readings(spark, dt.datetime(2024, 1, 5, 0, 0), 8)
    none = spark.createDataFrame([], "LocalYear int, LocalMonth int, LocalDay int, HourEnding int")
    assert H.hourly_usage_in_hours(ix, none).count() == 0
    one = spark.createDataFrame([(2024, 1, 4, 19)], "LocalYear int, LocalMonth int, LocalDay int, HourEnding int")
    got = H.hourly_usage_in_hours(ix, one).collect()   # 00:00-01:00 UTC = 18:00-19:00 CST
    assert [(r.HourEnding, r.HourlyAMIValue) for r in got] == [(19, Decimal("4.00"))]


def test_readings_outside_the_calendar_are_not_dropped_in_silence(spark):
    import datetime as dt

    import pytest
    from voltframe.operators import readings as R
    rows = [(1, "KWH", "F", 1, dt.datetime(y, 3, 1, 6), dt.datetime(y, 3, 1, 6, 15), 1.0, 1.0) for y in (2024, 2041)]
    df = R.index_readings(spark.createDataFrame(rows, "MeterNumber int, UnitOfMeasure string, FlowDirection string, "
                                                "Channel int, StartDateTime timestamp, EndDateTime timestamp, "
                                                "AMIValue double, VEEValue double"))
    with pytest.raises(Exception, match="a reading has no slot"):
        H.hourly_usage(df).collect()
    assert H.with_local_parts(df, unplaced="drop").count() == 1
