import datetime as dt

from pyspark.sql import functions as F

from voltframe.functions.holidays import us_holidays
from voltframe.operators.calendar import build_calendar
from voltframe.plans.oracle_sql import us_holiday_rows


def test_holiday_rules_match_python_rules(spark):
    years = spark.range(2021, 2041).select(F.col("id").cast("int").alias("Year"))
    got = sorted((r.Year, r.HolidayDate, r.HolidayName) for r in us_holidays(years).collect())
    assert got == sorted(us_holiday_rows(2021, 2040))
    days = {(r[1], r[2]) for r in got}
    assert (dt.date(2021, 12, 31), "New Year's Day (observed)") in days
    assert (dt.date(2024, 11, 28), "Thanksgiving") in days
    assert (dt.date(2026, 7, 3), "Independence Day (observed)") in days


def test_calendar_year(spark):
    cal = build_calendar(spark, 2024, 2024)
    assert cal.count() == 366 * 288
    dup = cal.groupBy("LocalTimeStamp").count().filter("count > 1").count()
    assert dup == 12
    r = cal.filter("MeterSampleIndex = 371473").first()
    assert r.LocalHour == 15 and r.UTCHour == 20 and r.Weekend == 1
    assert cal.filter("LocalMonth = 7 AND LocalDay = 4 AND LocalHour = 12").first().Holiday == 1


def test_scale_conf():
    from voltframe.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)  # 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == 100_000
    assert scale_conf(10 * 1024 ** 3)["spark.sql.shuffle.partitions"] == "40"


def test_local_wall_instants_equal_calendar_join_for_a_year(spark):
    from voltframe.functions.timeindex import local_wall_instants, serial_index
    cal = build_calendar(spark, 2024, 2024).select("MeterSampleIndex", "LocalTimeStamp")
    walls = (spark.range(0, 366 * 288)
             .select((F.lit("2024-01-01 00:00:00").cast("timestamp")
                      + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") * 5)).alias("wall")))
    arith = walls.select("wall", F.explode(F.transform(local_wall_instants(F.col("wall")),
                                                       lambda u: serial_index(u))).alias("idx"))
    joined = walls.join(cal, walls.wall == cal.LocalTimeStamp).select("wall", F.col("MeterSampleIndex").alias("idx"))
    # the calendar holds 2024 UTC only: compare inside it
    lo, hi = cal.agg(F.min("MeterSampleIndex"), F.max("MeterSampleIndex")).first()
    arith = arith.filter(F.col("idx").between(lo, hi))
    assert arith.exceptAll(joined).count() == 0 and joined.exceptAll(arith).count() == 0
    per_wall = arith.groupBy("wall").count()
    assert per_wall.filter("count = 2").count() == 12


def test_calendar_flags_for_known_days(spark):
    from voltframe.operators.calendar import calendar_for_days
    days = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 15),), (dt.date(2024, 1, 13),),
                                  (dt.date(2024, 1, 16),)], "Date date")
    cal = calendar_for_days(days).filter("LocalHour = 12")
    flags = {(r.LocalMonth, r.LocalDay): (r.Weekend, r.Holiday) for r in cal.collect()}
    assert flags[(1, 1)] == (0, 1)    # New Year's Day, a Monday
    assert flags[(1, 15)] == (0, 1)   # Martin Luther King Jr. Day
    assert flags[(1, 13)] == (1, 0)   # Saturday
    assert flags[(1, 16)] == (0, 0)
