"""SQL functions, sketches and inferred types against the plain forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from voltframe.functions.holidays import us_holidays
from voltframe.functions.sql_functions import register_functions
from voltframe.functions.timeindex import local_wall_instants, serial_index
from voltframe.operators import hourly as H
from voltframe.operators import sketches as SK
from voltframe.plans.pipeline import Pipeline
from voltframe.sources.infer import fit_counts, inferred_types, merged_counts


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_holiday_function_equals_the_dimension(spark):
    register_functions(spark)
    days = spark.sql("SELECT explode(sequence(DATE '2019-01-01', DATE '2041-12-31')) AS d")
    got = days.selectExpr("d", "vf_is_holiday(d) AS h").filter("h").select("d")
    years = spark.range(2019, 2042).select(F.col("id").cast("int").alias("Year"))
    want = us_holidays(years).select(F.col("HolidayDate").alias("d")).distinct()
    assert rows(got) == rows(want)


def test_slot_functions_equal_the_column_functions(spark):
    register_functions(spark)
    times = [dt.datetime(2021, 1, 1), dt.datetime(2020, 12, 31, 23, 55), dt.datetime(2040, 12, 31, 23, 55),
             dt.datetime(2041, 1, 1), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 30),
             dt.datetime(2024, 7, 4, 12, 3), dt.datetime(2024, 7, 4, 12, 5, 59), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    got = df.selectExpr("t", "vf_slot(t)", "vf_local_slots(t)", "vf_slot_start(vf_slot(t))")
    want = df.select("t", serial_index("t"), F.transform(local_wall_instants(F.col("t")), lambda u: serial_index(u)),
                     F.when(serial_index("t").isNotNull(), F.date_trunc("minute", "t")))
    assert rows(got) == rows(want)


def test_points_function(spark):
    register_functions(spark)
    got = spark.sql("SELECT i.* FROM (SELECT 10 AS a, 12 AS b UNION ALL SELECT 9, 2) e, LATERAL vf_points(e.a, e.b, 1, 2) i")
    assert sorted(map(tuple, got.collect())) == [(9, 0), (10, 0), (11, 1), (12, 1), (13, 0), (14, 0)]


def test_only_touched_days_are_sketched_again(spark):
    p = Pipeline.of(spark, SF_SMALL)
    hourly = p.hourly
    wrong = F.col("HourlyVEEValue") + F.when(F.col("LocalDay") > 20, 1000).otherwise(0)
    old = SK.day_sketches(hourly.withColumn("HourlyVEEValue", wrong))
    days = SK.with_days(old, SK.day_sketches(hourly.filter("LocalDay > 20")))
    assert days.count() == old.count()
    assert SK.rank_errors(SK.month_quantiles(days), hourly).agg(F.max("RankError")).first()[0] <= SK.RANK_ERROR
    assert SK.rank_errors(SK.month_quantiles(old), hourly).agg(F.max("RankError")).first()[0] > SK.RANK_ERROR


def test_merged_sketches_stay_within_the_bound(spark):
    n = 200_000
    hourly = spark.range(n).select(
        F.lit("KWH").alias("UnitOfMeasure"), F.lit(2024).alias("LocalYear"), F.lit(1).alias("LocalMonth"),
        (F.col("id") % 31).cast("int").alias("LocalDay"), (F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("HourlyVEEValue"))
    errors = SK.rank_errors(SK.month_quantiles(SK.day_sketches(hourly)), hourly).collect()
    assert len(errors) == len(SK.QUANTILES) and all(r.RankError <= SK.RANK_ERROR and r.Hours == n for r in errors)


def test_theta_sets_are_near_beyond_their_entries(spark):
    read = spark.range(60_000).select(F.lit("KWH").alias("UnitOfMeasure"), F.col("id").alias("MeterNumber"))
    programs = spark.range(30_000, 90_000).select(F.col("id").alias("BI_MTR_NBR"))
    r = SK.meter_sets(read, programs, spark.range(10).select(F.col("id").alias("BI_MTR_NBR"))).first()
    bound = 5 * 2 ** (-SK.LG_ENTRIES / 2) * 90_000
    for got, want in ((r.ReadingMeters, 60_000), (r.WithProgram, 30_000), (r.WithoutProgram, 30_000), (r.ReadingOrProgram, 90_000)):
        assert got == pytest.approx(want, abs=bound)


def test_types_of_parts_merge(spark):
    df = spark.createDataFrame([("1", "1.5", "2024-01-01", None, "x", "1e3"), ("-2", "2", "2024-01-01 10:00", None, "2", ".5"),
                                (None, "7", "2024-01-01T10:00:00.123Z", None, "3", "4")], "a string, b string, c string, d string, e string, f string")
    want = {("a", "int", 2, 0), ("b", "decimal", 3, 0), ("c", "timestamp", 3, 0), ("d", "null", 0, 0), ("e", "text", 3, 1),
            ("f", "double", 3, 0)}
    assert set(rows(inferred_types(fit_counts(df)))) == want
    parts = [fit_counts(df.filter(cond)) for cond in ("a = '1'", "a = '-2'", "a IS NULL")]
    merged = merged_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert set(rows(inferred_types(merged))) == want
    assert fit_counts(df.limit(0)).count() == 6
