"""Tables by day and by meter, merges, streams: plan shapes and edge cases."""

import os

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from voltframe.operators import hourly as H
from voltframe.operators import peaks as P
from voltframe.plans import stored_queries as SQ
from voltframe.plans.explain import plan_text
from voltframe.plans.pipeline import Pipeline
from voltframe.streaming import corrections as CO


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_peak_days_alone_are_read(spark, tmpdir_path):
    p = Pipeline.of(spark, SF_SMALL)
    path = os.path.join(tmpdir_path, "readings")
    p.indexed.withColumn("day", F.to_date("StartDateTime")).write.partitionBy("day").parquet(path)
    times = p.indexed.filter("EndMeterSampleIndex % 12 = 1").select("EndMeterSampleIndex").orderBy(
        "EndMeterSampleIndex").limit(2)
    slots = [r[0] for r in times.collect()]
    peaks = spark.createDataFrame([(i,) for i in slots], "MeterSampleIndex int")
    got = H.hourly_usage_ending_at(spark.read.parquet(path), peaks, 3)
    want = H.hourly_usage(p.indexed).filter(F.col("EndMeterSampleIndex").isin(slots))
    assert rows(got.filter(F.col("EndMeterSampleIndex").isin(slots))) == rows(want) and want.count() >= 2
    assert "dynamicpruning" in plan_text(got)
    days = {r.day for r in H.start_days(peaks, 3).collect()}
    assert 1 <= len(days) <= 3


def test_start_days_cover_long_samples(spark):
    """A reading of 300 slots that ends just after midnight starts two days before."""
    slots = spark.createDataFrame([(288 * 10 + 2,)], "MeterSampleIndex int")  # 00:05 of 2021-01-11
    assert [str(r.day) for r in H.start_days(slots, 300).orderBy("day").collect()] == [
        "2021-01-09", "2021-01-10", "2021-01-11"]
    assert [str(r.day) for r in H.start_days(slots, 1).orderBy("day").collect()] == ["2021-01-11"]


def test_bucketed_readings_are_not_moved(spark):
    plan = plan_text(SQ.hourly_usage_bucketed(spark, SF_SMALL))
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "LeftAnti" in plan


def test_rescue_keeps_good_fields_and_the_line_of_odd_rows(spark, tmpdir_path):
    import json

    from test_sources import line, write_extract
    from voltframe.sources import landing as LD
    write_extract(tmpdir_path, "a", [line("X12", ami="1,5"[0]), line(7, start="soon", vee="n/a"), "2,KWH,F\n",
                                     line(8)[:-1] + ",more\n", line(9)])
    got = {r.FlowDirection + str(r.MeterNumber): r for r in LD.read_readings_batch(spark, tmpdir_path).collect()}
    assert json.loads(got["FNone"]._rescued_data) == {"MeterNumber": "X12"} and got["FNone"].AMIValue == 1.0
    assert json.loads(got["F7"]._rescued_data) == {"StartDateTime": "soon", "VEEValue": "n/a"}
    assert got["F7"].EndDateTime is not None
    assert json.loads(got["F2"]._rescued_data) == {"_line": "2,KWH,F"} and got["F2"].UnitOfMeasure == "KWH"
    assert "more" in json.loads(got["F8"]._rescued_data)["_line"] and got["F8"].AMIValue == 1.5
    assert got["F9"]._rescued_data is None


def test_corrections_end_with_the_newest_version(spark):
    changes = SQ.late_corrections(spark, SF_SMALL)
    kinds = {r[0]: r[1] for r in changes.groupBy("_change_type").count().collect()}
    assert kinds["insert"] > 0 and kinds["update_preimage"] == kinds["update_postimage"] > 0
    lots = spark.sql(SQ._DELIVERED, events=Pipeline.of(spark, SF_SMALL).fx.events)
    newest = lots.groupBy(*CO.KEY_COLUMNS).agg(F.max_by("AMIValue", "Version").cast("double").alias("AMIValue"),
                                               F.max("Version").alias("Version"))
    assert rows(CO.current_readings(changes)) == rows(newest)
    # some versions came late behind newer ones and left no trace
    assert lots.count() > kinds["insert"] + kinds["update_postimage"]


def test_a_second_drain_adds_nothing(spark, tmpdir_path):
    from voltframe.streaming.ingest import ingest_available
    text = SQ._landing_text(Pipeline.of(spark, SF_SMALL).fx.fx_bronze16)
    at = [os.path.join(tmpdir_path, n) for n in ("landing", "bronze", "checkpoint")]
    SQ._write_extract(text, at[0])
    ingest_available(spark, *at)
    n = spark.read.parquet(at[1]).count()
    ingest_available(spark, *at)
    assert spark.read.parquet(at[1]).count() == n == text.count()


def test_peaks_of_two_years_on_days(spark):
    p = Pipeline.of(spark, SF_SMALL)
    peaks = P.index_peaks(P.peak_parts(p.fx.fx_peaks_dst))
    want = P.peak_total(H.hourly_usage(p.indexed_dst), peaks)
    got = P.peak_total(SQ.by_day_usage_at(spark, p.indexed_dst, peaks), peaks)
    assert rows(got) == rows(want) and want.count() > 0
