import os

from sf_dirs import SF_SMALL
from voltframe.plans import jobs
from voltframe.plans.catalog import QUERIES
from voltframe.plans.pipeline import Pipeline


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batch_jobs_match_catalogue(spark, tmpdir_path):
    p = Pipeline(spark, SF_SMALL)
    fx = p.fx
    root = os.path.join(tmpdir_path, "tables")
    a = jobs.run_readings_job(spark, fx.fx_bronze, fx.fx_meter_info, root)
    assert _rows(a["month_hour_rank"].select(*QUERIES["month_hour_rank"](spark, SF_SMALL).columns)
                 .withColumns({c: a["month_hour_rank"][c].cast("double") for c in
                               ["AllMetersMonthHourTotalAMIValue", "AllMetersMonthHourMedianAMIValue",
                                "AllMetersMonthHourTotalVEEValue", "AllMetersMonthHourMedianVEEValue"]})) \
        == _rows(QUERIES["month_hour_rank"](spark, SF_SMALL))
    b = jobs.run_load_control_job(spark, fx.fx_lc_text, fx.fx_load_types, a["indexed"], root)
    assert b["lc_analysis"].count() == QUERIES["lc_analysis"](spark, SF_SMALL).count()
    # the workbook fixture covers months 1-5 of 2024; the peak job runs end to end
    c = jobs.run_peak_job(spark, fx.fx_cells, a["hourly"], a["hourly_nosub"], fx.fx_load_types,
                          fx.fx_rates, root)
    assert c["coincident_peaks"].count() == 5
    assert c["monthly_substation_load"].count() == p.fx.supplier.count()  # one row per supplier


def test_job_tables_prune_partitions(spark, tmpdir_path):
    from pyspark.sql import functions as F
    p = Pipeline.of(spark, SF_SMALL)
    root = os.path.join(tmpdir_path, "t")
    jobs.run_readings_job(spark, p.fx.fx_bronze, p.fx.fx_meter_info, root)
    ix = spark.read.parquet(os.path.join(root, "indexed"))
    plan = ix.filter(F.col("day") >= "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    hr = spark.read.parquet(os.path.join(root, "hourly_nosub"))
    plan = hr.filter("LocalMonth = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(LocalMonth" in plan
