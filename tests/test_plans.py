"""Plan-shape checks: the properties the scale design relies on."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from test_readings import SCHEMA, brute_force_clean
from voltframe.operators import readings as R
from voltframe.plans.catalog import QUERIES


def _plan(df):
    from voltframe.plans.explain import plan_text
    return plan_text(df)


def test_hot_key_is_aggregated_not_windowed(spark):
    t0 = dt.datetime(2024, 1, 1, 6, 0)
    key = (1, "KWH", "F", 1, t0, t0 + dt.timedelta(minutes=15))
    rows = [key + (Decimal("1.00"), Decimal("1.00"))] * 3000          # copies of one key
    rows += [key + (Decimal(i) / 100, Decimal("2.00")) for i in range(1, 40)]  # a crowded key
    pair = (2, "KWH", "F", 1, t0, t0 + dt.timedelta(minutes=15))
    rows += [pair + (Decimal("0.00"), None), pair + (Decimal("3.00"), Decimal("3.00"))]
    rows += [(3, "KWH", "F", 1, t0 + dt.timedelta(minutes=15 * i), t0 + dt.timedelta(minutes=15 * i + 15),
              Decimal("1.00"), Decimal("1.00")) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = R.clean_readings(df)
    assert sorted(map(tuple, out.collect()), key=repr) == brute_force_clean(rows)
    plan = _plan(out)
    assert "Window" not in plan


def test_lc_analysis_broadcasts_slot_set(spark):
    plan = _plan(QUERIES["lc_analysis"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_reference_scope_filter_reaches_scan(spark, tmpdir_path):
    from voltframe.operators.changes import reference_scope
    path = f"{tmpdir_path}/ix"
    QUERIES["serial_index"](spark, SF_SMALL).write.parquet(path)
    up = spark.read.parquet(path)
    ch = up.filter(F.dayofmonth("StartDateTime") >= 20)
    plan = reference_scope(up.select("MeterNumber", "StartDateTime", "AMIValue"), ch)._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(StartDateTime), GreaterThanOrEqual(StartDateTime" in plan
    assert "ReadSchema: struct<MeterNumber:int,StartDateTime:timestamp,AMIValue:double>" in plan


def test_hourly_uses_partial_aggregation(spark):
    plan = _plan(QUERIES["hourly_usage"](spark, SF_SMALL))
    assert "partial_sum" in plan and "Window" not in plan


def test_peak_join_is_broadcast(spark):
    plan = _plan(QUERIES["peak_total"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_building_a_query_starts_no_job(spark):
    from voltframe.plans.pipeline import Pipeline
    tracker = spark.sparkContext.statusTracker()
    for name in ("peak_total", "peak_by_lc_meter", "year_month_dim", "peak_dropouts", "lc_analysis", "no_submeters",
                 "monthly_substation_load"):
        QUERIES[name](spark, SF_SMALL)  # lists the files
        group = f"build-{name}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            Pipeline._shared.clear()  # no plan kept from another query
            QUERIES[name](spark, SF_SMALL)
            assert not tracker.getJobIdsForGroup(group), name
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_submeter_exclusion_does_not_shuffle_readings(spark):
    plan = _plan(QUERIES["no_submeters"](spark, SF_SMALL))
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_pair_aggregation_is_partial_before_its_shuffle(spark, tmpdir_path):
    from voltframe.plans.pipeline import Pipeline
    path = f"{tmpdir_path}/bronze"
    Pipeline.of(spark, SF_SMALL).bronze.write.parquet(path)
    plan = _plan(R.clean_readings(spark.read.parquet(path)))
    # dedupe: partial hash aggregate -> shuffle on all 8 columns -> final;
    # pair rules: partial (count, min, max) per key -> shuffle on the key -> final
    lines = [ln.strip() for ln in plan.splitlines()]
    exchanges = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert len(exchanges) == 2
    below = "\n".join(lines[exchanges[0]:exchanges[1]])
    assert "partial_count" in below and "partial_min" in below
    assert "Window" not in plan
