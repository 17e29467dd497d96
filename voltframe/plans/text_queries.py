"""Queries written as SQL text on the package's SQL functions, quantiles and
meter sets from sketches, and types inferred from text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.sql_functions import register_functions
from voltframe.operators import hourly as H
from voltframe.operators import readings as R
from voltframe.operators import sketches as SK
from voltframe.plans import oracle_sql as O
from voltframe.plans.pipeline import Pipeline
from voltframe.plans.registry import ORACLE, q, register
from voltframe.plans.stored_queries import _B1, _B2, _DAMAGE, _NOW, _TEXT_16, _landing_text
from voltframe.sources.infer import FORMS, fit_counts, inferred_types

# ------------------------------------------------------------------ SQL text

_PERIODS = """
SELECT Date, Program, StartTime, StopTime, StartDateTime, EndDateTime, StartMeterSampleIndex, EndMeterSampleIndex,
       (EndMeterSampleIndex - StartMeterSampleIndex) * 5 AS TotalTime_Minutes, replace(Program, ' ', '_') AS ProgramId,
       concat_ws('_', replace(Program, ' ', '_'), CAST(StartDateTime AS STRING), CAST(EndDateTime AS STRING))
         AS LoadControlEventID
FROM (SELECT *, vf_local_slots(StartDateTime) AS starts, vf_local_slots(EndDateTime) AS ends
      FROM (SELECT DISTINCT *, try_to_timestamp(Date || ' ' || StartTime, 'M/d/yyyy H:mm') AS StartDateTime,
                   try_to_timestamp(Date || ' ' || StopTime, 'M/d/yyyy H:mm') AS EndDateTime FROM {events}) e) f
LATERAL VIEW OUTER explode(starts) s AS StartMeterSampleIndex
LATERAL VIEW OUTER explode(ends) t AS EndMeterSampleIndex"""


@register("sql_lc_periods", ORACLE["lc_periods_wide"])
def sql_lc_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return spark.sql(_PERIODS, events=Pipeline.of(spark, sf_dir).fx.fx_lc_text_wide)


@register("sql_lc_points", q("""
SELECT p.LoadControlEventID, p.Program, p.MeterSampleIndex, p.LoadControlEvent FROM points p""",
                             uses=("fx_lc_text",), ctes=O.LC_PERIODS_CTES))
def sql_lc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    periods = spark.sql(_PERIODS, events=Pipeline.of(spark, sf_dir).fx.fx_lc_text)
    return spark.sql("""
SELECT p.LoadControlEventID, p.Program, i.MeterSampleIndex, i.LoadControlEvent
FROM {periods} p, LATERAL vf_points(p.StartMeterSampleIndex, p.EndMeterSampleIndex, 48, 48) i""", periods=periods)


@register("sql_calendar", ORACLE["calendar_span"])
def sql_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return spark.sql("""
SELECT utc AS UTCTimeStamp, year(utc) AS UTCYear, month(utc) AS UTCMonth, day(utc) AS UTCDay, hour(utc) AS UTCHour,
       minute(utc) AS UTCMinute, here AS LocalTimeStamp, year(here) AS LocalYear, month(here) AS LocalMonth,
       day(here) AS LocalDay, hour(here) AS LocalHour, minute(here) AS LocalMinute, MeterSampleIndex,
       CASE WHEN dayofweek(here) IN (1, 7) THEN 1 ELSE 0 END AS Weekend,
       CASE WHEN vf_is_holiday(CAST(here AS DATE)) THEN 1 ELSE 0 END AS Holiday
FROM (SELECT MeterSampleIndex, vf_slot_start(MeterSampleIndex) AS utc, vf_local(vf_slot_start(MeterSampleIndex)) AS here
      FROM (SELECT DISTINCT CAST(StartDateTime AS DATE) AS d FROM {readings}) days, LATERAL vf_day_slots(days.d)) c""",
                     readings=Pipeline.of(spark, sf_dir).cleaned)


@register("sql_meter_programs", ORACLE["meter_programs"])
def sql_meter_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Pipeline.of(spark, sf_dir).fx
    return spark.sql("""
WITH enrolled AS (
  SELECT service.*, lm.BI_ACCT AS DeviceAccount FROM {service} service JOIN {lm_srv} lm USING (BI_SRV_LOC_NBR)
  WHERE service.BI_TYPE_SRV_GRP = 'ELEC' AND service.BI_DISC_DT IS NULL)
SELECT DISTINCT enrolled.BI_SRV_LOC_NBR, enrolled.BI_ACCT, BI_CON_DT, BI_PRIM_RATE_SCHED, device.BI_LOAD_TYPE,
       kind.BI_LOAD_TYPE_DESC, device.BI_MTR_POS_NBR, meter.BI_MTR_NBR
FROM enrolled JOIN {lm_dvc} device ON device.BI_ACCT = enrolled.DeviceAccount
JOIN {ref} kind ON kind.BI_LOAD_TYPE = device.BI_LOAD_TYPE
JOIN {mtr} meter ON meter.BI_ACCT = enrolled.BI_ACCT AND meter.BI_SRV_LOC_NBR = enrolled.BI_SRV_LOC_NBR
  AND meter.BI_MTR_POS_NBR = device.BI_MTR_POS_NBR""",
                     service=fx.fx_cis_service, lm_srv=fx.fx_cis_lm_srv, lm_dvc=fx.fx_cis_lm_dvc, ref=fx.fx_cis_ref,
                     mtr=fx.fx_cis_mtr)


# ------------------------------------------------------------------ sketches

@register("usage_quantiles", q("""
SELECT UnitOfMeasure, LocalYear, LocalMonth, unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS Quantile,
       COUNT(HourlyVEEValue) AS Hours, TRUE AS WithinBound
FROM hr WHERE HourlyVEEValue IS NOT NULL GROUP BY UnitOfMeasure, LocalYear, LocalMonth""",
    ctes=[_B1, _B2, _NOW, ("ix", O.INDEXED.replace("FROM cleaned", "FROM now")), ("hr", O.hourly_of("ix"))]))
def usage_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly quantiles of the hourly usage after two batches: days that the
    second doesn't touch keep their sketches of the first. Each quantile is held
    against the exact ranks."""
    p = Pipeline.of(spark, sf_dir)
    parts = p.fx.parts("events")
    now = H.hourly_usage(R.index_readings(p.upserted), parts=parts)
    touched = (H.with_local_parts(R.index_readings(p.batch2)).select(*SK.DAY).distinct())
    fresh = SK.day_sketches(now.join(F.broadcast(touched), SK.DAY, "left_semi"))
    days = SK.with_days(SK.day_sketches(H.hourly_usage(R.index_readings(p.batch1), parts=parts)), fresh)
    got = SK.rank_errors(SK.month_quantiles(days), now)
    return got.select("UnitOfMeasure", "LocalYear", "LocalMonth", "Quantile", "Hours",
                      (F.col("RankError") <= SK.RANK_ERROR).alias("WithinBound"))


@register("meter_sets", q("""
SELECT r.UnitOfMeasure, COUNT(DISTINCT r.MeterNumber) AS ReadingMeters,
  COUNT(DISTINCT CASE WHEN p.BI_MTR_NBR IS NOT NULL THEN r.MeterNumber END) AS WithProgram,
  COUNT(DISTINCT CASE WHEN p.BI_MTR_NBR IS NULL THEN r.MeterNumber END) AS WithoutProgram,
  COUNT(DISTINCT CASE WHEN s.BI_MTR_NBR IS NOT NULL THEN r.MeterNumber END) AS Submeters,
  CAST(COUNT(DISTINCT CASE WHEN p.BI_MTR_NBR IS NULL THEN r.MeterNumber END)
       + (SELECT COUNT(DISTINCT BI_MTR_NBR) FROM found) AS BIGINT) AS ReadingOrProgram
FROM cleaned r LEFT JOIN (SELECT DISTINCT BI_MTR_NBR FROM found) p ON p.BI_MTR_NBR = r.MeterNumber
LEFT JOIN (SELECT DISTINCT BI_MTR_NBR FROM submap) s ON s.BI_MTR_NBR = r.MeterNumber
GROUP BY r.UnitOfMeasure""", uses=("fx_bronze", "fx_meter_info", "fx_load_types"),
    ctes=[("cleaned", O.CLEANED), ("submap", O.SUBMAP),
          ("found", "SELECT DISTINCT BI_MTR_NBR FROM fx_load_types WHERE BI_LOAD_TYPE IN ('GN1', 'IR1')")]))
def meter_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Pipeline.of(spark, sf_dir)
    controlled = p.fx.fx_load_types.filter(F.col("BI_LOAD_TYPE").isin("GN1", "IR1"))
    return SK.meter_sets(p.cleaned, controlled, p.submeter_map)


@register("submeter_sets", q("""
SELECT COUNT(DISTINCT i.BI_MTR_NBR) AS Submeters, COUNT(DISTINCT m.BI_MTR_NBR) AS Mapped,
       COUNT(DISTINCT CASE WHEN m.BI_MTR_NBR IS NULL THEN i.BI_MTR_NBR END) AS WithoutMain
FROM fx_meter_info i LEFT JOIN (SELECT DISTINCT BI_MTR_NBR FROM submap WHERE BI_ACCT % 7 <> 3) m USING (BI_MTR_NBR)
WHERE i.BI_MTR_CONFIG = 'S'""", uses=("fx_meter_info",), ctes=[("submap", O.SUBMAP)]))
def submeter_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submeters by theta sketches; the map lacks the accounts of one in seven."""
    p = Pipeline.of(spark, sf_dir)
    return SK.submeters_without_main(p.fx.fx_meter_info, p.submeter_map.filter("BI_ACCT % 7 <> 3"))


# ------------------------------------------------------------ inferred types

def _infer_sql() -> str:
    def text(c: str) -> str:
        value = (f"strftime({c}, '%Y-%m-%dT%H:%M:%S.000Z')" if c in ("StartDateTime", "EndDateTime")
                 else f"CAST({c} AS VARCHAR)")
        return (f"CASE WHEN {_DAMAGE[c][0]} THEN '{_DAMAGE[c][1]}' ELSE {value} END" if c in _DAMAGE else value)
    rows = "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, {text(c)} AS v FROM fx_bronze16" for c in _TEXT_16)
    fits = ", ".join(f"COUNT(*) FILTER (regexp_matches(v, '{form}')) AS fits_{k}" for k, form in FORMS.items())
    chain = " ".join(f"WHEN fits_{k} = n THEN '{k}'" for k in FORMS)
    most = ", ".join(f"fits_{k}" for k in FORMS)
    return (f"SELECT column_name, CASE WHEN n = 0 THEN 'null' {chain} ELSE 'text' END AS type, n, "
            f"n - GREATEST({most}) AS misfits FROM (SELECT column_name, COUNT(v) AS n, {fits} "
            f"FROM ({rows}) r GROUP BY column_name) c")


@register("inferred_types", q(_infer_sql(), uses=("fx_bronze16",)))
def inferred_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of the landing text's columns, some fields of which are damaged."""
    text = _landing_text(Pipeline.of(spark, sf_dir).fx.fx_bronze16)
    meter = {c: cond.replace("MeterNumber", "CAST(MeterNumber AS INT)") for c, (cond, _) in _DAMAGE.items()}
    return inferred_types(fit_counts(text.withColumns(
        {c: F.when(F.expr(meter[c]), F.lit(bad)).otherwise(F.col(c)) for c, (_, bad) in _DAMAGE.items()})))
