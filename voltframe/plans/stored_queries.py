"""Queries that write tables or run streams on the way: landing files, file
streams with their checkpoints, keyed state, tables by day or bucketed by meter.

What they write goes to new folders below ``spark.checkpoint.dir`` (scratch space)
and is derived from the given tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltframe.operators import changes as C
from voltframe.operators import hourly as H
from voltframe.operators import loadcontrol as L
from voltframe.operators import peaks as P
from voltframe.operators import readings as R
from voltframe.operators import submeters as S
from voltframe.operators.quality import observed
from voltframe.plans import oracle_sql as O
from voltframe.plans.pipeline import Pipeline, out
from voltframe.plans.registry import q, register
from voltframe.session import scratch_folder
from voltframe.sources import landing as LD
from voltframe.sources.tables import read_evolving, register_table, write_bucketed, write_table
from voltframe.streaming import corrections as CO
from voltframe.streaming.chain import SilverChain
from voltframe.streaming.ingest import ingest_available

KEYS = O.KEY

# ------------------------------------------------------------ landing files

LANDING_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
_TEXT_16 = LD.READING_SCHEMA.fieldNames()


def _landing_text(bronze16: DataFrame) -> DataFrame:
    """Readings as the text fields of an extract."""
    times = {c: F.date_format(c, LANDING_TIME) for c in ("StartDateTime", "EndDateTime")}
    return bronze16.withColumns(times).select(*[F.col(c).cast("string") for c in _TEXT_16])


def _write_extract(text: DataFrame, folder: str) -> None:
    text.write.mode("append").option("header", True).option("compression", "gzip").csv(folder)


_FLOATS = ("CAST(CAST(AMIValue AS REAL) AS DOUBLE) AS AMIValue, CAST(CAST(VEEValue AS REAL) AS DOUBLE) AS VEEValue")
_BRONZE16 = ("MeterNumber, UnitOfMeasure, FlowDirection, Channel, ServiceLocation, RateCode, RateDescription, "
             "SubstationCode, SubstationDescription, Feeder, ZipCode, StartDateTime, EndDateTime, Multiplier")


@register("stream_ingest", q(f"SELECT {_BRONZE16}, {_FLOATS} FROM fx_bronze16", uses=("fx_bronze16",)))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts dropped into a landing folder twice; the file stream is drained
    and stopped after each drop, and once more with nothing new."""
    root = scratch_folder(spark, "stream-ingest")
    text = _landing_text(Pipeline.of(spark, sf_dir).fx.fx_bronze16)
    early = F.col("StartDateTime") < "2024-01-15"
    for drop in (text.filter(early), text.filter(~early), None):
        if drop is not None:
            _write_extract(drop, f"{root}/landing")
        ingest_available(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    bronze = spark.read.parquet(f"{root}/bronze").filter(F.col(LD.RESCUE_COLUMN).isNull())
    return out(bronze.select(*_TEXT_16), double=["AMIValue", "VEEValue"])


# damage by meter: an amount, a time, a channel that is no number, two at once
_DAMAGE = {"AMIValue": ("MeterNumber % 13 = 3", "n/a"), "StartDateTime": ("MeterNumber % 17 = 4", "yesterday"),
           "Channel": ("MeterNumber % 11 = 5", "two"), "VEEValue": ("MeterNumber % 13 IN (3, 7)", "1,5")}


def _rescue_sql() -> str:
    value = {c: c for c in _TEXT_16} | {c: f"CAST(CAST({c} AS REAL) AS DOUBLE)" for c in ("AMIValue", "VEEValue")}
    cols = [f"CASE WHEN {_DAMAGE[c][0]} THEN NULL ELSE {value[c]} END AS {c}" if c in _DAMAGE
            else f"{value[c]} AS {c}" for c in _TEXT_16]
    found = ", ".join(f"""CASE WHEN {_DAMAGE[c][0]} THEN '"{c}":"{_DAMAGE[c][1]}"' END"""
                      for c in _TEXT_16 if c in _DAMAGE)
    any_ = " OR ".join(f"({cond})" for cond, _ in _DAMAGE.values())
    return (f"SELECT {', '.join(cols)}, CASE WHEN {any_} THEN '{{' || concat_ws(',', {found}) || '}}' END "
            "AS rescued FROM fx_bronze16")


@register("rescued_fields", q(_rescue_sql(), uses=("fx_bronze16",)))
def rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts with damaged fields, read field by field: what doesn't fit its
    type is kept as text by its name, the other fields of the row as they are."""
    folder = scratch_folder(spark, "rescued")
    text = _landing_text(Pipeline.of(spark, sf_dir).fx.fx_bronze16)
    hurt = {c: F.when(F.expr(cond.replace("MeterNumber", "CAST(MeterNumber AS INT)")), F.lit(bad)).otherwise(F.col(c))
            for c, (cond, bad) in _DAMAGE.items()}
    _write_extract(text.withColumns(hurt), folder)
    got = LD.read_readings_batch(spark, folder).select(*_TEXT_16, F.col(LD.RESCUE_COLUMN).alias("rescued"))
    return out(got, double=["AMIValue", "VEEValue"])


# ------------------------------------------------ corrections as keyed state

DELIVERIES = 3
_DELIVERED = """SELECT CAST(user_id AS INT) AS MeterNumber,
       CASE WHEN event_type = 'error' THEN 'KVARH' ELSE 'KWH' END AS UnitOfMeasure,
       CASE WHEN event_id % 2 = 0 THEN 'R' ELSE 'F' END AS FlowDirection, CAST(1 AS INT) AS Channel,
       CAST(date_trunc('day', ts) + CAST(FLOOR(EXTRACT(HOUR FROM ts) / 6) AS INT) * INTERVAL '6' HOUR AS TIMESTAMP) AS StartDateTime,
       CAST(value AS DECIMAL(18,2)) AS AMIValue, event_id AS Version,
       CAST((event_id * 7 + user_id) % 3 AS INT) AS Delivery FROM {events}"""
_READING = "MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime"


@register("late_corrections", "WITH d AS (" + _DELIVERED.format(events="events") + f"""),
best AS (SELECT {_READING}, Delivery, MAX(Version) AS Version, arg_max(AMIValue, Version) AS AMIValue FROM d GROUP BY ALL),
seen AS (SELECT *, MAX(Version) OVER w AS before_version, arg_max(AMIValue, Version) OVER w AS before_value FROM best
         WINDOW w AS (PARTITION BY {_READING} ORDER BY Delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
news AS (SELECT * FROM seen WHERE before_version IS NULL OR before_version < Version)
SELECT {_READING}, CAST(AMIValue AS DOUBLE) AS AMIValue, Version,
       CASE WHEN before_version IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, Delivery FROM news
UNION ALL SELECT {_READING}, CAST(before_value AS DOUBLE), before_version, 'update_preimage', Delivery
FROM news WHERE before_version IS NOT NULL""")
def late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of the same six-hour readings, dealt into three lots that
    arrive one after another, newer versions before older ones among them. The
    query is stopped after each lot and started again on its checkpoint."""
    root = scratch_folder(spark, "corrections")
    fx = Pipeline.of(spark, sf_dir).fx
    lots = spark.sql(_DELIVERED, events=fx.events)
    for lot in range(DELIVERIES):
        lots.filter(F.col("Delivery") == lot).write.mode("append").parquet(f"{root}/lots")
        arriving = spark.readStream.schema(lots.schema).parquet(f"{root}/lots")
        (CO.corrections(arriving).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
         .start(f"{root}/changes").awaitTermination())
    return out(spark.read.parquet(f"{root}/changes"), double=["AMIValue"])


# ------------------------------------- micro-batch merge by partition overwrite

_B1 = ("cleaned1", O.CLEANED.replace("FROM fx_bronze", "FROM fx_bronze WHERE day(StartDateTime) <= 20"))
_B2 = ("cleaned2", O.CLEANED.replace("FROM fx_bronze", f"""FROM (SELECT {KEYS}, AMIValue,
  COALESCE(VEEValue, AMIValue) AS VEEValue FROM fx_bronze WHERE day(StartDateTime) >= 10)"""))
_NOW = ("now", f"""SELECT {KEYS}, CASE WHEN b.MeterNumber IS NULL THEN a.AMIValue ELSE b.AMIValue END AS AMIValue,
  CASE WHEN b.MeterNumber IS NULL THEN a.VEEValue ELSE b.VEEValue END AS VEEValue
FROM cleaned1 a FULL JOIN cleaned2 b USING ({KEYS})""")


def _merged(spark: SparkSession, sf_dir: str, submeter_map: DataFrame | None = None) -> SilverChain:
    """Two drops of bronze files, the second with validated values for days that
    the first has too, drained into the chain's tables; then a run with nothing
    new, and the last batch replayed."""
    root = scratch_folder(spark, "merge")
    p = Pipeline.of(spark, sf_dir)
    bronze = R.reading_facts(p.bronze)
    day = F.dayofmonth("StartDateTime")
    chain = SilverChain(spark, f"{root}/silver", submeter_map, parts=p.fx.parts("events"))
    for drop in (bronze.filter(day <= 20),
                 bronze.filter(day >= 10).withColumn("VEEValue", F.coalesce("VEEValue", "AMIValue")), None):
        if drop is not None:
            drop.write.mode("append").parquet(f"{root}/bronze")
        chain.run(f"{root}/bronze", f"{root}/checkpoint", schema=bronze.schema)
    last = chain.progress().agg(F.max("batch_id"), F.max("scope")).first()
    chain.apply(bronze, *last)
    return chain


@register("merge_readings", q(f"""SELECT {KEYS}, CAST(AMIValue AS DOUBLE) AS AMIValue,
  CAST(VEEValue AS DOUBLE) AS VEEValue FROM now""", ctes=[_B1, _B2, _NOW]))
def merge_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(_merged(spark, sf_dir).cleaned.read().drop("day"), double=["AMIValue", "VEEValue"])


@register("merge_changes", q(f"""
SELECT {KEYS}, CAST(AMIValue AS DOUBLE) AS AMIValue, CAST(VEEValue AS DOUBLE) AS VEEValue, 'insert' AS _change_type,
       CAST(1 AS BIGINT) AS _commit_version FROM cleaned1
UNION ALL SELECT {KEYS}, CAST(b.AMIValue AS DOUBLE), CAST(b.VEEValue AS DOUBLE), 'insert', 2
FROM cleaned2 b ANTI JOIN cleaned1 a USING ({KEYS})
UNION ALL SELECT {KEYS}, CAST(unnest([a.AMIValue, b.AMIValue]) AS DOUBLE), CAST(unnest([a.VEEValue, b.VEEValue]) AS DOUBLE),
       unnest(['update_preimage', 'update_postimage']), 2
FROM cleaned1 a JOIN cleaned2 b USING ({KEYS})
WHERE a.AMIValue IS DISTINCT FROM b.AMIValue OR a.VEEValue IS DISTINCT FROM b.VEEValue""", ctes=[_B1, _B2]))
def merge_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _merged(spark, sf_dir).change_log()
    return out(log.select(*R.READING_KEY, "AMIValue", "VEEValue", "_change_type", "_commit_version"),
               double=["AMIValue", "VEEValue"])


_HOURLY_COLS = ("MeterNumber, UnitOfMeasure, FlowDirection, Channel, LocalYear, LocalMonth, LocalDay, "
                "HourEnding, CAST(HourlyAMIValue AS DOUBLE) AS HourlyAMIValue, "
                "CAST(HourlyVEEValue AS DOUBLE) AS HourlyVEEValue, EndMeterSampleIndex")
_HOURLY_DOUBLES = ["HourlyAMIValue", "HourlyVEEValue"]


@register("merge_hourly", q(f"SELECT {_HOURLY_COLS} FROM hr", ctes=[
    _B1, _B2, _NOW, ("ix", O.INDEXED.replace("FROM cleaned", "FROM now")), ("hr", O.hourly_of("ix"))]))
def merge_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(_merged(spark, sf_dir).hourly.read().drop("day"), double=_HOURLY_DOUBLES)


@register("merge_nosub", q(f"""SELECT {KEYS}, CAST(AMIValue AS DOUBLE) AS AMIValue, CAST(VEEValue AS DOUBLE) AS VEEValue,
  StartMeterSampleIndex, EndMeterSampleIndex, SampleRate FROM nosub""", uses=("fx_bronze", "fx_meter_info"), ctes=[
    _B1, _B2, _NOW, ("indexed", O.INDEXED.replace("FROM cleaned", "FROM now")), ("submap", O.SUBMAP), ("nosub", O.NOSUB)]))
def merge_nosub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed readings of main meters, kept up to date by the merges."""
    chain = _merged(spark, sf_dir, Pipeline.of(spark, sf_dir).submeter_map)
    return out(chain.nosub.read().drop("day"), double=["AMIValue", "VEEValue"])


@register("changes_since", q(f"""
SELECT {KEYS}, CAST(b.AMIValue AS DOUBLE) AS AMIValue, CAST(b.VEEValue AS DOUBLE) AS VEEValue,
       CASE WHEN a.MeterNumber IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type
FROM cleaned2 b LEFT JOIN cleaned1 a USING ({KEYS})
WHERE a.MeterNumber IS NULL OR a.AMIValue IS DISTINCT FROM b.AMIValue OR a.VEEValue IS DISTINCT FROM b.VEEValue""",
                             ctes=[_B1, _B2]))
def changes_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a consumer applies who has seen all changes up to the time of the
    first merge."""
    log = _merged(spark, sf_dir).change_log()
    seen = log.filter("_commit_version = 1").agg(F.max("_commit_timestamp")).first()[0]
    later = C.postimages(C.changes_since_time(log, seen))
    return out(later.select(*R.READING_KEY, "AMIValue", "VEEValue", "_change_type"), double=["AMIValue", "VEEValue"])


# ----------------------------------------------------- extracts of other tables

def _csv(df: DataFrame, folder: str, **options) -> str:
    df.write.options(header=True, **options).csv(folder)
    return folder


@register("csv_submeter_map", q("SELECT * FROM submap", uses=("fx_meter_info",), ctes=[("submap", O.SUBMAP)]))
def csv_submeter_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meter export as a folder of compressed text files, all columns text."""
    folder = _csv(Pipeline.of(spark, sf_dir).fx.fx_meter_info, scratch_folder(spark, "meters"), compression="gzip")
    return S.build_submeter_map(LD.read_dim_csv(spark, folder))


@register("csv_lc_periods", q("SELECT * FROM periods", uses=("fx_lc_text_wide",), ctes=[
    (n, b.replace("fx_lc_text", "fx_lc_text_wide")) for n, b in O.LC_PERIODS_CTES[:4]]))
def csv_lc_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files found by a glob, read with their fixed schema."""
    folder = _csv(Pipeline.of(spark, sf_dir).fx.fx_lc_text_wide, scratch_folder(spark, "events"))
    return L.index_lc_periods(LD.read_lc_events(spark, f"{folder}/*.csv"))


@register("csv_supplier_rates", q("""
SELECT CAST(s_suppkey AS INTEGER) AS Month, CAST(s_acctbal AS DOUBLE) AS DemandRate FROM supplier""", uses=()))
def csv_supplier_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate file whose column types are found in its text."""
    rates = Pipeline.of(spark, sf_dir).fx.supplier.select(F.col("s_suppkey").alias("Month"),
                                                          F.col("s_acctbal").alias("DemandRate"))
    return LD.read_demand_rates(spark, _csv(rates, scratch_folder(spark, "rates")))


@register("evolving_readings", q(f"""
SELECT {KEYS}, CAST(AMIValue AS DOUBLE) AS AMIValue,
       CASE WHEN day(StartDateTime) <= 15 THEN NULL ELSE CAST(VEEValue AS DOUBLE) END AS VEEValue FROM fx_bronze"""))
def evolving_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose first files lack a column that later ones have."""
    path = scratch_folder(spark, "evolving")
    readings = R.reading_facts(Pipeline.of(spark, sf_dir).bronze)
    early = F.dayofmonth("StartDateTime") <= 15
    write_table(readings.filter(early).drop("VEEValue"), path, "append")
    write_table(readings.filter(~early), path, "append")
    return out(read_evolving(spark, path).select(*R.READING_KEY, "AMIValue", "VEEValue"), double=["AMIValue", "VEEValue"])


@register("written_hourly", q("""
SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, LocalYear, LocalMonth, LocalDay, HourEnding,
       CAST(HourlyAMIValue AS DOUBLE) AS HourlyAMIValue, CAST(HourlyVEEValue AS DOUBLE) AS HourlyVEEValue,
       EndMeterSampleIndex FROM hourly""", ctes=O.HOURLY_CTES))
def written_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table written by month, overwritten whole, and read by its
    catalogue name."""
    path = scratch_folder(spark, "hourly")
    hourly = Pipeline.of(spark, sf_dir).hourly
    for content in (hourly.limit(0), hourly):
        write_table(content, path, "overwrite", ["LocalYear", "LocalMonth"])
    name = "vf_" + path.rsplit("-", 1)[1]
    register_table(spark, name, path)
    return out(spark.table(name).select(*hourly.columns), double=_HOURLY_DOUBLES)


@register("row_counts", q("""
SELECT 'bronze' AS "Stage", COUNT(*) AS "Rows" FROM fx_bronze
UNION ALL SELECT 'cleaned', COUNT(*) FROM cleaned UNION ALL SELECT 'hourly', COUNT(*) FROM hourly""", ctes=O.HOURLY_CTES))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after each step, observed while the last one is written."""
    bronze, seen = observed(R.reading_facts(Pipeline.of(spark, sf_dir).bronze), "bronze")
    cleaned, kept = observed(R.clean_readings(bronze), "cleaned")
    hourly, made = observed(H.hourly_usage(R.index_readings(cleaned)), "hourly")
    hourly.write.parquet(scratch_folder(spark, "counted"))
    return spark.createDataFrame([(n, o.get["rows"]) for n, o in (("bronze", seen), ("cleaned", kept), ("hourly", made))],
                                 "Stage string, Rows long")


# ------------------------------------------- readings by day, readings by meter

def _on(ctes, **tables: str):
    """Oracle steps over other fixtures."""
    for old, new in tables.items():
        ctes = [(name, body.replace(old, new)) for name, body in ctes]
    return list(ctes)


def by_day_usage_at(spark: SparkSession, indexed: DataFrame, peaks: DataFrame) -> DataFrame:
    """Readings stored by day; the hourly rows that can end at a peak, from the
    days of the peaks alone."""
    path, seen = f"{scratch_folder(spark, 'by-day')}/readings", Observation()
    length = F.max(F.col("EndMeterSampleIndex") - F.col("StartMeterSampleIndex")).alias("longest")
    (indexed.withColumn("day", F.to_date("StartDateTime")).observe(seen, length)
     .hint("rebalance", "day").write.partitionBy("day").parquet(path))
    return H.hourly_usage_ending_at(spark.read.parquet(path), peaks, seen.get["longest"] or 1)


@register("peak_total_by_day", q("""
SELECT CoincidYear, CoincidMonth, CAST(SUM(HourlyAMIValue) AS DOUBLE) AS TotalCPHourlyAMIValue,
       CAST(SUM(HourlyVEEValue) AS DOUBLE) AS TotalCPHourlyVEEValue,
       CAST(CoincidYear AS VARCHAR) || '-' || CAST(CoincidMonth AS VARCHAR) AS YearMonth
FROM hourly_nosub h JOIN ipk ON h.EndMeterSampleIndex = ipk.MeterSampleIndex
GROUP BY CoincidYear, CoincidMonth""", uses=("fx_bronze_dst", "fx_meter_info", "fx_peaks_dst"),
    ctes=_on(O.HOURLY_NOSUB_CTES, fx_bronze="fx_bronze_dst") + _on(O.PEAK_CTES, fx_peaks="fx_peaks_dst")))
def peak_total_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage of the main meters at the peaks: only the peaks' days are read."""
    p = Pipeline.of(spark, sf_dir)
    peaks = P.index_peaks(P.peak_parts(p.fx.fx_peaks_dst))
    hourly = by_day_usage_at(spark, S.exclude_submeters(p.indexed_dst, p.submeter_map), peaks)
    return out(P.peak_total(hourly, peaks), double=["TotalCPHourlyAMIValue", "TotalCPHourlyVEEValue"])


_TYPES = """
SELECT BI_ACCT, BI_MTR_NBR, BI_MTR_POS_NBR, string_agg(BI_LOAD_TYPE, ',' ORDER BY BI_LOAD_TYPE) AS BI_LOAD_TYPE_LIST
FROM fx_load_types WHERE NOT (BI_MTR_POS_NBR = 1 AND BI_LOAD_TYPE NOT IN ('IR1', 'GN1')) GROUP BY ALL"""


@register("peak_by_lc_meter_dst", q("""
SELECT h.MeterNumber, h.UnitOfMeasure, h.FlowDirection, h.Channel,
       CAST(h.HourlyAMIValue AS DOUBLE) AS HourlyAMIValue, CAST(h.HourlyVEEValue AS DOUBLE) AS HourlyVEEValue,
       h.EndMeterSampleIndex, ipk.CoincidTime, ipk.CoincidYear, ipk.CoincidMonth, ipk.CoincidDay, ipk.CoincidHour,
       tl.BI_ACCT, tl.BI_MTR_NBR, tl.BI_MTR_POS_NBR, tl.BI_LOAD_TYPE_LIST,
       CAST(ipk.CoincidYear AS VARCHAR) || '-' || CAST(ipk.CoincidMonth AS VARCHAR) AS YearMonth
FROM hourly h JOIN ipk ON h.EndMeterSampleIndex = ipk.MeterSampleIndex
JOIN tl ON h.MeterNumber = tl.BI_MTR_NBR""", uses=("fx_bronze_dst", "fx_load_types", "fx_peaks_dst"),
    ctes=_on(O.HOURLY_CTES, fx_bronze="fx_bronze_dst") + _on(O.PEAK_CTES, fx_peaks="fx_peaks_dst") + [("tl", _TYPES)]))
def peak_by_lc_meter_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peaks at any hour of two years, on readings over the clock changes."""
    p = Pipeline.of(spark, sf_dir)
    peaks = P.index_peaks(P.peak_parts(p.fx.fx_peaks_dst))
    return out(P.peak_by_lc_meter(by_day_usage_at(spark, p.indexed_dst, peaks), peaks, p.fx.fx_load_types),
               double=_HOURLY_DOUBLES)


@register("hourly_usage_bucketed", q(f"SELECT {_HOURLY_COLS} FROM hourly_nosub", uses=("fx_bronze", "fx_meter_info"),
                                     ctes=O.HOURLY_NOSUB_CTES))
def hourly_usage_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and submeters as catalogue tables bucketed by meter: neither the
    exclusion of the submeters nor the hourly rollup moves a reading."""
    p = Pipeline.of(spark, sf_dir)
    folder = scratch_folder(spark, "bucketed")
    name = "vf_" + folder.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(p.indexed, f"{name}_readings", f"{folder}/readings", "MeterNumber", buckets)
    write_bucketed(p.submeter_map, f"{name}_submeters", f"{folder}/submeters", "BI_MTR_NBR", buckets)
    main = S.exclude_submeters(spark.table(f"{name}_readings"), spark.table(f"{name}_submeters").hint("merge"))
    return out(H.hourly_usage(main), double=_HOURLY_DOUBLES)
