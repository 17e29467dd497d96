"""Meter-domain inputs derived from the driver's tables.

Each fixture is one portable SQL statement (Spark SQL and DuckDB agree on
it) with ``{name}`` placeholders for the tables it reads. On Spark the
placeholders are bound to DataFrames (``spark.sql(text, **frames)``); for the
DuckDB oracle the same statements become CTEs. Every fixture reads whole
driver tables, so its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.session import use_utc

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

# name -> (inputs, SQL)
FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    # one reading slot per (meter, unit, direction, channel, 15-minute start)
    "fx_slots": (("events",), """
SELECT CAST(user_id AS INT) AS MeterNumber,
       CASE WHEN event_type = 'error' THEN 'KVARH' ELSE 'KWH' END AS UnitOfMeasure,
       CASE WHEN event_id % 7 = 0 THEN 'R' ELSE 'F' END AS FlowDirection,
       CAST(CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END AS INT) AS Channel,
       CAST(date_trunc('hour', ts) + CAST(FLOOR(EXTRACT(MINUTE FROM ts) / 15) AS INT) * INTERVAL '15' MINUTE AS TIMESTAMP) AS StartDateTime,
       MIN(event_id) AS k,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v
FROM {events} GROUP BY 1, 2, 3, 4, 5"""),
    # bronze readings: base rows plus exact copies and three kinds of bad pair
    "fx_bronze": (("fx_slots",), """
SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE AS EndDateTime,
       v AS AMIValue, CASE WHEN k % 11 = 0 THEN NULL ELSE v END AS VEEValue FROM {fx_slots}
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE AS EndDateTime,
       v, CASE WHEN k % 11 = 0 THEN NULL ELSE v END FROM {fx_slots} WHERE k % 50 = 1
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE AS EndDateTime,
       CAST(0 AS DECIMAL(18,2)), CAST(NULL AS DECIMAL(18,2)) FROM {fx_slots} WHERE k % 50 = 2
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE AS EndDateTime,
       CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)) FROM {fx_slots} WHERE k % 50 = 3
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE AS EndDateTime,
       CAST(0 AS DECIMAL(18,2)), v FROM {fx_slots} WHERE k % 50 = 4"""),
    # the cases that real extracts rarely have: pairs with a null key column,
    # a null AMI in a pair, keys with three different rows
    "fx_bronze_hard": (("fx_bronze", "fx_slots"), """
SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime, EndDateTime, AMIValue, VEEValue FROM {fx_bronze}
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, CAST(NULL AS INT), StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE, v, v FROM {fx_slots} WHERE k % 50 = 5
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, CAST(NULL AS INT), StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE, CAST(0 AS DECIMAL(18,2)), v FROM {fx_slots} WHERE k % 50 = 5
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE, CAST(NULL AS DECIMAL(18,2)), v FROM {fx_slots} WHERE k % 50 = 6
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE, CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)) FROM {fx_slots} WHERE k % 50 = 7
UNION ALL SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime,
       StartDateTime + INTERVAL '15' MINUTE, CAST(v + 1 AS DECIMAL(18,2)), v FROM {fx_slots} WHERE k % 50 = 7"""),
    # the bronze readings, by meter moved over both clock changes of 2024 and
    # the first of 2025
    "fx_bronze_dst": (("fx_bronze",), """
SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel,
       StartDateTime + CAST(CASE MeterNumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 55 WHEN 2 THEN 290 ELSE 420 END AS INT)
                       * INTERVAL '1' DAY AS StartDateTime,
       EndDateTime + CAST(CASE MeterNumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 55 WHEN 2 THEN 290 ELSE 420 END AS INT)
                     * INTERVAL '1' DAY AS EndDateTime, AMIValue, VEEValue
FROM {fx_bronze}"""),
    # peaks at any half past an hour of two years (local wall time): hours that
    # the clock skips or repeats are among them
    "fx_peaks_dst": (("orders",), """
SELECT DISTINCT CAST(TIMESTAMP '2024-01-01 00:30:00' + CAST(o_orderkey % 17544 AS INT) * INTERVAL '1' HOUR AS TIMESTAMP) AS CoincidTime
FROM {orders}"""),
    # the 16-column landing layout
    "fx_bronze16": (("fx_bronze", "nation"), """
SELECT b.MeterNumber, b.UnitOfMeasure, b.FlowDirection, b.Channel,
       CAST(b.MeterNumber AS STRING) AS ServiceLocation, 'R1' AS RateCode,
       'Residential' AS RateDescription,
       CONCAT('SUB', CAST(b.MeterNumber % 25 AS STRING)) AS SubstationCode,
       n.n_name AS SubstationDescription, CAST(b.MeterNumber % 7 AS INT) AS Feeder,
       '00001' AS ZipCode, b.StartDateTime, b.EndDateTime, 1 AS Multiplier,
       b.AMIValue, b.VEEValue
FROM {fx_bronze} b JOIN {nation} n ON n.n_nationkey = b.MeterNumber % 25"""),
    # raw, off-grid readings (quality check input)
    "fx_raw_readings": (("events",), """
SELECT CAST(user_id AS INT) AS MeterNumber,
       CASE WHEN event_type = 'error' THEN 'KVARH' ELSE 'KWH' END AS UnitOfMeasure,
       CAST(ts AS TIMESTAMP) AS StartDateTime,
       CAST(ts AS TIMESTAMP) + INTERVAL '15' MINUTE AS EndDateTime,
       CAST(value AS DECIMAL(18,2)) AS AMIValue
FROM {events}"""),
    "fx_meter_info": (("customer",), """
SELECT CAST(FLOOR(c_custkey / 3) AS INT) AS BI_ACCT, CAST(c_custkey AS INT) AS BI_MTR_NBR,
       CAST(c_custkey % 3 + 1 AS INT) AS BI_MTR_POS_NBR,
       CASE WHEN c_custkey % 3 = 2 THEN 'S' ELSE 'M' END AS BI_MTR_CONFIG
FROM {customer}"""),
    "fx_load_types": (("fx_meter_info",), """
SELECT BI_ACCT, BI_MTR_NBR, BI_MTR_POS_NBR, BI_ACCT AS BI_SRV_LOC_NBR,
       CASE WHEN BI_MTR_NBR % 4 = 0 THEN 'IR1' WHEN BI_MTR_NBR % 4 = 1 THEN 'DF1' ELSE 'WH1' END AS BI_LOAD_TYPE,
       CONCAT('Load type ', CASE WHEN BI_MTR_NBR % 4 = 0 THEN 'IR1' WHEN BI_MTR_NBR % 4 = 1 THEN 'DF1' ELSE 'WH1' END) AS BI_LOAD_TYPE_DESC
FROM {fx_meter_info}
UNION ALL SELECT BI_ACCT, BI_MTR_NBR, BI_MTR_POS_NBR, BI_ACCT, 'GN1', 'Load type GN1'
FROM {fx_meter_info} WHERE BI_MTR_NBR % 5 = 0"""),
    # load-control events (local wall time): start hour 6, 11 or 16, four hours
    "fx_lc_events": (("orders",), """
SELECT DISTINCT CASE o_orderkey % 4 WHEN 0 THEN 'IR1' WHEN 1 THEN 'DF1' WHEN 2 THEN 'WH1' ELSE 'GN1' END AS Program,
       CAST(TIMESTAMP '2024-01-01 00:00:00' + CAST(o_orderkey % 28 AS INT) * INTERVAL '1' DAY
            + CAST(6 + (o_orderkey % 3) * 5 AS INT) * INTERVAL '1' HOUR AS TIMESTAMP) AS StartDateTime,
       CAST(TIMESTAMP '2024-01-01 00:00:00' + CAST(o_orderkey % 28 AS INT) * INTERVAL '1' DAY
            + CAST(6 + (o_orderkey % 3) * 5 + 4 AS INT) * INTERVAL '1' HOUR AS TIMESTAMP) AS EndDateTime
FROM {orders}"""),
    # the same events as the landing CSV text (Date M/d/yyyy, Start/StopTime H:mm)
    "fx_lc_text": (("fx_lc_events",), """
SELECT CONCAT(CAST(month(StartDateTime) AS STRING), '/', CAST(dayofmonth(StartDateTime) AS STRING), '/',
              CAST(year(StartDateTime) AS STRING)) AS Date,
       Program,
       CONCAT(CAST(hour(StartDateTime) AS STRING), ':', lpad(CAST(minute(StartDateTime) AS STRING), 2, '0')) AS StartTime,
       CONCAT(CAST(hour(EndDateTime) AS STRING), ':', lpad(CAST(minute(EndDateTime) AS STRING), 2, '0')) AS StopTime
FROM {fx_lc_events}"""),
    # one event for every order, in the programme of the customer's zone (15
    # customers), on the days of ``fx_bronze_dst``: events overlap, cross the clock
    # changes and midnight, and one in 97 is named twice in two date formats
    "fx_lc_text_wide": (("orders",), """
SELECT DISTINCT CONCAT(CASE WHEN twice = 1 THEN lpad(CAST(month(day) AS STRING), 2, '0') ELSE CAST(month(day) AS STRING) END,
              '/', CAST(dayofmonth(day) AS STRING), '/', CAST(year(day) AS STRING)) AS Date, Program,
       CONCAT(CAST(CAST(FLOOR(first / 60) AS INT) AS STRING), ':', lpad(CAST(first % 60 AS STRING), 2, '0')) AS StartTime,
       CONCAT(CAST(CAST(FLOOR(last / 60) AS INT) AS STRING), ':', lpad(CAST(last % 60 AS STRING), 2, '0')) AS StopTime
FROM (SELECT Program, day, first, (first + length) % 1440 AS last, twice
      FROM (SELECT CONCAT(CASE o_orderkey % 4 WHEN 0 THEN 'IR1' WHEN 1 THEN 'DF1' WHEN 2 THEN 'WH1' ELSE 'GN1' END, ' Z',
                   CAST(CAST(FLOOR(o_custkey / 15) AS INT) AS STRING)) AS Program,
            CAST(TIMESTAMP '2024-01-01 00:00:00'
                 + CAST(CASE FLOOR(o_orderkey / 4) % 4 WHEN 0 THEN 0 WHEN 1 THEN 55 WHEN 2 THEN 290 ELSE 420 END AS INT)
                   * INTERVAL '1' DAY + CAST(FLOOR(o_orderkey / 16) % 30 AS INT) * INTERVAL '1' DAY AS TIMESTAMP) AS day,
            CAST((o_orderkey * 7) % 288 * 5 AS INT) AS first, CAST(30 + (o_orderkey % 12) * 25 AS INT) AS length, 0 AS twice
            FROM {orders}
            UNION ALL
            SELECT CONCAT(CASE o_orderkey % 4 WHEN 0 THEN 'IR1' WHEN 1 THEN 'DF1' WHEN 2 THEN 'WH1' ELSE 'GN1' END, ' Z',
                   CAST(CAST(FLOOR(o_custkey / 15) AS INT) AS STRING)),
            CAST(TIMESTAMP '2024-01-01 00:00:00'
                 + CAST(CASE FLOOR(o_orderkey / 4) % 4 WHEN 0 THEN 0 WHEN 1 THEN 55 WHEN 2 THEN 290 ELSE 420 END AS INT)
                   * INTERVAL '1' DAY + CAST(FLOOR(o_orderkey / 16) % 30 AS INT) * INTERVAL '1' DAY AS TIMESTAMP),
            CAST((o_orderkey * 7) % 288 * 5 AS INT), CAST(30 + (o_orderkey % 12) * 25 AS INT), 1
            FROM {orders} WHERE o_orderkey % 97 = 0) o) e"""),
    "fx_load_types_wide": (("fx_load_types",), """
SELECT BI_ACCT, BI_MTR_NBR, BI_MTR_POS_NBR, BI_SRV_LOC_NBR, BI_LOAD_TYPE,
       CONCAT(BI_LOAD_TYPE, ' Z', CAST(CAST(FLOOR(BI_MTR_NBR / 15) AS INT) AS STRING)) AS Program
FROM {fx_load_types}"""),
    # coincident peaks (local wall time), one per day at 18:00
    "fx_peaks": (("orders",), """
SELECT DISTINCT CAST(TIMESTAMP '2024-01-01 18:00:00' + CAST(o_orderkey % 28 AS INT) * INTERVAL '1' DAY AS TIMESTAMP) AS CoincidTime
FROM {orders}"""),
    "fx_rates": (("nation",), """
SELECT CAST(n_nationkey % 12 + 1 AS INT) AS Month, CAST(10 + MAX(n_nationkey) AS DOUBLE) AS DemandRate
FROM {nation} GROUP BY CAST(n_nationkey % 12 + 1 AS INT)"""),
    "fx_cis_service": (("customer",), """
SELECT CAST(c_custkey AS INT) AS BI_SRV_LOC_NBR, CAST(FLOOR(c_custkey / 3) AS INT) AS BI_ACCT,
       CAST(TIMESTAMP '2015-01-01 00:00:00' AS TIMESTAMP) AS BI_CON_DT, 'A1' AS BI_PRIM_RATE_SCHED,
       CASE WHEN c_custkey % 10 = 9 THEN 'WATR' ELSE 'ELEC' END AS BI_TYPE_SRV_GRP,
       CASE WHEN c_custkey % 13 = 0 THEN CAST(TIMESTAMP '2020-01-01 00:00:00' AS TIMESTAMP)
            ELSE CAST(NULL AS TIMESTAMP) END AS BI_DISC_DT
FROM {customer}"""),
    "fx_cis_lm_srv": (("fx_cis_service",), """
SELECT BI_SRV_LOC_NBR, BI_ACCT FROM {fx_cis_service}"""),
    "fx_cis_lm_dvc": (("fx_load_types",), """
SELECT DISTINCT BI_ACCT, BI_MTR_POS_NBR, BI_LOAD_TYPE FROM {fx_load_types}"""),
    "fx_cis_ref": (("fx_load_types",), """
SELECT DISTINCT BI_LOAD_TYPE, CONCAT('Load type ', BI_LOAD_TYPE) AS BI_LOAD_TYPE_DESC FROM {fx_load_types}"""),
    "fx_cis_mtr": (("fx_meter_info",), """
SELECT BI_ACCT, BI_MTR_NBR AS BI_SRV_LOC_NBR, BI_MTR_POS_NBR, BI_MTR_NBR FROM {fx_meter_info}"""),
    # five monthly workbooks, one row per sheet row: header row 11, peak row
    # 12, one substation row per supplier from row 13, one blank row, TOTALS
    "fx_sheet": (("supplier", "region"), """
SELECT CONCAT('m', CAST(s_suppkey % 5 + 1 AS STRING), '.xlsx') AS file,
       CAST(13 + FLOOR(s_suppkey / 5) AS INT) AS r,
       CAST(s_suppkey AS STRING) AS c0, s_name AS c1, 'C1' AS c2,
       CONCAT('2024-0', CAST(s_suppkey % 5 + 1 AS STRING), '-10 07:00:00') AS c3,
       CONCAT(CAST(100 + s_nationkey AS STRING), 'A') AS c4,
       CAST(90 + s_nationkey AS STRING) AS c5, CAST(80 + s_nationkey AS STRING) AS c6,
       '0.5' AS c7, '0.9' AS c8
FROM {supplier}
UNION ALL SELECT CONCAT('m', CAST(r_regionkey + 1 AS STRING), '.xlsx'), 12, NULL, NULL, NULL, NULL, NULL,
       CONCAT('2024-0', CAST(r_regionkey + 1 AS STRING), '-15 18:00:00'), NULL, NULL, NULL FROM {region}
UNION ALL SELECT CONCAT('m', CAST(g + 1 AS STRING), '.xlsx'), CAST(15 + mx AS INT), 'TOTALS', NULL, NULL, NULL,
       '1', '2', '3', NULL, NULL
FROM (SELECT s_suppkey % 5 AS g, MAX(FLOOR(s_suppkey / 5)) AS mx FROM {supplier} GROUP BY s_suppkey % 5) t"""),
    "fx_cells": (("fx_sheet",), " UNION ALL ".join(
        f"SELECT file, r AS row_no, {i} AS col_no, c{i} AS value FROM {{fx_sheet}} WHERE c{i} IS NOT NULL"
        for i in range(9))),
}


# Spark-side form of the slots: the events are dealt out by slot into partitions
# that follow their number and grouped inside them. Grouped before the exchange,
# a task would hold the slots of its whole file split, however long that is.
_SLOT = {
    "MeterNumber": "CAST(user_id AS INT)",
    "UnitOfMeasure": "CASE WHEN event_type = 'error' THEN 'KVARH' ELSE 'KWH' END",
    "FlowDirection": "CASE WHEN event_id % 7 = 0 THEN 'R' ELSE 'F' END",
    "Channel": "CAST(CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END AS INT)",
    "StartDateTime": "CAST(date_trunc('hour', ts) + CAST(FLOOR(EXTRACT(MINUTE FROM ts) / 15) AS INT) "
                     "* INTERVAL '15' MINUTE AS TIMESTAMP)"}


def _spark_slots(fx: "Fixtures") -> DataFrame:
    rows = fx["events"].select(*[F.expr(x).alias(c) for c, x in _SLOT.items()], "event_id",
                               F.col("value").cast("decimal(18,2)").alias("value"))
    return (rows.repartition(fx.parts("events"), *_SLOT).groupBy(*_SLOT)
            .agg(F.min("event_id").alias("k"), F.sum("value").cast("decimal(18,2)").alias("v")))


# Spark-side forms of the fixtures that the SQL text writes as UNION ALL of
# several filtered copies of one input: one pass with ``explode`` instead, so
# the input is scanned and aggregated once (the union branches prune
# different columns and would not share an exchange).
def _spark_bronze(fx: "Fixtures") -> DataFrame:
    s = fx["fx_slots"]
    k, v = F.col("k"), F.col("v")
    zero = F.lit(0).cast("decimal(18,2)")
    vee = F.when(k % 11 == 0, F.lit(None).cast("decimal(18,2)")).otherwise(v)

    def row(a, b):
        return F.struct(a.cast("decimal(18,2)").alias("AMIValue"), b.cast("decimal(18,2)").alias("VEEValue"))
    variants = F.filter(F.array(
        row(v, vee),
        F.when(k % 50 == 1, row(v, vee)),
        F.when(k % 50 == 2, row(zero, F.lit(None))),
        F.when(k % 50 == 3, row(zero, zero)),
        F.when(k % 50 == 4, row(zero, v))), lambda x: x.isNotNull())
    return (s.select("MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel", "StartDateTime",
                     (F.col("StartDateTime") + F.expr("INTERVAL 15 MINUTES")).alias("EndDateTime"),
                     F.explode(variants).alias("_r"))
            .select("MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel", "StartDateTime",
                    "EndDateTime", "_r.AMIValue", "_r.VEEValue"))


def _spark_load_types(fx: "Fixtures") -> DataFrame:
    mi = fx["fx_meter_info"]
    n = F.col("BI_MTR_NBR")
    base = F.when(n % 4 == 0, "IR1").when(n % 4 == 1, "DF1").otherwise("WH1")
    types = F.filter(F.array(base, F.when(n % 5 == 0, F.lit("GN1"))), lambda x: x.isNotNull())
    return (mi.select("BI_ACCT", "BI_MTR_NBR", "BI_MTR_POS_NBR",
                      F.col("BI_ACCT").alias("BI_SRV_LOC_NBR"), F.explode(types).alias("BI_LOAD_TYPE"))
            .withColumn("BI_LOAD_TYPE_DESC", F.concat(F.lit("Load type "), "BI_LOAD_TYPE")))


def _spark_cells(fx: "Fixtures") -> DataFrame:
    sh = fx["fx_sheet"]
    cells = F.array(*[F.struct(F.lit(i).alias("col_no"), F.col(f"c{i}").alias("value")) for i in range(9)])
    return (sh.select("file", F.col("r").alias("row_no"), F.explode(cells).alias("_c"))
            .select("file", "row_no", "_c.col_no", "_c.value")
            .filter(F.col("value").isNotNull()))


SPARK_FIXTURES = {"fx_slots": _spark_slots, "fx_bronze": _spark_bronze, "fx_load_types": _spark_load_types,
                  "fx_cells": _spark_cells}


def resolve(names) -> list[str]:
    """Fixtures needed by ``names`` in dependency order."""
    order: list[str] = []

    def visit(n):
        if n in DRIVER_TABLES or n in order:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duckdb_sql(body: str, uses, ctes: list[tuple[str, str]] | None = None) -> str:
    """Oracle text: fixture CTEs, then query-local CTEs, then ``body``."""
    parts = []
    for n in resolve(uses):
        deps, text = FIXTURES[n]
        parts.append(f"{n} AS ({text.format(**{d: d for d in deps})})")
    for name, text in ctes or []:
        parts.append(f"{name} AS ({text})")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


class Fixtures:
    """Lazily built fixture DataFrames over one driver data folder.

    ``Fixtures.of(spark, dir)`` returns one shared instance per session and
    folder: the DataFrames are plans (no data is cached), so queries reuse the
    analysed plans and the parquet file listings instead of rebuilding them.
    """

    _shared: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        key = (id(getattr(spark, "_jsparkSession", spark)), sf_dir.rstrip("/"))
        fx = cls._shared.get(key)
        if fx is None or fx.spark is not spark:
            fx = cls._shared[key] = cls(spark, sf_dir)
        use_utc(spark)
        return fx

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}
        use_utc(spark)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def parts(self, name: str, rows_each: int = 150_000) -> int:
        """How many partitions of ``rows_each`` rows a driver table fills (its row
        count stands in the files' footers), and no fewer than there are cores."""
        if name not in self._rows:
            self._rows[name] = self.table(name).count()
        return max(self.spark.sparkContext.defaultParallelism, -(-self._rows[name] // rows_each))

    def __getitem__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.table(name)
        if name not in self._cache:
            if name in SPARK_FIXTURES:
                self._cache[name] = SPARK_FIXTURES[name](self)
            else:
                deps, text = FIXTURES[name]
                self._cache[name] = self.spark.sql(text, **{d: self[d] for d in deps})
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_") or name in DRIVER_TABLES:
            return self[name]
        raise AttributeError(name)
