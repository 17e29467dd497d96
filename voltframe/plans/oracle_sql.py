"""DuckDB fragments shared by the oracle statements.

The oracle is written independently of the Spark operators: plain SQL over
the fixture CTEs, in the most literal form of each rule (joins back to
counts, range scans, the full programme-map expansion).
"""

from __future__ import annotations

from voltframe.functions.timeindex import CALENDAR_START_EPOCH, LOCAL_TZ, MAX_INDEX

E0 = CALENDAR_START_EPOCH
KEY = "MeterNumber, UnitOfMeasure, FlowDirection, Channel, StartDateTime, EndDateTime"


def idx(col: str) -> str:
    t = f"date_trunc('minute', {col})"
    off = f"(CAST(epoch({t}) AS BIGINT) - {E0})"
    return (f"CASE WHEN minute({t}) % 5 = 0 AND {off} >= 0 AND {off} // 300 + 1 <= {MAX_INDEX} "
            f"THEN CAST({off} // 300 + 1 AS INTEGER) END")


def utc_of(i: str) -> str:
    return f"(TIMESTAMP '2021-01-01 00:00:00' + CAST({i} - 1 AS BIGINT) * INTERVAL '5' MINUTE)"


def local_of_utc(ts: str) -> str:
    return f"timezone('{LOCAL_TZ}', timezone('UTC', {ts}))"


def local_of(i: str) -> str:
    return local_of_utc(utc_of(i))


CLEANED = f"""
SELECT {KEY}, AMIValue, VEEValue FROM (
  SELECT d.*, COALESCE(c.cnt, 1) AS DupCount
  FROM (SELECT DISTINCT {KEY}, AMIValue, VEEValue FROM fx_bronze) d
  LEFT JOIN (SELECT {KEY}, COUNT(*) AS cnt
             FROM (SELECT DISTINCT {KEY}, AMIValue, VEEValue FROM fx_bronze) x
             GROUP BY ALL HAVING COUNT(*) > 1) c USING ({KEY})) j
WHERE NOT (VEEValue IS NULL AND DupCount = 2)
  AND NOT (VEEValue = 0 AND AMIValue = 0 AND DupCount = 2)
  AND NOT (AMIValue = 0 AND DupCount = 2)"""

INDEXED = f"""
SELECT *, CAST((EndMeterSampleIndex - StartMeterSampleIndex) * 5 AS INTEGER) AS SampleRate FROM (
  SELECT *, {idx('StartDateTime')} AS StartMeterSampleIndex, {idx('EndDateTime')} AS EndMeterSampleIndex
  FROM cleaned) t"""

SUBMAP = """
SELECT s.BI_ACCT, s.BI_MTR_NBR, s.BI_MTR_POS_NBR, s.BI_MTR_CONFIG, o.BI_MTR_NBR AS MainMeter
FROM fx_meter_info s LEFT JOIN fx_meter_info o ON s.BI_ACCT = o.BI_ACCT
WHERE s.BI_MTR_CONFIG = 'S' AND o.BI_MTR_POS_NBR = 1"""

NOSUB = "SELECT * FROM indexed i WHERE NOT EXISTS (SELECT 1 FROM submap m WHERE m.BI_MTR_NBR = i.MeterNumber)"


def hourly_of(src: str) -> str:
    lt = local_of("StartMeterSampleIndex")
    return f"""
SELECT MeterNumber, UnitOfMeasure, FlowDirection, Channel,
       CAST(year(lt) AS INTEGER) AS LocalYear, CAST(month(lt) AS INTEGER) AS LocalMonth,
       CAST(day(lt) AS INTEGER) AS LocalDay, CAST(hour(lt) + 1 AS INTEGER) AS HourEnding,
       SUM(AMIValue) AS HourlyAMIValue, SUM(VEEValue) AS HourlyVEEValue,
       MAX(EndMeterSampleIndex) AS EndMeterSampleIndex
FROM (SELECT *, {lt} AS lt FROM {src} WHERE StartMeterSampleIndex IS NOT NULL) t
GROUP BY MeterNumber, UnitOfMeasure, FlowDirection, Channel, 5, 6, 7, 8"""


TOTALS = """
SELECT LocalYear AS Year, LocalMonth AS Month, LocalDay AS Day, HourEnding,
       SUM(HourlyAMIValue) AS AllMetersDayHourAMIValue, SUM(HourlyVEEValue) AS AllMetersDayHourVEEValue
FROM hourly_nosub GROUP BY ALL"""

READING_CTES = [("cleaned", CLEANED), ("indexed", INDEXED)]
NOSUB_CTES = READING_CTES + [("submap", SUBMAP), ("nosub", NOSUB)]
HOURLY_CTES = READING_CTES + [("hourly", hourly_of("indexed"))]
HOURLY_NOSUB_CTES = NOSUB_CTES + [("hourly_nosub", hourly_of("nosub"))]
TOTALS_CTES = HOURLY_NOSUB_CTES + [("totals", TOTALS)]


def calendar_cte(lo_expr: str, hi_expr: str) -> str:
    """Slots between two UTC timestamps (expressions), one day of margin,
    with their local wall time ``lt`` -- the literal calendar the reference
    joins against."""
    return f"""
SELECT CAST(i AS INTEGER) AS MeterSampleIndex, {local_of('i')} AS lt FROM (
  SELECT unnest(range(GREATEST(lo, 1), LEAST(hi, {MAX_INDEX}) + 1)) AS i FROM (
    SELECT (CAST(epoch({lo_expr}) AS BIGINT) - {E0}) // 300 + 1 - 288 AS lo,
           (CAST(epoch({hi_expr}) AS BIGINT) - {E0}) // 300 + 1 + 288 AS hi) b) s"""


LC_PERIODS_CTES = [
    ("ev", """SELECT DISTINCT Date, Program, StartTime, StopTime FROM fx_lc_text"""),
    ("evt", """SELECT *, strptime(Date || ' ' || StartTime, '%m/%d/%Y %H:%M') AS StartDateTime,
                        strptime(Date || ' ' || StopTime, '%m/%d/%Y %H:%M') AS EndDateTime FROM ev"""),
    ("lccal", calendar_cte("(SELECT MIN(StartDateTime) FROM evt) - INTERVAL '1' DAY",
                           "(SELECT MAX(EndDateTime) FROM evt) + INTERVAL '1' DAY")),
    ("periods", """
SELECT e.Date, e.Program, e.StartTime, e.StopTime, e.StartDateTime, e.EndDateTime,
       cs.MeterSampleIndex AS StartMeterSampleIndex, ce.MeterSampleIndex AS EndMeterSampleIndex,
       CAST((ce.MeterSampleIndex - cs.MeterSampleIndex) * 5 AS INTEGER) AS TotalTime_Minutes,
       replace(e.Program, ' ', '_') AS ProgramId,
       concat_ws('_', replace(e.Program, ' ', '_'), CAST(e.StartDateTime AS VARCHAR),
                 CAST(e.EndDateTime AS VARCHAR)) AS LoadControlEventID
FROM evt e LEFT JOIN lccal cs ON cs.lt = e.StartDateTime LEFT JOIN lccal ce ON ce.lt = e.EndDateTime"""),
    ("rawpts", """
SELECT LoadControlEventID, Program,
       unnest(range(StartMeterSampleIndex - 48, EndMeterSampleIndex + 48 + 1)) AS MeterSampleIndex
FROM periods WHERE StartMeterSampleIndex IS NOT NULL AND EndMeterSampleIndex IS NOT NULL"""),
    ("points", """
SELECT p.LoadControlEventID, p.Program, CAST(p.MeterSampleIndex AS INTEGER) AS MeterSampleIndex,
       CAST(CASE WHEN p.MeterSampleIndex > b.StartMeterSampleIndex
                  AND p.MeterSampleIndex <= b.EndMeterSampleIndex THEN 1 ELSE 0 END AS INTEGER) AS LoadControlEvent
FROM rawpts p JOIN periods b USING (LoadControlEventID)
WHERE b.StartMeterSampleIndex IS NOT NULL AND b.EndMeterSampleIndex IS NOT NULL"""),
]

# the reference's literal fulfilment: every point x every map row of its programme
LC_FULFIL_CTES = LC_PERIODS_CTES + [
    ("mts", """SELECT p.*, m.BI_ACCT, m.BI_SRV_LOC_NBR, m.BI_MTR_NBR, m.BI_LOAD_TYPE
               FROM points p JOIN fx_load_types m ON p.Program = m.BI_LOAD_TYPE"""),
    ("dups", """SELECT MeterSampleIndex, BI_MTR_NBR, COUNT(BI_LOAD_TYPE) AS Count FROM mts
                GROUP BY MeterSampleIndex, BI_MTR_NBR"""),
    ("pc", """SELECT BI_MTR_NBR, COUNT(BI_LOAD_TYPE) AS ProgramCount FROM fx_load_types GROUP BY BI_MTR_NBR"""),
    ("pdiff", """SELECT d.BI_MTR_NBR, d.MeterSampleIndex, pc.ProgramCount - d.Count AS ProgramDiff
                 FROM pc JOIN dups d USING (BI_MTR_NBR)"""),
]

# events and programme map that grow, on the readings moved over the clock
# changes: every slot of every event, then the matches of each reading's meter
LC_WIDE_CTES = ([(n, b.replace("fx_bronze", "fx_bronze_dst")) for n, b in READING_CTES]
                + [(n, b.replace("fx_lc_text", "fx_lc_text_wide")) for n, b in LC_PERIODS_CTES] + [
    ("cover", "SELECT Program, MeterSampleIndex, COUNT(*) AS c FROM points GROUP BY ALL"),
    ("ends", """SELECT DISTINCT MeterNumber, EndMeterSampleIndex AS i FROM indexed
                WHERE FlowDirection = 'F' AND Channel = 1 AND EndMeterSampleIndex IS NOT NULL"""),
    ("matches", """SELECT e.MeterNumber, e.i, SUM(CASE WHEN m.BI_LOAD_TYPE IS NULL THEN 0 ELSE c END) AS n
                   FROM ends e JOIN fx_load_types_wide m ON m.BI_MTR_NBR = e.MeterNumber
                   JOIN cover ON cover.Program = m.Program AND cover.MeterSampleIndex = e.i GROUP BY ALL"""),
    ("ful", """SELECT MeterNumber, i FROM matches JOIN (SELECT BI_MTR_NBR, COUNT(BI_LOAD_TYPE) AS programs
               FROM fx_load_types_wide GROUP BY ALL) pc ON pc.BI_MTR_NBR = MeterNumber WHERE n = programs"""),
    ("fts", """SELECT DISTINCT m.BI_ACCT, m.BI_SRV_LOC_NBR, m.BI_MTR_NBR, ful.i AS MeterSampleIndex,
               p.LoadControlEventID, m.BI_LOAD_TYPE, p.LoadControlEvent
               FROM ful JOIN fx_load_types_wide m ON m.BI_MTR_NBR = ful.MeterNumber
               JOIN points p ON p.Program = m.Program AND p.MeterSampleIndex = ful.i"""),
])

PEAK_CTES = [
    ("pk", """SELECT CoincidTime, CAST(year(CoincidTime) AS INTEGER) AS CoincidYear,
                     CAST(month(CoincidTime) AS INTEGER) AS CoincidMonth,
                     CAST(day(CoincidTime) AS INTEGER) AS CoincidDay,
                     CAST(hour(CoincidTime) AS INTEGER) AS CoincidHour FROM fx_peaks"""),
    ("pkcal", calendar_cte("(SELECT MIN(CoincidTime) FROM pk) - INTERVAL '1' DAY",
                           "(SELECT MAX(CoincidTime) FROM pk) + INTERVAL '1' DAY")),
    ("ipk", "SELECT pk.*, c.MeterSampleIndex FROM pk JOIN pkcal c ON c.lt = pk.CoincidTime"),
]


def us_holiday_rows(first_year: int, last_year: int) -> list[tuple]:
    """(year, date, name) by the federal rules, written with ``datetime``
    (the oracle side of the Spark rule table)."""
    import datetime as dt

    def observed(d):
        if d.weekday() == 5:
            return d - dt.timedelta(days=1)
        if d.weekday() == 6:
            return d + dt.timedelta(days=1)
        return d

    def nth(y, m, wd, n):  # wd: Monday=0
        if n > 0:
            d = dt.date(y, m, 1)
            d += dt.timedelta(days=(wd - d.weekday()) % 7)
            return d + dt.timedelta(weeks=n - 1)
        d = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1))
        return d - dt.timedelta(days=(d.weekday() - wd) % 7)

    rows = []
    for y in range(first_year, last_year + 1):
        fixed = [("New Year's Day", dt.date(y, 1, 1)), ("Independence Day", dt.date(y, 7, 4)),
                 ("Veterans Day", dt.date(y, 11, 11)), ("Christmas Day", dt.date(y, 12, 25))]
        if y >= 2021:
            fixed.append(("Juneteenth National Independence Day", dt.date(y, 6, 19)))
        for name, d in fixed:
            rows.append((y, d, name))
            o = observed(d)
            if o != d and o.year == y:
                rows.append((y, o, name + " (observed)"))
        if dt.date(y + 1, 1, 1).weekday() == 5:
            rows.append((y, dt.date(y, 12, 31), "New Year's Day (observed)"))
        for name, m, wd, n in [("Martin Luther King Jr. Day", 1, 0, 3), ("Washington's Birthday", 2, 0, 3),
                               ("Memorial Day", 5, 0, -1), ("Labor Day", 9, 0, 1),
                               ("Columbus Day", 10, 0, 2), ("Thanksgiving", 11, 3, 4)]:
            rows.append((y, nth(y, m, wd, n), name))
    return rows


def holidays_values(first_year: int = 2021, last_year: int = 2040) -> str:
    vals = ",\n".join(f"({y}, DATE '{d.isoformat()}', '{n.replace(chr(39), chr(39) * 2)}')"
                      for y, d, n in us_holiday_rows(first_year, last_year))
    return f"SELECT * FROM (VALUES {vals}) AS h(Year, HolidayDate, HolidayName)"
