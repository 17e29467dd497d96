import pytest

from voltframe.operators import peaks as P
from voltframe.operators import submeters as S

CELLS = "file string, row_no int, col_no int, value string"


def test_sheet_slicing_rules(spark):
    cells = []
    for f in ("a.xlsx", "b.xlsx"):
        cells += [(f, 12, 5, "2024-03-15 18:00:00")]
        cells += [(f, r, c, f"{f}-{r}-{c}") for r in (13, 14, 15) for c in (0, 1)]
    cells += [("a.xlsx", 16, 0, "TOTALS")]      # row 15 (just above) is dropped too
    cells += [("a.xlsx", 5, 0, "TOTALS")]       # above the header: ignored
    df = spark.createDataFrame(cells, CELLS)
    with pytest.raises(Exception, match="no TOTALS row in b.xlsx"):  # not dropped in silence
        P.slice_sheets(df).collect()
    bad = [("c.xlsx", 12, 5, "soon"), ("c.xlsx", 13, 1, "Sub"), ("c.xlsx", 15, 0, "TOTALS")]
    with pytest.raises(Exception, match="no peak time in c.xlsx"):
        P.monthly_substation_load(spark.createDataFrame(bad, CELLS)).collect()
    with pytest.raises(Exception, match="no peak cell in c.xlsx"):
        P.monthly_substation_load(spark.createDataFrame(bad[1:], CELLS)).collect()
    df = df.filter("file = 'a.xlsx'")
    rows = P.sheet_rows(P.slice_sheets(df)).collect()
    assert sorted((r.file, r.row_no) for r in rows) == [("a.xlsx", 12), ("a.xlsx", 13), ("a.xlsx", 14)]
    peaks = P.coincident_peaks(df).collect()
    assert [(p.file, p.CoincidMonth, p.CoincidHour) for p in peaks] == [("a.xlsx", 3, 18)]


def test_submeter_map_from_text_ids(spark):
    mi = spark.createDataFrame([
        ("1", "10", "1", "M"), ("1", "11", "2", "S"),           # simple account
        ("2", "20", "1", "M"), ("2", "21", "1", "M"), ("2", "22", "3", "S"),  # two mains
        ("3", "x31", "1", "M"), ("3", "32", "2", "S"),          # bad main id -> null
        ("4", "42", "2", "S"),                                  # no main meter
    ], "BI_ACCT string, BI_MTR_NBR string, BI_MTR_POS_NBR string, BI_MTR_CONFIG string")
    m = S.build_submeter_map(mi)
    got = sorted((r.BI_MTR_NBR, r.MainMeter) for r in m.collect())
    assert got == [(11, 10), (22, 20), (22, 21), (32, None)]
    checks = {(r.Check, r.Position): r.Count for r in S.submeter_map_checks(mi, m).collect()}
    assert checks[("without_main", None)] == 1 and checks[("mapped_more_than_once", None)] == 1
    readings = spark.createDataFrame([(10,), (11,), (22,), (42,)], "MeterNumber int")
    assert sorted(r.MeterNumber for r in S.exclude_submeters(readings, m).collect()) == [10, 42]


def test_peak_queries_on_peak_hours_equal_full_hourly(spark):
    from sf_dirs import SF_SMALL
    from voltframe.plans.pipeline import Pipeline
    p = Pipeline.of(spark, SF_SMALL)
    ipk = p.indexed_peaks

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)
    assert rows(P.peak_total(p.hourly_nosub_at_peaks, ipk)) == rows(P.peak_total(p.hourly_nosub, ipk))
    a = P.peak_by_lc_meter(p.hourly_at_peaks, ipk, p.fx.fx_load_types)
    b = P.peak_by_lc_meter(p.hourly, ipk, p.fx.fx_load_types)
    assert a.count() > 0 and rows(a) == rows(b.select(a.columns))
    assert rows(P.peak_dropouts(p.hourly_nosub_in_peak_clock_hours, ipk)) == rows(P.peak_dropouts(p.hourly_nosub, ipk))


def test_peak_hours_restriction_on_autumn_dst_day(spark):
    import datetime as dt
    from decimal import Decimal

    from voltframe.operators import hourly as H
    from voltframe.operators import readings as R
    rows = []
    start = dt.datetime(2024, 11, 3, 4, 0)
    for m in (1, 2):
        for i in range(12 * 6):
            s = start + dt.timedelta(minutes=5 * i)
            if m == 2 and i % 12 == 11:
                continue  # meter 2 misses the last interval of every hour
            rows.append((m, "KWH", "F", 1, s, s + dt.timedelta(minutes=5), Decimal("1.00"), Decimal("2.00")))
    ix = R.index_readings(spark.createDataFrame(rows, "MeterNumber int, UnitOfMeasure string, FlowDirection string, "
                                                "Channel int, StartDateTime timestamp, EndDateTime timestamp, "
                                                "AMIValue decimal(18,2), VEEValue decimal(18,2)"))
    pk = P.index_peaks(P.peak_parts(spark.createDataFrame(
        [(dt.datetime(2024, 11, 3, 1, 0),), (dt.datetime(2024, 11, 3, 3, 0),)], "CoincidTime timestamp")))
    assert pk.count() == 3  # 01:00 happens twice
    full = P.peak_total(H.hourly_usage(ix), pk).collect()
    part = P.peak_total(H.hourly_usage_in_hours(ix, H.hours_ending_at(ix, pk)), pk).collect()
    # 01:00 CDT (06:00 UTC) ends HourEnding 1 of meter 1 (12 readings); the
    # 01:00 CST instant (07:00 UTC) matches no group, because both local 01:xx
    # hours merge into HourEnding 2, which ends at 08:00 UTC; 03:00 CST ends
    # HourEnding 3 (12 readings). Meter 2 always misses its last interval.
    assert full == part and full[0].TotalCPHourlyAMIValue == Decimal("24.00")
