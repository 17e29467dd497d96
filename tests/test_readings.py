import datetime as dt
import itertools
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F

from voltframe.functions.timeindex import index_to_local, index_to_utc, serial_index
from voltframe.operators import readings as R

T0 = dt.datetime(2024, 3, 1, 6, 0)
SCHEMA = ("MeterNumber int, UnitOfMeasure string, FlowDirection string, Channel int, "
          "StartDateTime timestamp, EndDateTime timestamp, AMIValue decimal(18,2), VEEValue decimal(18,2)")


def brute_force_clean(rows):
    """The reference rules written row by row: exact dedupe, count per key
    (null keys never match), then the three pair filters in SQL logic."""
    rows = list(dict.fromkeys(rows))
    counts = {}
    for r in rows:
        if all(v is not None for v in r[:6]):
            counts[r[:6]] = counts.get(r[:6], 0) + 1

    def sql_not(x):
        return None if x is None else (not x)

    def sql_and(*xs):
        if any(x is False for x in xs):
            return False
        if any(x is None for x in xs):
            return None
        return True

    def eq(a, b):
        return None if a is None else a == b

    out = []
    for r in rows:
        n = counts.get(r[:6], 1) if all(v is not None for v in r[:6]) else 1
        ami, vee = r[6], r[7]
        f1 = sql_not(sql_and(vee is None, n == 2))
        f2 = sql_not(sql_and(eq(vee, 0), eq(ami, 0), n == 2))
        f3 = sql_not(sql_and(eq(ami, 0), n == 2))
        if f1 is True and f2 is True and f3 is True:
            out.append(r)
    return sorted(out, key=repr)


def test_pair_truth_table(spark):
    vals = [None, Decimal("0.00"), Decimal("5.00")]
    rows = []
    meter = 1
    # key counts 1, 2, 3 x every AMI/VEE combination in the group
    for a1, v1 in itertools.product(vals, vals):
        rows.append((meter, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15), a1, v1))
        meter += 1
    combos = list(itertools.product(vals, vals))
    for (a1, v1), (a2, v2) in itertools.combinations(combos, 2):
        rows.append((meter, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15), a1, v1))
        rows.append((meter, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15), a2, v2))
        meter += 1
    for trio in list(itertools.combinations(combos, 3))[:20]:
        for a, v in trio:
            rows.append((meter, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15), a, v))
        meter += 1
    # exact copies, and null key columns (never grouped)
    rows.append(rows[0])
    for a, v in [(Decimal("0.00"), None), (Decimal("5.00"), None)]:
        rows.append((None, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15), a, v))
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted([tuple(r) for r in R.clean_readings(df).collect()], key=repr)
    assert got == brute_force_clean(rows)


def test_max_policy(spark):
    rows = [(1, "KWH", "F", 1, T0, T0, Decimal("1.00"), Decimal("2.00")),
            (1, "KWH", "F", 1, T0, T0, Decimal("3.00"), None)]
    out = R.clean_readings(spark.createDataFrame(rows, SCHEMA), policy="max").collect()
    assert len(out) == 1 and out[0].AMIValue == Decimal("3.00") and out[0].VEEValue == Decimal("2.00")


def test_serial_index_edges(spark):
    cases = [
        (dt.datetime(2021, 1, 1, 0, 0), 1),
        (dt.datetime(2021, 1, 1, 0, 5), 2),
        (dt.datetime(2021, 1, 1, 0, 5, 37), 2),       # seconds ignored
        (dt.datetime(2021, 1, 1, 0, 3), None),        # off grid
        (dt.datetime(2020, 12, 31, 23, 55), None),    # before the calendar
        (dt.datetime(2040, 12, 31, 23, 55), 2103840),  # last slot
        (dt.datetime(2041, 1, 1, 0, 0), None),        # after the calendar
        (dt.datetime(2024, 7, 13, 20, 0), 371473),
    ]
    df = spark.createDataFrame([Row(ts=c[0]) for c in cases])
    got = [r[0] for r in df.select(serial_index("ts")).collect()]
    assert got == [c[1] for c in cases]
    r = spark.range(1).select(index_to_utc(F.lit(371473)).alias("u"),
                              index_to_local(F.lit(371473)).alias("l")).first()
    assert r.u == dt.datetime(2024, 7, 13, 20, 0) and r.l == dt.datetime(2024, 7, 13, 15, 0)


def test_calendar_join_equals_arithmetic(spark):
    from voltframe.operators.calendar import calendar_for_days
    days = spark.createDataFrame([(dt.date(2024, 3, 10),), (dt.date(2024, 11, 3),)], "Date date")
    cal = calendar_for_days(days)
    readings = spark.createDataFrame(
        [(dt.datetime(2024, 3, 10, 7, 45),), (dt.datetime(2024, 11, 3, 6, 0),), (dt.datetime(2024, 11, 3, 6, 3),)],
        "ts timestamp")
    joined = readings.join(cal, (F.year("ts") == cal.UTCYear) & (F.month("ts") == cal.UTCMonth)
                           & (F.dayofmonth("ts") == cal.UTCDay) & (F.hour("ts") == cal.UTCHour)
                           & (F.minute("ts") == cal.UTCMinute), "left")
    rows = joined.select(serial_index("ts").alias("a"), "MeterSampleIndex").collect()
    assert all(r.a == r.MeterSampleIndex for r in rows)
    assert cal.count() == 2 * 288


def test_index_and_null_rows(spark):
    rows = [(1, "KWH", "F", 1, dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 15),
             Decimal("1.00"), Decimal("1.00")),
            (1, "KWH", "F", 1, dt.datetime(2024, 1, 1, 0, 1), dt.datetime(2024, 1, 1, 0, 16),
             Decimal("1.00"), Decimal("1.00"))]
    ix = R.index_readings(spark.createDataFrame(rows, SCHEMA))
    got = {r.StartDateTime.minute: (r.SampleRate, r.StartMeterSampleIndex) for r in ix.collect()}
    assert got[0][0] == 15 and got[1] == (None, None)
    assert R.null_index_rows(ix).count() == 1


def test_delete_where_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    assert sorted(r.a for r in R.delete_where(df, F.col("b") > 3).collect()) == [1]


def test_pair_survivors_are_paired_correctly(spark):
    k = (1, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15))
    rows = [k + (Decimal("2.00"), Decimal("9.00")), k + (Decimal("7.00"), Decimal("1.00"))]   # different AMI
    k2 = (2, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15))
    rows += [k2 + (Decimal("3.00"), Decimal("8.00")), k2 + (Decimal("3.00"), Decimal("4.00"))]  # same AMI
    k3 = (3, "KWH", "F", 1, T0, T0 + dt.timedelta(minutes=15))
    rows += [k3 + (Decimal("6.00"), Decimal("5.00")), k3 + (Decimal("0.00"), Decimal("1.00"))]  # one survivor
    got = sorted(map(tuple, R.clean_readings(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == brute_force_clean(rows) and len(got) == 5


def test_pair_aggregation_is_hash_based(spark):
    from test_plans import _plan
    rows = [(1, "KWH", "F", 1, T0, T0, Decimal("1.00"), Decimal("1.00"))]
    plan = _plan(R.clean_readings(spark.createDataFrame(rows, SCHEMA)))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_duplicate_rows_lists_keys_with_a_null(spark):
    """A left join from the duplicated keys: the null key is listed, unmatched."""
    t1, rows = T0 + dt.timedelta(minutes=15), []
    for channel in (1, None):
        rows += [(7, "KWH", "F", channel, T0, t1, Decimal(v), Decimal(v)) for v in (1, 2)]
    rows += [(8, "KWH", "F", 1, T0, t1, Decimal(1), Decimal(1))]
    got = R.duplicate_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.Channel is None, r["count"], r.AMIValue) for r in got if r.Channel) == [
        (False, 2, Decimal(1)), (False, 2, Decimal(2))]
    assert [(r["count"], r.AMIValue) for r in got if r.Channel is None] == [(2, None)]


def test_dealt_readings_follow_the_same_rules(spark):
    k = lambda m, c=1: (m, "KWH", "F", c, T0, T0 + dt.timedelta(minutes=15))
    d = Decimal
    rows = [k(1) + (d("2.00"), d("9.00")), k(1) + (d("7.00"), d("1.00")),            # both survive
            k(2) + (d("3.00"), d("8.00")), k(2) + (d("0.00"), d("8.00")),            # 0 AMI goes
            k(3) + (d("3.00"), None), k(3) + (d("3.00"), d("3.00")),                 # null VEE goes
            k(4) + (None, d("3.00")), k(4) + (d("4.00"), d("3.00")),                 # null AMI in a pair
            k(5) + (d("0.00"), None)] * 2                                            # alone, with a copy
    rows += [k(6) + (d(i), d("0.00")) for i in range(3)]                             # three pass as they are
    rows += [k(7, None) + (d("0.00"), d("1.00")), k(7, None) + (d("1.00"), d("1.00"))]  # null in the key
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, R.clean_readings(df, parts=5).collect()), key=repr)
    assert got == brute_force_clean(rows)
    assert got == sorted(map(tuple, R.clean_readings(df).collect()), key=repr)
