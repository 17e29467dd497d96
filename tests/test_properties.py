"""Property tests: random small reading sets against the brute-force rules."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from test_readings import SCHEMA, brute_force_clean
from voltframe.operators import changes as C
from voltframe.operators import readings as R

T0 = dt.datetime(2024, 1, 1, 6, 0)
vals = st.sampled_from([None, Decimal("0.00"), Decimal("1.50"), Decimal("2.00")])
row = st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([0, 1]), vals, vals)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=14))
def test_clean_matches_brute_force(spark, rows):
    full = [(m, "KWH", "F", 1, T0 + dt.timedelta(minutes=15 * s), T0 + dt.timedelta(minutes=15 * s + 15), a, v)
            for m, s, a, v in rows]
    got = sorted(map(tuple, R.clean_readings(spark.createDataFrame(full, SCHEMA)).collect()), key=repr)
    assert got == brute_force_clean(full)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=8),
       st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=8))
def test_upsert_idempotent_and_diff_consistent(spark, t_rows, s_rows):
    t = spark.createDataFrame(list(dict(t_rows).items()), "k int, v int")
    s = spark.createDataFrame(list(dict(s_rows).items()), "k int, v int")
    once = C.upsert(t, s, ["k"])
    twice = C.upsert(once, s, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    # applying the change rows' post-images to the target gives the upsert
    ch = C.upsert_changes(t, s, ["k"], 1)
    post = C.postimages(ch).select("k", "v")
    applied = C.upsert(t, post, ["k"])
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, once.collect()))


prog = st.sampled_from(["A", "B", "C"])
map_row = st.tuples(st.integers(1, 4), prog, st.sampled_from(["A", "B", "C", None]))
event = st.tuples(prog, st.integers(6, 9), st.integers(1, 2))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(map_row, min_size=1, max_size=8), st.lists(event, min_size=1, max_size=4))
def test_profile_fulfilment_matches_brute_force(spark, map_rows, events):
    from pyspark.sql import functions as F

    from voltframe.operators import loadcontrol as L
    ev = spark.createDataFrame([("1/5/2024", p, f"{h}:00", f"{h + d}:00") for p, h, d in events],
                               "Date string, Program string, StartTime string, StopTime string")
    pts = L.expand_lc_periods(L.index_lc_periods(ev), 0, 0)
    # map: programme name in BI_LOAD_TYPE's place is the join column
    mm = spark.createDataFrame([(m, m, m * 10, t, p) for m, p, t in map_rows],
                               "BI_ACCT int, BI_SRV_LOC_NBR int, BI_MTR_NBR int, BI_LOAD_TYPE string, Prog string")
    # the reference form: every point x every map row of its programme
    mts = pts.join(mm, pts.Program == mm.Prog)
    dups = mts.groupBy("MeterSampleIndex", "BI_MTR_NBR").agg(F.count("BI_LOAD_TYPE").alias("Count"))
    pc = mm.groupBy("BI_MTR_NBR").agg(F.count("BI_LOAD_TYPE").alias("ProgramCount"))
    diff = pc.join(dups, "BI_MTR_NBR").withColumn("ProgramDiff", F.col("ProgramCount") - F.col("Count"))
    want = sorted(tuple(r) for r in diff.filter("ProgramDiff = 0").groupBy("BI_MTR_NBR").agg(
        F.count(F.lit(1)), F.min("MeterSampleIndex"), F.max("MeterSampleIndex")).collect())
    got = sorted(tuple(r) for r in L.fulfilled_by_meter(pts, mm, program_col="Prog").select(
        "BI_MTR_NBR", "FulfilledPoints", "FirstIndex", "LastIndex").collect())
    assert got == want
    want_sf = sorted(tuple(r) for r in diff.groupBy("ProgramDiff").count().collect())
    got_sf = sorted(tuple(r) for r in L.shortfall_distribution(pts, mm, program_col="Prog").collect())
    assert got_sf == want_sf


on_grid = st.builds(lambda k, s: dt.datetime(2021, 1, 1) + dt.timedelta(minutes=5 * k, seconds=s),
                    st.integers(-20, 2103840 + 20), st.integers(0, 59))
any_time = st.datetimes(min_value=dt.datetime(2020, 12, 31, 20, 0), max_value=dt.datetime(2041, 1, 1, 4, 0))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(on_grid, any_time), min_size=1, max_size=200))
def test_serial_index_matches_python(spark, stamps):
    from pyspark.sql import functions as F

    from voltframe.functions.timeindex import serial_index

    def expected(t):
        t = t.replace(second=0, microsecond=0)
        secs = int(t.replace(tzinfo=dt.timezone.utc).timestamp()) - 1609459200
        idx = secs // 300 + 1
        return idx if t.minute % 5 == 0 and secs >= 0 and idx <= 2103840 else None
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp")
    got = [r[0] for r in df.select(serial_index(F.col("ts"))).collect()]
    assert got == [expected(t) for t in stamps]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 3)), max_size=8),
       st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 3)), max_size=8))
def test_batch_side_changes_equal_snapshot_diff(spark, target, source):
    t = spark.createDataFrame(list(target.items()), "k int, v int")
    s = spark.createDataFrame(list(source.items()), "k int, v int")
    after = C.upsert(t, s, ["k"])
    a = sorted(map(tuple, C.upsert_changes(t, s, ["k"], 1).collect()), key=repr)
    b = sorted(map(tuple, C.diff_changes(t, after, ["k"], 1).collect()), key=repr)
    assert a == b
