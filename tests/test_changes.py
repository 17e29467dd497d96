from pyspark.sql import functions as F

from voltframe.operators import changes as C

S = "k int, v int"


def test_upsert_null_keys_and_idempotence(spark):
    t = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], S)
    s = spark.createDataFrame([(2, 20), (3, 30), (None, 40)], S)
    once = C.upsert(t, s, ["k"])
    got = sorted((r.k if r.k is not None else -1, r.v) for r in once.collect())
    assert got == [(-1, 3), (-1, 40), (1, 1), (2, 20), (3, 30)]
    twice = C.upsert(C.upsert(t.filter("k IS NOT NULL"), s.filter("k IS NOT NULL"), ["k"]),
                     s.filter("k IS NOT NULL"), ["k"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.filter("k IS NOT NULL").collect()))


def test_diff_all_change_types(spark):
    before = spark.createDataFrame([(1, 1), (2, 2), (3, None)], S)
    after = spark.createDataFrame([(1, 1), (2, 5), (4, 4), (3, None)], S)
    d = C.diff_changes(spark.createDataFrame([(1, 1), (2, 2), (3, None), (5, 5)], S), after, ["k"], 7)
    got = sorted((r.k, r.v, r._change_type) for r in d.collect())
    assert got == [(2, 2, "update_preimage"), (2, 5, "update_postimage"), (4, 4, "insert"), (5, 5, "delete")]
    assert {r._commit_version for r in d.collect()} == {7}
    u = C.upsert_changes(before, spark.createDataFrame([(2, 5), (4, 4), (3, None)], S), ["k"], 2)
    assert sorted((r.k, r._change_type) for r in u.collect()) == [
        (2, "update_postimage"), (2, "update_preimage"), (4, "insert")]


def test_postimages_history_latest(spark):
    log = spark.createDataFrame([
        (1, 1, "insert", 1), (1, 1, "update_preimage", 2), (1, 2, "update_postimage", 2),
        (1, 3, "update_postimage", 3), (2, 2, "delete", 3)], "k int, v int, _change_type string, _commit_version long")
    post = C.postimages(log)
    assert post.count() == 3
    latest = C.latest_per_key(post, ["k"]).collect()
    assert [(r.k, r.v, r._commit_version) for r in latest] == [(1, 3, 3)]
    assert C.high_water(log).first().HighWaterVersion == 3
    assert C.changes_since(log, 2).count() == 2
    h = {(r._commit_version, r._change_type): r["count"] for r in C.change_history(log).collect()}
    assert h[(2, "update_preimage")] == 1


def test_reaggregation_scope_whole_hours(spark):
    up = spark.createDataFrame([(1, 10, 1), (1, 10, 2), (1, 11, 5), (2, 10, 7)], "m int, h int, v int")
    ch = spark.createDataFrame([(1, 10, 2)], "m int, h int, v int")
    scope = C.reaggregation_scope(up, ch, ["m", "h"], lambda df: df)
    assert sorted(r.v for r in scope.collect()) == [1, 2]
    assert scope.groupBy("m", "h").agg(F.sum("v")).first()[2] == 3


def test_reference_scope_equals_touched_hours(spark):
    from sf_dirs import SF_SMALL
    from voltframe.operators import hourly as H
    from voltframe.operators import readings as R
    from voltframe.plans.incremental import rebuild_hours
    from voltframe.plans.pipeline import Pipeline
    p = Pipeline(spark, SF_SMALL)
    up = R.index_readings(p.upserted)
    ch = R.index_readings(p.batch2)
    scoped = rebuild_hours(up, ch)
    ref = H.hourly_usage(C.reference_scope(up, ch))
    touched = C.affected_hours(ch, H.HOURLY_KEY, lambda d: H.with_local_parts(d))
    ref_touched = ref.join(touched, H.HOURLY_KEY, "left_semi")
    assert sorted(map(tuple, scoped.collect())) == sorted(map(tuple, ref_touched.select(scoped.columns).collect()))
    assert ref.count() >= scoped.count()


def test_read_changes_and_volume_checks(spark):
    from sf_dirs import SF_SMALL
    from voltframe.operators.diagnostics import volume_checks
    from voltframe.plans.pipeline import Pipeline
    log = Pipeline.of(spark, SF_SMALL).change_log
    since = C.read_changes(log, 1)
    assert {r[0] for r in since.select("_commit_version").distinct().collect()} <= {2, 3}
    assert since.count() == log.filter("_commit_version > 1").count() > 0
    checks = volume_checks(Pipeline.of(spark, SF_SMALL).fx.fx_bronze16)
    assert set(checks) == {"daily_counts", "substation_daily_counts", "duplicate_timestamps"}
    assert checks["daily_counts"].count() > 0


def test_change_log_deals_each_batch_once(spark, monkeypatch):
    """Both batches lie in partitions that follow their rows; merge and change
    rows add no exchange by key that depends on the session's sizes."""
    from sf_dirs import SF_SMALL
    from voltframe.plans.explain import plan_text
    from voltframe.plans.pipeline import Pipeline
    p = Pipeline(spark, SF_SMALL)
    monkeypatch.setattr(p.fx, "parts", lambda name, rows_each=0: 7)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = [ln for ln in plan_text(C.high_water(p.change_log)).splitlines() if "Exchange hashpartitioning" in ln]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_reading = [ln for ln in lines if "EndDateTime" in ln]
    assert by_reading and all(", 7)" in ln for ln in by_reading)


def test_partitions_follow_the_rows(spark, tmpdir_path):
    from voltframe.sources.fixtures import Fixtures
    spark.range(1000).write.parquet(f"{tmpdir_path}/events.parquet")
    fx = Fixtures(spark, tmpdir_path)
    assert fx.parts("events", 10) == 100
    assert fx.parts("events", 10**6) == spark.sparkContext.defaultParallelism


def test_slots_are_grouped_in_partitions_that_follow_the_events(spark, tmpdir_path, monkeypatch):
    """Same rows as the SQL text; no task groups a whole file split."""
    from voltframe.plans.explain import plan_text
    from voltframe.sources.fixtures import FIXTURES, Fixtures
    rows = [(i, None if i % 13 == 0 else f"2024-01-0{1 + i % 3} 0{i % 5}:{i % 4 * 14 + 3}:10", None if i % 11 == 0 else i % 6,
             None if i % 17 == 0 else ("error", "view")[i % 2], None if i % 7 == 0 else i / 8) for i in range(400)] * 2
    (spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
     .withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmpdir_path}/events.parquet"))
    fx = Fixtures(spark, tmpdir_path)
    monkeypatch.setattr(fx, "parts", lambda name, rows_each=0: 7)
    want = spark.sql(FIXTURES["fx_slots"][1], events=fx.events)
    assert fx.fx_slots.schema == want.schema
    assert (sorted(map(tuple, fx.fx_slots.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr))
    lines = plan_text(fx.fx_slots).splitlines()
    deal = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert len(deal) == 1 and ", 7)" in lines[deal[0]]
    assert not any("Aggregate" in ln for ln in lines[deal[0]:])  # below it


def test_usage_quantiles_sums_hours_in_partitions_that_follow_the_rows(spark, monkeypatch):
    from sf_dirs import SF_SMALL
    from voltframe.operators import hourly as H
    from voltframe.operators import readings as R
    from voltframe.plans.explain import plan_text
    from voltframe.plans.pipeline import Pipeline
    from voltframe.plans.catalog import QUERIES
    p = Pipeline(spark, SF_SMALL)
    monkeypatch.setattr(p.fx, "parts", lambda name, rows_each=0: 7)
    monkeypatch.setattr(Pipeline, "of", classmethod(lambda cls, spark, sf_dir: p))
    by_hour = [ln for ln in plan_text(QUERIES["usage_quantiles"](spark, SF_SMALL)).splitlines()
               if "Exchange hashpartitioning(MeterNumber" in ln and "HourEnding" in ln]
    assert by_hour and all(", 7)" in ln for ln in by_hour)
    indexed = R.index_readings(p.batch1)
    dealt, summed = H.hourly_usage(indexed, parts=7), H.hourly_usage(indexed)
    assert dealt.schema == summed.schema and dealt.exceptAll(summed).count() == summed.exceptAll(dealt).count() == 0
