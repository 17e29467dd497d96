import os

from pyspark.sql import functions as F

from voltframe.operators import hourly as H
from voltframe.operators import readings as R
from voltframe.operators.submeters import exclude_submeters
from voltframe.streaming.chain import SilverChain
from voltframe.streaming.ingest import ingest_available

from test_sources import line, write_extract


def test_ingest_exactly_once_across_restarts(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    bronze = os.path.join(tmpdir_path, "bronze")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    write_extract(landing, "f1", [line(1), line(2)], gz=True)
    ingest_available(spark, landing, bronze, ckpt)
    assert spark.read.parquet(bronze).count() == 2
    write_extract(landing, "f2", [line(3), line("bad")])
    ingest_available(spark, landing, bronze, ckpt)       # restart: only the new file
    ingest_available(spark, landing, bronze, ckpt)       # nothing new
    df = spark.read.parquet(bronze)
    assert df.count() == 4
    assert df.filter(F.col("_rescued_data").isNotNull()).count() == 1


def _bronze_days(fx_bronze, lo, hi):
    d = F.dayofmonth("StartDateTime")
    return fx_bronze.filter((d >= lo) & (d <= hi))


def test_incremental_chain_equals_full_rebuild(spark, tmpdir_path):
    from voltframe.sources.fixtures import Fixtures
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    bronze = fx.fx_bronze
    smap_df = fx.fx_meter_info
    from voltframe.operators.submeters import build_submeter_map
    smap = build_submeter_map(smap_df).cache()
    chain = SilverChain(spark, os.path.join(tmpdir_path, "silver"), smap)
    # three files arriving out of order, the last one overlapping the first
    batches = [_bronze_days(bronze, 11, 20), _bronze_days(bronze, 1, 12), _bronze_days(bronze, 18, 31)]
    for i, b in enumerate(batches):
        chain.apply(b, i)
    chain.apply(batches[0], 0)  # a replayed batch id is skipped
    # full rebuild over the final indexed table
    final_ix = chain.indexed.read().drop("day")
    full = H.hourly_usage(final_ix)
    inc = chain.hourly.read().drop("day")
    cols = full.columns
    assert sorted(map(tuple, inc.select(cols).collect())) == sorted(map(tuple, full.collect()))
    full_ns = H.hourly_usage(exclude_submeters(final_ix, smap))
    inc_ns = chain.hourly_nosub.read().drop("day")
    assert sorted(map(tuple, inc_ns.select(cols).collect())) == sorted(map(tuple, full_ns.collect()))
    # the cleaned table is unique on the reading key
    assert R.duplicate_keys(chain.cleaned.read()).count() == 0
    # every key's rows share one start day, so day batches resolve pairs as a
    # full run does: the silver tables equal one full batch run
    full_clean = R.clean_readings(bronze)
    full_ix = R.index_readings(full_clean)
    for table, want in ((chain.cleaned, full_clean), (chain.indexed, full_ix),
                        (chain.nosub, exclude_submeters(full_ix, smap))):
        got = table.read().drop("day")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert chain.progress().filter('step = 2').count() == 3
    # the change log: batch 1 inserts everything, later batches insert new
    # keys and update overlapping ones (pre- and post-images pair up)
    log = chain.change_log()
    hist = {(r._commit_version, r._change_type): r["count"] for r in
            log.groupBy("_commit_version", "_change_type").count().collect()}
    assert set(t for _, t in hist) <= {"insert", "update_preimage", "update_postimage"}
    assert hist.get((1, "update_preimage"), 0) == 0
    for v in (2, 3):
        assert hist.get((v, "update_preimage"), 0) == hist.get((v, "update_postimage"), 0)
    from voltframe.operators.changes import changes_since_time, latest_per_key, postimages
    t2 = log.filter("_commit_version = 2").agg(F.min("_commit_timestamp")).first()[0]
    assert changes_since_time(log, t2).filter("_commit_version = 1").count() == 0
    latest = latest_per_key(postimages(log).drop("_change_type", "_commit_timestamp"), R.READING_KEY + ["day"])
    assert latest.count() == chain.cleaned.read().count()


def test_replayed_batch_after_partial_failure_is_exact(spark, tmpdir_path):
    from voltframe.sources.fixtures import Fixtures
    fx = Fixtures.of(spark, "/root/testdata/sf0.001")
    b0 = _bronze_days(fx.fx_bronze, 1, 10)
    b1 = _bronze_days(fx.fx_bronze, 8, 20)
    ref = SilverChain(spark, os.path.join(tmpdir_path, "ref"))
    ref.apply(b0, 0)
    ref.apply(b1, 1)

    chain = SilverChain(spark, os.path.join(tmpdir_path, "crash"))
    chain.apply(b0, 0)
    original = chain.hourly.merged

    def crash(*a, **k):
        raise RuntimeError("executor lost")
    chain.hourly.merged = crash
    try:
        chain.apply(b1, 1)  # cleaned + indexed of version 2 are staged, then the batch dies
    except RuntimeError:
        pass
    assert not chain.applied(1)
    chain.hourly.merged = original
    chain.apply(b1, 1)      # replay
    for t in ("cleaned", "indexed", "hourly"):
        a = getattr(chain, t).read()
        b = getattr(ref, t).read()
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect())), t
    la = chain.change_log().filter("_commit_version = 2")
    lb = ref.change_log().filter("_commit_version = 2")
    assert la.count() == lb.count() > 0


def test_change_log_stream_consumer(spark, tmpdir_path):
    from voltframe.sources.fixtures import Fixtures
    from voltframe.streaming.changes import consume_changes
    fx = Fixtures.of(spark, "/root/testdata/sf0.001")
    chain = SilverChain(spark, os.path.join(tmpdir_path, "c"), gates=False)
    chain.apply(_bronze_days(fx.fx_bronze, 1, 10), 0)
    seen = []
    log = os.path.join(tmpdir_path, "c", "cleaned_changes")
    ck = os.path.join(tmpdir_path, "consumer_ck")
    consume_changes(spark, log, ck, lambda df, bid: seen.append(df.count()))
    chain.apply(_bronze_days(fx.fx_bronze, 11, 20), 1)
    consume_changes(spark, log, ck, lambda df, bid: seen.append(df.count()))
    consume_changes(spark, log, ck, lambda df, bid: seen.append(df.count()))  # nothing new
    total = chain.change_log().filter("_change_type <> 'update_preimage'").count()
    assert sum(seen) == total and len([s for s in seen if s]) == 2


def test_chain_load_control_equals_full(spark, tmpdir_path):
    from pyspark.sql import functions as F
    from voltframe.operators.loadcontrol import load_control_analysis
    from voltframe.plans.pipeline import Pipeline
    p = Pipeline.of(spark, "/root/testdata/sf0.001")
    bronze = p.fx.fx_bronze
    chain = SilverChain(spark, os.path.join(tmpdir_path, "lc"), gates=False,
                        lc_points=p.lc_points, program_map=p.fx.fx_load_types)
    # readings arrive out of order and split inside hours: the first and
    # second halves of an hour come in different batches
    first_half = F.minute("StartDateTime") < 30
    even_day = F.dayofmonth("StartDateTime") % 2 == 0
    parts = [bronze.filter(first_half & even_day), bronze.filter(~first_half),
             bronze.filter(first_half & ~even_day)]
    for i, b in enumerate(parts):
        chain.apply(b, i)
    full = load_control_analysis(p.lc_points, p.fx.fx_load_types, chain.indexed.read().drop("day"))
    inc = chain.lc_analysis.read().drop("local_date")
    assert inc.count() > 0
    assert sorted(map(tuple, inc.select(full.columns).collect())) == sorted(map(tuple, full.collect()))


def test_chain_run_in_bounded_batches(spark, tmpdir_path):
    from voltframe.sources.fixtures import Fixtures
    fx = Fixtures.of(spark, "/root/testdata/sf0.001")
    bronze = os.path.join(tmpdir_path, "bronze")
    for lo, hi in ((1, 10), (11, 20), (21, 31)):   # three bronze files
        _bronze_days(fx.fx_bronze, lo, hi).coalesce(1).write.mode("append").parquet(bronze)
    chain = SilverChain(spark, os.path.join(tmpdir_path, "c"), gates=False)
    chain.run(bronze, os.path.join(tmpdir_path, "ck"), max_files_per_trigger=1)
    assert len(chain.metrics) == 3
    full = H.hourly_usage(R.index_readings(R.clean_readings(fx.fx_bronze)))
    got = chain.hourly.read().drop("day")
    assert sorted(map(tuple, got.select(full.columns).collect())) == sorted(map(tuple, full.collect()))


def test_a_batch_rewrites_touched_partitions_only(spark, tmpdir_path):
    from glob import glob

    from voltframe.sources.fixtures import Fixtures
    fx = Fixtures.of(spark, "/root/testdata/sf0.001")
    chain = SilverChain(spark, os.path.join(tmpdir_path, "c"), gates=False)
    chain.apply(_bronze_days(fx.fx_bronze, 1, 3), 0)
    files = lambda: set(glob(os.path.join(tmpdir_path, "c", "cleaned", "day=*", "*.parquet")))
    first = files()
    chain.apply(_bronze_days(fx.fx_bronze, 3, 4), 1)
    day = lambda f: f.split("day=")[1][:10]
    assert {day(f) for f in first - files()} == {"2024-01-03"}
    assert {day(f) for f in files() - first} == {"2024-01-03", "2024-01-04"}


def test_a_batch_that_died_while_put_in_place(spark, tmpdir_path):
    """Some tables are replaced, others not: the staged partitions are put in
    place again, with the change rows of the first attempt."""
    from voltframe.sources.fixtures import Fixtures
    fx = Fixtures.of(spark, "/root/testdata/sf0.001")
    chains = [SilverChain(spark, os.path.join(tmpdir_path, n), gates=False) for n in ("whole", "died")]
    for c in chains:
        c.apply(_bronze_days(fx.fx_bronze, 1, 10), 0)
    chains[0].apply(_bronze_days(fx.fx_bronze, 8, 20), 1)
    replace = chains[1].hourly.replace

    def crash(content):
        raise RuntimeError("driver lost")
    chains[1].hourly.replace = crash
    try:
        chains[1].apply(_bronze_days(fx.fx_bronze, 8, 20), 1)
    except RuntimeError:
        pass
    chains[1].hourly.replace = replace
    assert not chains[1].applied(1)
    chains[1].apply(_bronze_days(fx.fx_bronze, 8, 20), 1)
    chains[1].apply(_bronze_days(fx.fx_bronze, 8, 20), 1)  # and once more, in vain
    for table in ("cleaned", "indexed", "hourly"):
        a, b = (getattr(c, table).read() for c in chains)
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(a.columns).collect()), key=repr)
    logs = [c.change_log().groupBy("_commit_version", "_change_type").count().collect() for c in chains]
    assert sorted(logs[0]) == sorted(logs[1])


def test_a_new_checkpoint_skips_no_batch(spark, tmpdir_path):
    from voltframe.sources.fixtures import Fixtures
    fx = Fixtures.of(spark, "/root/testdata/sf0.001")
    at = lambda *p: os.path.join(tmpdir_path, *p)
    for k, (lo, hi) in enumerate(((1, 5), (6, 10))):
        _bronze_days(fx.fx_bronze, lo, hi).write.parquet(at(f"bronze{k}"))
    chain = SilverChain(spark, at("c"), gates=False)
    chain.run(at("bronze0"), at("ck0"))
    first = chain.cleaned.read().count()
    chain.run(at("bronze0"), at("ck0"))  # nothing new
    assert chain.cleaned.read().count() == first > 0
    chain.run(at("bronze1"), at("ck1"))  # batch ids start again at 0
    days = {r[0] for r in chain.cleaned.read().select(F.dayofmonth("StartDateTime")).distinct().collect()}
    assert days >= set(range(2, 10))
    assert chain.cleaned.read().count() == R.clean_readings(R.drop_header_rows(_bronze_days(fx.fx_bronze, 1, 10))).count()


def test_replayed_batch_reaches_consumers_once(spark, tmpdir_path):
    from voltframe.sources.fixtures import Fixtures
    from voltframe.streaming.changes import consume_changes
    fx = Fixtures.of(spark, "/root/testdata/sf0.001")
    chain = SilverChain(spark, os.path.join(tmpdir_path, "c"), gates=False)
    batch, merged, seen = _bronze_days(fx.fx_bronze, 1, 5), chain.hourly.merged, []
    log, ck = os.path.join(tmpdir_path, "c", "cleaned_changes"), os.path.join(tmpdir_path, "ck")

    def crash(*a, **k):
        raise RuntimeError("executor lost")
    chain.hourly.merged = crash
    try:
        chain.apply(batch, 0)
    except RuntimeError:
        pass
    assert not os.path.exists(log)  # consumers see nothing of a batch that died
    chain.hourly.merged = merged
    chain.apply(batch, 0)
    consume_changes(spark, log, ck, lambda df, bid: seen.append(df.count()))
    assert sum(seen) == chain.change_log().count() > 0


def test_zone_off_the_whole_hour_is_refused(spark, tmpdir_path):
    import pytest
    with pytest.raises(ValueError, match="whole hours"):
        SilverChain(spark, tmpdir_path, tz="Asia/Kolkata")


def test_local_parts_need_a_utc_session(spark):
    import pytest
    from voltframe.functions.timeindex import index_to_local
    df = spark.range(1).select(F.hour(index_to_local(F.lit(1))).alias("h"))
    assert df.first().h == 18
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        with pytest.raises(Exception, match="must be UTC"):
            spark.range(1).select(F.hour(index_to_local(F.lit(1))).alias("h")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_upsert_with_a_new_column(spark, tmpdir_path):
    from voltframe.sources.tables import DayTable
    t = DayTable(spark, os.path.join(tmpdir_path, "t"))
    t.upsert(spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], "k int, x string, day string"), ["k"])
    t.upsert(spark.createDataFrame([(1, 5, "d1"), (3, 6, "d1")], "k int, y int, day string"), ["k"])
    got = {r.k: (r.x, r.y) for r in t.read().collect()}
    assert got == {1: (None, 5), 2: ("b", None), 3: (None, 6)}
