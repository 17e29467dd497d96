"""Incremental maintenance vs full rebuild of the silver/hourly tables.

Splits the bronze fixture of ``BENCH_SF_DIR`` into ``BENCH_BATCHES`` files by
day, folds them one by one through ``SilverChain`` (upserts of touched day
partitions + touched-hour rebuilds), then rebuilds the same tables in one
batch job; checks both hourly tables agree and prints one JSON line with
the timings. Output goes to a fresh folder under ``BENCH_OUT`` or, by
default, under the session's checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import functions as F

    from voltframe.operators.submeters import build_submeter_map
    from voltframe.plans import jobs
    from voltframe.session import get_session
    from voltframe.sources.fixtures import Fixtures
    from voltframe.streaming.chain import SilverChain

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    n = int(os.environ.get("BENCH_BATCHES", "10"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    if os.environ.get("BENCH_OUT"):
        out = tempfile.mkdtemp(prefix="vf-inc-", dir=os.environ["BENCH_OUT"])
    else:  # a fresh folder under the session's (shared) checkpoint folder
        from voltframe.session import ensure_checkpoint_dir
        out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-incremental-{int(time.time())}"
    fx = Fixtures(spark, sf_dir)
    bronze = fx.fx_bronze
    smap = build_submeter_map(fx.fx_meter_info).cache()
    smap.count()

    days = 31
    chain = SilverChain(spark, f"{out}/chain", smap)
    per_batch = []
    t0 = time.perf_counter()
    for i in range(n):
        lo, hi = 1 + i * days // n, (i + 1) * days // n
        b = bronze.filter(F.dayofmonth("StartDateTime").between(lo, hi))
        t = time.perf_counter()
        chain.apply(b, i)
        per_batch.append(round(time.perf_counter() - t, 3))
    inc_total = time.perf_counter() - t0

    t0 = time.perf_counter()
    full = jobs.run_readings_job(spark, bronze, fx.fx_meter_info, f"{out}/full")
    full_total = time.perf_counter() - t0

    cols = full["hourly_nosub"].columns
    inc_h = chain.hourly_nosub.read().select(*cols)
    same = (inc_h.exceptAll(full["hourly_nosub"]).count() == 0
            and full["hourly_nosub"].exceptAll(inc_h).count() == 0)
    print(json.dumps({"metric": "incremental_vs_full", "unit": "sec", "sf_dir": sf_dir,
                      "batches": n, "incremental_total": round(inc_total, 3),
                      "incremental_per_batch": per_batch, "full_rebuild": round(full_total, 3),
                      "hourly_nosub_equal": same}))
    spark.stop()


if __name__ == "__main__":
    main()
