"""Benchmark: run every catalogue query over one scale factor and print one
JSON line with per-query seconds.

Each query is forced to full execution with the ``noop`` sink (no rows are
pulled to the driver). Environment: ``BENCH_SF_DIR`` (default
/root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_QUERIES``
(comma list, default all), ``BENCH_REPEAT`` (best of N, default 1).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    from voltframe.plans.catalog import QUERIES
    from voltframe.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"})
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)

    # warm-up: JVM class loading and the first parquet footer reads
    QUERIES["clean_readings"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # keep going; report the failure
                errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
                break
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        if best is not None:
            times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
              "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
              "n_queries": len(times), "cpus": cpus}
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
