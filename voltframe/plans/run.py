"""Command-line runner for the batch jobs over landing files.

    python -m voltframe.plans.run readings --bronze DIR --meter-info CSV --out DIR
    python -m voltframe.plans.run loadcontrol --events 'DIR/*.csv' --program-map CSV --indexed DIR --out DIR
    python -m voltframe.plans.run peaks --sheets DIR --hourly DIR --hourly-nosub DIR \
        --load-types CSV --rates CSV --out DIR
    python -m voltframe.plans.run calendar --first-year 2021 --last-year 2040 --out DIR
    python -m voltframe.plans.run chain --bronze DIR --root DIR --checkpoint DIR [--meter-info CSV]
        [--lc-events 'DIR/*.csv' --program-map CSV [--program-col NAME]]
    python -m voltframe.plans.run gold --chain-root DIR --out DIR
    python -m voltframe.plans.run ingest --landing DIR --bronze DIR --checkpoint DIR

``--bronze`` may be a parquet folder (written by ``ingest``) or a folder of
reading extracts (CSV / CSV.gz). Checkpoints go to the shared folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession


def _read_bronze(spark: SparkSession, path: str) -> DataFrame:
    from voltframe.sources.landing import read_readings_batch
    # Spark lists the files, so any file system that the cluster mounts works
    has_parquet = bool(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                       .option("recursiveFileLookup", True).load(path).inputFiles())
    return spark.read.parquet(path) if has_parquet else read_readings_batch(spark, path)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="voltframe.plans.run")
    sub = ap.add_subparsers(dest="job", required=True)
    r = sub.add_parser("readings")
    r.add_argument("--bronze", required=True)
    r.add_argument("--meter-info", required=True)
    r.add_argument("--out", required=True)
    lc = sub.add_parser("loadcontrol")
    lc.add_argument("--events", required=True)
    lc.add_argument("--program-map", required=True)
    lc.add_argument("--program-col", default="BI_LOAD_TYPE")
    lc.add_argument("--indexed", required=True)
    lc.add_argument("--out", required=True)
    pk = sub.add_parser("peaks")
    for a in ("--sheets", "--hourly", "--hourly-nosub", "--load-types", "--rates", "--out"):
        pk.add_argument(a, required=True)
    cal = sub.add_parser("calendar")
    cal.add_argument("--first-year", type=int, default=2021)
    cal.add_argument("--last-year", type=int, default=2040)
    cal.add_argument("--out", required=True)
    ch = sub.add_parser("chain")
    for a in ("--bronze", "--root", "--checkpoint"):
        ch.add_argument(a, required=True)
    ch.add_argument("--meter-info")
    ch.add_argument("--lc-events")
    ch.add_argument("--program-map")
    ch.add_argument("--program-col", default="BI_LOAD_TYPE")
    gd = sub.add_parser("gold")
    gd.add_argument("--chain-root", required=True)
    gd.add_argument("--out", required=True)
    ing = sub.add_parser("ingest")
    for a in ("--landing", "--bronze", "--checkpoint"):
        ing.add_argument(a, required=True)
    args = ap.parse_args(argv)

    from voltframe.plans import jobs
    from voltframe.session import get_session, size_for
    from voltframe.sources import landing as LD
    spark = get_session()
    inputs = {"readings": ["bronze"], "loadcontrol": ["indexed"], "peaks": ["hourly", "hourly_nosub"],
              "chain": ["bronze"], "gold": ["chain_root"], "ingest": ["landing"]}
    size_for(spark, *[getattr(args, name) for name in inputs.get(args.job, [])])

    if args.job == "readings":
        jobs.run_readings_job(spark, _read_bronze(spark, args.bronze),
                              LD.read_dim_csv(spark, args.meter_info), args.out)
    elif args.job == "loadcontrol":
        jobs.run_load_control_job(spark, LD.read_lc_events(spark, args.events),
                                  LD.read_dim_csv(spark, args.program_map),
                                  spark.read.parquet(args.indexed), args.out, args.program_col)
    elif args.job == "peaks":
        jobs.run_peak_job(spark, LD.read_sheet_cells(spark, args.sheets), spark.read.parquet(args.hourly),
                          spark.read.parquet(args.hourly_nosub), LD.read_dim_csv(spark, args.load_types),
                          LD.read_demand_rates(spark, args.rates), args.out)
    elif args.job == "calendar":
        from voltframe.operators.calendar import build_calendar
        from voltframe.sources.tables import write_table
        write_table(build_calendar(spark, args.first_year, args.last_year), args.out)
    elif args.job == "chain":
        from voltframe.operators.submeters import build_submeter_map
        from voltframe.streaming.chain import SilverChain
        smap = build_submeter_map(LD.read_dim_csv(spark, args.meter_info)) if args.meter_info else None
        points = pmap = None
        if args.lc_events and args.program_map:
            from voltframe.operators.loadcontrol import expand_lc_periods, index_lc_periods
            points = expand_lc_periods(index_lc_periods(LD.read_lc_events(spark, args.lc_events))).cache()
            pmap = LD.read_dim_csv(spark, args.program_map)
        SilverChain(spark, args.root, smap, lc_points=points, program_map=pmap,
                    program_col=args.program_col).run(args.bronze, args.checkpoint)
    elif args.job == "gold":
        from voltframe.sources.tables import DayTable
        hourly_nosub = DayTable(spark, f"{args.chain_root.rstrip('/')}/hourly_nosub").read().drop("day")
        jobs.refresh_usage_gold(spark, hourly_nosub, args.out)
    elif args.job == "ingest":
        from voltframe.streaming.ingest import ingest_available
        print(ingest_available(spark, args.landing, args.bronze, args.checkpoint))


if __name__ == "__main__":
    main()
