import os

from test_sources import line, write_extract
from voltframe.plans.run import main


def test_cli_jobs_end_to_end(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    lines = [line(10, f"2024-01-05T{h:02d}:{m:02d}:00.000Z", f"2024-01-05T{h:02d}:{m + 15:02d}:00.000Z")
             for h in range(10, 14) for m in (0, 15, 30)]
    lines += [line(11, "2024-01-05T12:00:00.000Z", "2024-01-05T12:15:00.000Z")]
    write_extract(landing, "x", lines, gz=True)
    mi = os.path.join(tmpdir_path, "meters.csv")
    with open(mi, "w") as f:
        f.write("BI_ACCT,BI_MTR_NBR,BI_MTR_POS_NBR,BI_MTR_CONFIG\n1,10,1,M\n1,11,2,S\n")
    bronze = os.path.join(tmpdir_path, "bronze")
    main(["ingest", "--landing", landing, "--bronze", bronze, "--checkpoint", os.path.join(tmpdir_path, "ck")])
    out = os.path.join(tmpdir_path, "silver")
    main(["readings", "--bronze", bronze, "--meter-info", mi, "--out", out])
    hourly = spark.read.parquet(os.path.join(out, "hourly_nosub"))
    assert {r.MeterNumber for r in hourly.collect()} == {10}
    assert spark.read.parquet(os.path.join(out, "submeter_map")).first().MainMeter == 10
    ev = os.path.join(tmpdir_path, "lc")
    os.makedirs(ev)
    with open(os.path.join(ev, "e.csv"), "w") as f:
        f.write("Date,Program,StartTime,StopTime\n1/5/2024,IR1,5:00,6:00\n")
    pm = os.path.join(tmpdir_path, "map.csv")
    with open(pm, "w") as f:
        f.write("Program,BI_ACCT,BI_SRV_LOC_NBR,BI_MTR_NBR,BI_LOAD_TYPE\nIR1,1,1,10,IR1\n")
    main(["loadcontrol", "--events", ev + "/*.csv", "--program-map", pm, "--program-col", "Program",
          "--indexed", os.path.join(out, "indexed"), "--out", out])
    lc = spark.read.parquet(os.path.join(out, "lc_analysis"))
    assert lc.count() > 0 and {r.MeterNumber for r in lc.collect()} == {10}
    cal = os.path.join(tmpdir_path, "cal")
    main(["calendar", "--first-year", "2024", "--last-year", "2024", "--out", cal])
    assert spark.read.parquet(cal).count() == 366 * 288


def test_cli_chain_then_gold(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    lines = [line(10, f"2024-01-05T{h:02d}:{m:02d}:00.000Z", f"2024-01-05T{h:02d}:{m + 15:02d}:00.000Z")
             for h in range(10, 14) for m in (0, 15, 30)]
    write_extract(landing, "a", lines[:6])
    mi = os.path.join(tmpdir_path, "meters.csv")
    with open(mi, "w") as f:
        f.write("BI_ACCT,BI_MTR_NBR,BI_MTR_POS_NBR,BI_MTR_CONFIG\n1,10,1,M\n")
    bronze, ck = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "ck")
    root = os.path.join(tmpdir_path, "chain")
    ev = os.path.join(tmpdir_path, "lc")
    os.makedirs(ev)
    with open(os.path.join(ev, "e.csv"), "w") as f:
        f.write("Date,Program,StartTime,StopTime\n1/5/2024,IR1,5:00,6:00\n")
    pm = os.path.join(tmpdir_path, "map.csv")
    with open(pm, "w") as f:
        f.write("Program,BI_ACCT,BI_SRV_LOC_NBR,BI_MTR_NBR,BI_LOAD_TYPE\nIR1,1,1,10,IR1\n")
    chain_args = ["chain", "--bronze", bronze, "--root", root, "--checkpoint", ck + "/chain", "--meter-info", mi,
                  "--lc-events", ev + "/*.csv", "--program-map", pm, "--program-col", "Program"]
    main(["ingest", "--landing", landing, "--bronze", bronze, "--checkpoint", ck + "/ingest"])
    main(chain_args)
    write_extract(landing, "b", lines[6:])
    main(["ingest", "--landing", landing, "--bronze", bronze, "--checkpoint", ck + "/ingest"])
    main(chain_args)
    from voltframe.sources.tables import DayTable
    lc = DayTable(spark, os.path.join(root, "lc_analysis"), part_col="local_date").read()
    assert lc.count() > 0 and {r.MeterNumber for r in lc.collect()} == {10}
    gold = os.path.join(tmpdir_path, "gold")
    main(["gold", "--chain-root", root, "--out", gold])
    totals = spark.read.parquet(os.path.join(gold, "hourly_totals"))
    assert totals.count() == 4
    assert float(totals.agg({"AllMetersDayHourAMIValue": "sum"}).first()[0]) == 1.5 * 12
