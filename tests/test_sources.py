import gzip
import os

from pyspark.sql import functions as F

import pytest

from voltframe.operators import peaks as P
from voltframe.sources import landing as LD

HEADER = ("MeterNumber,UnitOfMeasure,FlowDirection,Channel,ServiceLocation,RateCode,RateDescription,"
          "SubstationCode,SubstationDescription,Feeder,ZipCode,StartDateTime,EndDateTime,Multiplier,"
          "AMIValue,VEEValue\n")


def line(meter, start="2024-01-01T06:00:00.000Z", end="2024-01-01T06:15:00.000Z", ami="1.5", vee="1.5"):
    return f"{meter},KWH,F,1,L1,R1,Res,SUB1,North,3,55008,{start},{end},1,{ami},{vee}\n"


def write_extract(folder, name, lines, gz=False):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name + (".csv.gz" if gz else ".csv"))
    data = (HEADER + "".join(lines)).encode()
    if gz:
        with gzip.open(path, "wb") as f:
            f.write(data)
    else:
        with open(path, "wb") as f:
            f.write(data)
    return path


def test_batch_csv_rescue_plain_and_gz(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "landing")
    write_extract(d, "a", [line(1), line("X12"), "2,KWH,F\n"])
    write_extract(d, "b", [line(3)], gz=True)
    df = LD.read_readings_batch(spark, d)
    rows = df.collect()
    assert len(rows) == 4
    good = [r for r in rows if r[LD.RESCUE_COLUMN] is None]
    assert sorted(r.MeterNumber for r in good) == [1, 3]
    bad = [r for r in rows if r[LD.RESCUE_COLUMN] is not None]
    assert len(bad) == 2 and all(r._source_file.endswith("a.csv") for r in bad)
    assert all(abs(r.AMIValue - 1.5) < 1e-9 for r in good)


def test_lc_and_dim_csv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "lc")
    os.makedirs(p)
    with open(os.path.join(p, "e1.csv"), "w") as f:
        f.write("Date,Program,StartTime,StopTime\n1/5/2024,Irr A,6:00,10:00\n")
    assert LD.read_lc_events(spark, p + "/*.csv").first().Program == "Irr A"
    m = os.path.join(tmpdir_path, "meters.csv")
    with open(m, "w") as f:
        f.write("BI_ACCT,BI_MTR_NBR,BI_MTR_POS_NBR,BI_MTR_CONFIG,OTHER\n1,10,1,M,x\n1,11,2,S,y\n")
    dim = LD.read_dim_csv(spark, m)
    assert dict(dim.dtypes)["BI_MTR_NBR"] == "string"
    r = os.path.join(tmpdir_path, "rates.csv")
    with open(r, "w") as f:
        f.write("Month,DemandRate\n1,10.5\n2,11\n")
    assert dict(LD.read_demand_rates(spark, r).dtypes)["Month"] == "int"


def test_sheet_cells_from_csv_workbooks(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "sheets")
    os.makedirs(d)
    for k in (1, 2):
        rows = [[""] * 9 for _ in range(11)]
        rows.append(["ID", "CONTRIBUTOR", "CH", "NCT", "NCL", "CL", "GS", "LD", "PF"])
        rows.append(["", "", "", "", "", f"2024-0{k}-15 18:00:00", "", "", ""])
        rows.append(["1", "Sub A", "C1", "t", "100A", "90B", "80", "0.5", "0.9"])
        rows.append(["2", "Sub B", "C1", "t", "110", "95", "85", "0.5", "0.9"])
        rows.append([""] * 9)
        rows.append(["TOTALS", "", "", "", "1", "2", "3", "", ""])
        with open(os.path.join(d, f"m{k}.csv"), "w") as f:
            f.write("\n".join(",".join(r) for r in rows) + "\n")
    cells = LD.read_sheet_cells(spark, d)
    peaks = sorted((r.file, r.CoincidMonth) for r in P.coincident_peaks(cells).collect())
    assert peaks == [("m1.csv", 1), ("m2.csv", 2)]
    load = P.monthly_substation_load(cells).collect()
    assert len(load) == 4
    a = [r for r in load if r.Substation == "Sub A" and r.Month == 1][0]
    assert a.NonCoincidLoad == 100.0 and a.CoincidLoad == 90.0 and a.YearMonthSub == "2024-1-Sub A"


def test_schema_evolution_and_catalogue_names(spark, tmpdir_path):
    from voltframe.sources import tables as TB
    path = os.path.join(tmpdir_path, "evolving")
    TB.write_table(spark.createDataFrame([(1, "a")], "k int, v string"), path, "append")
    TB.write_table(spark.createDataFrame([(2, "b", 3.0)], "k int, v string, w double"), path, "append")
    df = TB.read_evolving(spark, path)
    assert sorted(df.columns) == ["k", "v", "w"] and df.count() == 2
    u = TB.union_evolving(spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2, 5)], "k int, x int"))
    assert u.filter("x IS NULL").count() == 1
    TB.register_table(spark, "vf_evolving_t", path)
    assert spark.table("vf_evolving_t").count() == 2
    TB.drop_table(spark, "vf_evolving_t")
    assert not spark.catalog.tableExists("vf_evolving_t")


def test_a_file_of_another_kind_is_an_error(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "m1.ods"), "w") as f:
        f.write("x")
    with pytest.raises(Exception, match="neither a workbook nor a CSV export"):
        LD.read_sheet_cells(spark, tmpdir_path).collect()


def test_bronze_format_is_found_by_spark(spark, tmpdir_path):
    from voltframe.plans.run import _read_bronze
    at = os.path.join(tmpdir_path, "bronze")
    spark.range(3).withColumn("day", F.lit("2024-01-01")).write.partitionBy("day").parquet(at)
    assert _read_bronze(spark, "file:" + at).count() == 3
