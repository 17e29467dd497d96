"""Monthly supplier workbook -> coincident peaks and substation loads;
usage at the coincident-peak hour.

Workbooks are handled as one cell table ``(file, row_no, col_no, value)``
for all files at once; the per-file slicing (header offset, the ``TOTALS``
sentinel, the peak cell) is a per-file aggregate joined back, so there is no
driver loop over files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.text import SHEET_DATETIME_FORMAT, strip_caps_to_double, to_double, year_month
from voltframe.functions.timeindex import LOCAL_TZ, local_wall_instants, serial_index

# --- fixed values: workbook layout -----------------------------------------
HEADER_ROW = 11          # rows above the header are skipped
TOTALS_LABEL = "TOTALS"  # first-column sentinel that ends the data
GAP_ROWS = 1             # the row just above TOTALS is dropped as well
PEAK_CELL_COL = 5        # peak timestamp: first data row, sixth column
SHEET_COLUMNS = ["ID", "Substation", "CH", "NonCoincidTime", "NonCoincidLoad", "CoincidLoad",
                 "GRESupplied", "LDFact", "PwrFact"]
YEAR_FLOOR = 2017        # monthly loads are kept for Year > YEAR_FLOOR
PEAK_TYPES_POS1 = ("IR1", "GN1")  # position-1 load types kept for peak analysis
# ---------------------------------------------------------------------------


def slice_sheets(cells: DataFrame, header_row: int = HEADER_ROW, gap_rows: int = GAP_ROWS,
                 totals_label: str = TOTALS_LABEL) -> DataFrame:
    """Cells of the data block: below the header, above the TOTALS row
    minus ``gap_rows``, per file. A file without a TOTALS row is an error."""
    totals = (cells.filter((F.col("col_no") == 0) & (F.col("value") == totals_label)
                           & (F.col("row_no") > header_row))
              .groupBy("file").agg(F.min("row_no").alias("_totals")))
    missing = F.raise_error(F.concat(F.lit("no TOTALS row in "), "file")).cast("boolean")
    inside = (F.col("row_no") > header_row) & (F.col("row_no") < F.col("_totals") - gap_rows)
    return (cells.join(totals, "file", "left")
            .filter(F.when(F.col("_totals").isNull(), missing).otherwise(inside)).drop("_totals"))


def sheet_rows(sliced: DataFrame, n_cols: int = len(SHEET_COLUMNS)) -> DataFrame:
    """Cell table -> one row per (file, row_no) with columns c0..c{n-1}."""
    return (sliced.filter(F.col("col_no") < n_cols)
            .groupBy("file", "row_no").pivot("col_no", list(range(n_cols)))
            .agg(F.first("value"))
            .select("file", "row_no", *[F.col(str(i)).alias(f"c{i}") for i in range(n_cols)]))


def coincident_peaks(cells: DataFrame, header_row: int = HEADER_ROW) -> DataFrame:
    """Per file: the peak timestamp (first data row, column 5) and its parts.
    A cell that is no timestamp is an error."""
    time = F.try_to_timestamp(F.col("value"), F.lit(SHEET_DATETIME_FORMAT))
    bad = F.raise_error(F.concat(F.lit("no peak time in "), "file")).cast("timestamp")
    peak = (slice_sheets(cells, header_row)
            .filter((F.col("row_no") == header_row + 1) & (F.col("col_no") == PEAK_CELL_COL))
            .select("file", F.when(time.isNull(), bad).otherwise(time).alias("CoincidTime")))
    return peak_parts(peak).select("file", "CoincidTime", "CoincidYear", "CoincidMonth",
                                   "CoincidDay", "CoincidHour")


def peak_parts(peaks: DataFrame) -> DataFrame:
    t = F.col("CoincidTime")
    return (peaks.withColumn("CoincidYear", F.year(t)).withColumn("CoincidMonth", F.month(t))
            .withColumn("CoincidDay", F.dayofmonth(t)).withColumn("CoincidHour", F.hour(t)))


def monthly_substation_load(cells: DataFrame, header_row: int = HEADER_ROW,
                            year_floor: int = YEAR_FLOOR) -> DataFrame:
    """Substation rows of every workbook with typed measures and join keys."""
    rows = sheet_rows(slice_sheets(cells, header_row))
    named = rows.select("file", *[F.col(f"c{i}").alias(n) for i, n in enumerate(SHEET_COLUMNS)])
    ym = coincident_peaks(cells, header_row).select(
        "file", F.col("CoincidMonth").alias("Month"), F.col("CoincidYear").alias("Year"))
    typed = (named.filter(F.col("Substation").isNotNull())
             .join(ym, "file", "left")  # one row per workbook file
             .withColumn("NonCoincidLoad", strip_caps_to_double("NonCoincidLoad"))
             .withColumn("CoincidLoad", strip_caps_to_double("CoincidLoad"))
             .withColumn("GRESupplied", to_double("GRESupplied"))
             .withColumn("LDFact", to_double("LDFact"))
             .withColumn("PwrFact", to_double("PwrFact"))
             .withColumn("YearMonth", year_month("Year", "Month"))
             .withColumn("YearMonthSub", year_month("Year", "Month", "Substation")))
    missing = F.raise_error(F.concat(F.lit("no peak cell in "), "file")).cast("boolean")
    kept = F.when(F.col("Year").isNull() & F.col("file").isNotNull(), missing).otherwise(F.col("Year") > year_floor)
    return typed.filter(kept).select(*SHEET_COLUMNS, "Month", "Year",
                                                           "YearMonth", "YearMonthSub")


def index_peaks(peaks: DataFrame, tz: str = LOCAL_TZ, ambiguous: str = "all") -> DataFrame:
    """Attach the slot index of each local peak time (inner: a time in the
    spring gap drops out, one in the autumn overlap yields two rows, or one
    with ``ambiguous="first"``/``"last"``)."""
    slots = F.transform(local_wall_instants(F.col("CoincidTime"), tz), lambda u: serial_index(u))
    if ambiguous == "all":
        idx = F.explode(slots)
    elif ambiguous in ("first", "last"):
        idx = F.try_element_at(slots, F.lit(1 if ambiguous == "first" else -1))
    else:
        raise ValueError(f"ambiguous must be 'all', 'first' or 'last', not {ambiguous!r}")
    return (peaks.select("*", idx.alias("MeterSampleIndex"))
            .filter(F.col("MeterSampleIndex").isNotNull()))


def _at_peak(hourly: DataFrame, indexed_peaks: DataFrame) -> DataFrame:
    # peaks: a few rows per month
    pk = indexed_peaks.select("CoincidTime", "CoincidYear", "CoincidMonth", "CoincidDay", "CoincidHour",
                              "MeterSampleIndex")
    return (hourly.join(pk, hourly["EndMeterSampleIndex"] == pk["MeterSampleIndex"])
            .drop("MeterSampleIndex", "LocalYear", "LocalMonth", "LocalDay", "HourEnding"))


def peak_total(hourly_nosub: DataFrame, indexed_peaks: DataFrame) -> DataFrame:
    """All main meters summed at the hour that ends at the coincident peak."""
    return (_at_peak(hourly_nosub, indexed_peaks).groupBy("CoincidYear", "CoincidMonth")
            .agg(F.sum("HourlyAMIValue").alias("TotalCPHourlyAMIValue"),
                 F.sum("HourlyVEEValue").alias("TotalCPHourlyVEEValue"))
            .withColumn("YearMonth", year_month("CoincidYear", "CoincidMonth")))


def normalize_load_types(load_types: DataFrame) -> DataFrame:
    return load_types.withColumns({
        "BI_ACCT": F.col("BI_ACCT").try_cast("int"),
        "BI_MTR_NBR": F.col("BI_MTR_NBR").try_cast("int"),
        "BI_MTR_POS_NBR": F.col("BI_MTR_POS_NBR").try_cast("int")})


def position1_counts(load_types: DataFrame) -> DataFrame:
    """Meters per load type at meter position 1."""
    return (normalize_load_types(load_types).filter(F.col("BI_MTR_POS_NBR") == 1)
            .groupBy("BI_LOAD_TYPE", "BI_LOAD_TYPE_DESC")
            .agg(F.count(F.lit(1)).alias("MeterCount")))


def load_type_lists(load_types: DataFrame, keep_pos1=PEAK_TYPES_POS1) -> DataFrame:
    """Per meter: sorted comma list of its load types. Position-1 rows are
    kept only for the listed types. A meter's list is bounded by the number
    of load types."""
    lt = normalize_load_types(load_types)
    lt = lt.filter((F.col("BI_MTR_POS_NBR") != 1) | F.col("BI_LOAD_TYPE").isin(*keep_pos1))
    return (lt.groupBy("BI_ACCT", "BI_MTR_NBR", "BI_MTR_POS_NBR")
            .agg(F.concat_ws(",", F.array_sort(F.collect_list("BI_LOAD_TYPE")))
                 .alias("BI_LOAD_TYPE_LIST")))


def peak_by_lc_meter(hourly: DataFrame, indexed_peaks: DataFrame, load_types: DataFrame,
                     keep_pos1=PEAK_TYPES_POS1) -> DataFrame:
    """Peak-hour usage of meters that belong to a load-control programme."""
    # one row per load-control meter
    lists = load_type_lists(load_types, keep_pos1)
    at = _at_peak(hourly, indexed_peaks)
    return (at.join(lists, at["MeterNumber"] == lists["BI_MTR_NBR"])
            .withColumn("YearMonth", year_month("CoincidYear", "CoincidMonth")))


def year_month_dim(peak_rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Distinct peak months with their demand rates (rates: one row per month)."""
    ym = peak_rows.select("CoincidYear", "CoincidMonth", "YearMonth").distinct()
    return (ym.join(rates, ym["CoincidMonth"] == rates["Month"]).drop("Month"))


def peak_dropouts(hourly: DataFrame, indexed_peaks: DataFrame) -> DataFrame:
    """Meters with usage in the hour ending at the peak whose hourly row does
    not end exactly at the peak slot (a missing last interval): the peak join
    drops them silently, so count them per peak month."""
    pk = indexed_peaks.select("CoincidYear", "CoincidMonth", "CoincidDay", "CoincidHour",
                              F.col("MeterSampleIndex").alias("_pi"))
    h = hourly.join(pk, (hourly["LocalYear"] == pk["CoincidYear"]) & (hourly["LocalMonth"] == pk["CoincidMonth"])
                    & (hourly["LocalDay"] == pk["CoincidDay"]) & (hourly["HourEnding"] == pk["CoincidHour"]))
    return (h.filter(F.col("EndMeterSampleIndex") != F.col("_pi"))
            .groupBy("CoincidYear", "CoincidMonth")
            .agg(F.countDistinct("MeterNumber").alias("DroppedMeters")))
