"""Readers for the landing files: interval-reading extracts (batch and
stream), load-control event CSVs, dimension CSVs and workbook cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: landing layouts ------------------------------------------
READING_SCHEMA = T.StructType([
    T.StructField("MeterNumber", T.IntegerType(), True),
    T.StructField("UnitOfMeasure", T.StringType(), True),
    T.StructField("FlowDirection", T.StringType(), True),
    T.StructField("Channel", T.IntegerType(), True),
    T.StructField("ServiceLocation", T.StringType(), True),
    T.StructField("RateCode", T.StringType(), True),
    T.StructField("RateDescription", T.StringType(), True),
    T.StructField("SubstationCode", T.StringType(), True),
    T.StructField("SubstationDescription", T.StringType(), True),
    T.StructField("Feeder", T.IntegerType(), True),
    T.StructField("ZipCode", T.StringType(), True),
    T.StructField("StartDateTime", T.TimestampType(), True),
    T.StructField("EndDateTime", T.TimestampType(), True),
    T.StructField("Multiplier", T.IntegerType(), True),
    T.StructField("AMIValue", T.FloatType(), True),
    T.StructField("VEEValue", T.FloatType(), True),
])
RESCUE_COLUMN = "_rescued_data"
LC_EVENT_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType(), True),
    T.StructField("Program", T.StringType(), True),
    T.StructField("StartTime", T.StringType(), True),
    T.StructField("StopTime", T.StringType(), True),
])
# ---------------------------------------------------------------------------


LINE_COLUMN = "_line"


def _as_text(schema: T.StructType) -> T.StructType:
    """The layout with every field as text, and the line of a row that has too
    few or too many fields."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]
                        + [T.StructField(LINE_COLUMN, T.StringType(), True)])


def _reading_csv_options(reader):
    # header skipped; .gz files are decompressed by extension
    return (reader.option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", LINE_COLUMN))


def typed_with_rescue(text: DataFrame, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """Text columns -> the layout's types, field by field. A field that doesn't
    fit its type is null, and its text is kept in ``_rescued_data``: a JSON object
    of such fields by name, with the whole line under ``_line`` if the row has too
    few or too many fields. It is null for a row where everything fits; the good
    fields of a damaged row are kept."""
    typed, failed = [], []
    for f in schema.fields:
        value = F.col(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name).try_cast(f.dataType)
        typed.append(value.alias(f.name))
        failed.append(F.when(value.isNull() & F.col(f.name).isNotNull(), F.col(f.name)).alias(f.name))
    if LINE_COLUMN in text.columns:
        failed.append(F.col(LINE_COLUMN))
    # to_json leaves out null fields
    rescued = F.when(F.coalesce(*failed).isNotNull(), F.to_json(F.struct(*failed)))
    rest = [c for c in text.columns if c not in schema.fieldNames() and c != LINE_COLUMN]
    return text.select(*typed, rescued.alias(RESCUE_COLUMN), *rest)


def read_readings_batch(spark: SparkSession, path: str) -> DataFrame:
    """One extract file or a folder of them (plain or gzip CSV)."""
    df = _reading_csv_options(spark.read.schema(_as_text(READING_SCHEMA))).csv(path)
    return typed_with_rescue(df.withColumn("_source_file", F.col("_metadata.file_path")))


def stream_readings(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                    schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """Incremental file stream over a landing folder; each file is read once
    (tracked in the query checkpoint)."""
    r = _reading_csv_options(spark.readStream.schema(_as_text(schema)))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_with_rescue(r.csv(landing).withColumn("_source_file", F.col("_metadata.file_path")), schema)


def read_lc_events(spark: SparkSession, path_glob: str) -> DataFrame:
    return spark.read.schema(LC_EVENT_SCHEMA).csv(path_glob, header=True)


def read_dim_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-driven CSV; every column is text (ids are cast by the operators)."""
    return spark.read.option("header", True).csv(path)


def read_demand_rates(spark: SparkSession, path: str) -> DataFrame:
    """Demand rates: ``Month`` plus rate columns whose names vary; types are
    inferred (a dozen rows)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_sheet_cells(spark: SparkSession, folder: str, pattern: str = "*",
                     sheet_name: str | int = 0) -> DataFrame:
    """Workbook files -> cell table (file, row_no, col_no, value).

    Each file is decoded in its own task (``binaryFile`` + ``mapInPandas``);
    the slicing happens afterwards in Spark. CSV exports decode with pandas;
    ``.xlsx`` needs openpyxl on the executors. A file of another kind that
    ``pattern`` lets in is an error, not an empty result.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)

    def decode(batches):
        import io

        import pandas as pd
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                name = path.rsplit("/", 1)[-1]
                if name.lower().endswith((".xlsx", ".xlsm")):
                    sheet = pd.read_excel(io.BytesIO(content), sheet_name=sheet_name, header=None, dtype=str)
                elif not name.lower().endswith(".csv"):
                    raise ValueError(f"neither a workbook nor a CSV export: {path}")
                else:
                    sheet = pd.read_csv(io.BytesIO(content), header=None, dtype=str,
                                        skip_blank_lines=False, keep_default_na=False, na_values=[""])
                cells = sheet.stack().reset_index()
                cells.columns = ["row_no", "col_no", "value"]
                cells.insert(0, "file", name)
                yield cells.astype({"row_no": "int32", "col_no": "int32", "value": str})

    return files.select("path", "content").mapInPandas(
        decode, "file string, row_no int, col_no int, value string")
