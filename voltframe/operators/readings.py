"""Reading cleaning and indexing (bronze -> cleaned -> indexed).

Duplicate handling is expressed with aggregations only, so a key that holds
a large share of all rows is combined map-side instead of landing whole in
one task: exact copies collapse in ``dropDuplicates`` and the per-key pair
rules run on one aggregated row per key, built from fixed-width aggregates
(hash aggregation with partial aggregation before the shuffle).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.timeindex import sample_minutes, serial_index

READING_KEY = ["MeterNumber", "UnitOfMeasure", "FlowDirection", "Channel",
               "StartDateTime", "EndDateTime"]
READING_VALUES = ["AMIValue", "VEEValue"]
READING_COLUMNS = READING_KEY + READING_VALUES


def reading_facts(df: DataFrame) -> DataFrame:
    """The eight reading columns kept in the silver tier."""
    return df.select(*READING_COLUMNS)


def drop_header_rows(df: DataFrame, col: str = "MeterNumber") -> DataFrame:
    """Header residue and unparsable meter numbers arrive as null meters."""
    return df.filter(F.col(col).isNotNull())


def conform_v1(bronze: DataFrame, rescue_col: str = "_rescued_data") -> DataFrame:
    """First-generation silver: drop header residue and the rescue column,
    then exact duplicates (all columns)."""
    df = drop_header_rows(bronze)
    if rescue_col in df.columns:
        df = df.drop(rescue_col)
    return df.dropDuplicates()


def duplicate_keys(df: DataFrame, keys=READING_KEY) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") > 1))


def _pair_keep(dup_count: Column) -> Column:
    """Rules applied to the rows of a key that occurs exactly twice.

    The three filters are kept as written (three-valued logic included): in a
    pair, a row with null VEE is dropped, a 0/0 row is dropped, a row with 0
    AMI is dropped, and a row whose AMI is null is dropped as well because
    ``NOT (null AND true)`` is null.
    """
    ami, vee, n2 = F.col("AMIValue"), F.col("VEEValue"), dup_count == 2
    return (~(vee.isNull() & n2)) & (~((vee == 0) & (ami == 0) & n2)) & (~((ami == 0) & n2))


def resolve_duplicate_pairs(df: DataFrame, keys=READING_KEY, values=READING_VALUES,
                            policy: str = "reference") -> DataFrame:
    """Resolve readings that share a key (run after exact-duplicate removal).

    ``policy="reference"``: keys seen once pass; keys seen exactly twice keep
    the rows allowed by the pair rules (possibly none); keys seen three or more
    times pass untouched (the uniqueness gate rejects them later). Rows with a
    null key column never group with anything and pass.
    ``policy="max"``: one row per key with the larger AMI and VEE.
    """
    if policy == "max":
        return max_per_key(df, keys, values)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    ami, vee = F.col(values[0]), F.col(values[1])
    # a row survives in a pair iff the pair rules hold for it (null -> no);
    # a surviving row has non-null AMI and VEE, so the survivors of a pair are
    # rebuilt exactly from fixed-width aggregates (hash aggregation, partial
    # before the shuffle): one survivor is (min AMI, min VEE); two with equal
    # AMI are (a, min VEE), (a, max VEE); two with different AMI are
    # (min AMI, VEE at min AMI), (max AMI, VEE at max AMI)
    keep = F.coalesce(_pair_keep(F.lit(2)), F.lit(False))
    ka, kv = F.when(keep, ami), F.when(keep, vee)
    # a row with a null key column is its own group (it never joins to a count)
    per_key = df.groupBy(*keys, F.when(null_key, F.struct(ami, vee)).alias("_nk")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(ami).alias("_a1"), F.min(vee).alias("_v1"),
        F.count(F.when(keep, 1)).alias("_k"),
        F.min(ka).alias("_amin"), F.max(ka).alias("_amax"),
        F.min(kv).alias("_vmin"), F.max(kv).alias("_vmax"),
        F.min_by(kv, ka).alias("_v_lo"), F.max_by(kv, ka).alias("_v_hi"))
    n, k, same = F.col("_n"), F.col("_k"), F.col("_amin") == F.col("_amax")

    def row(a, v):
        return F.struct(F.col(a).alias(values[0]), F.col(v).alias(values[1]))
    survivors = F.filter(F.array(
        F.when(n == 1, row("_a1", "_v1")),
        F.when((n == 2) & ((k == 1) | ((k == 2) & same)), row("_amin", "_vmin")),
        F.when((n == 2) & (k == 2) & same, row("_amin", "_vmax")),
        F.when((n == 2) & (k == 2) & ~same, row("_amin", "_v_lo")),
        F.when((n == 2) & (k == 2) & ~same, row("_amax", "_v_hi")),
    ), lambda x: x.isNotNull())
    small = (per_key.filter(n <= 2)
             .select(*keys, F.explode(survivors).alias("_r"))
             .select(*keys, *[F.col(f"_r.{v}").alias(v) for v in values]))
    # keys seen 3+ times (rare; rejected by the gate) come back whole. The
    # null-safe condition keeps the input subtree identical to the one above,
    # so both branches read the same shuffle instead of scanning twice.
    ck = per_key.filter(n >= 3).select(*[F.col(k).alias(f"_ck_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_ck_{k}")) for k in keys])
    crowded = df.join(ck, cond, "left_semi").select(*keys, *values)
    return small.unionByName(crowded)


def max_per_key(df: DataFrame, keys=READING_KEY, values=READING_VALUES) -> DataFrame:
    """Larger-magnitude reading per key (the DST near-duplicate repair)."""
    return df.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def dealt_pairs(df: DataFrame, keys=READING_KEY) -> DataFrame:
    """``resolve_duplicate_pairs`` (reference policy) of rows that are dealt out by
    key already: the rules as written, by a count over the key's rows. They stay
    where they are, sorted by key; a key with very many rows spills."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    alone = F.when(null_key, F.struct(*READING_VALUES))
    counted = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys, alone)))
    return counted.filter(F.coalesce(_pair_keep(F.col("_n")), F.lit(False)) | (F.col("_n") != 2)).drop("_n")


def clean_readings(bronze: DataFrame, policy: str = "reference", parts: int | None = None) -> DataFrame:
    """bronze (any superset of the reading columns) -> unique cleaned readings.

    With ``parts`` the readings are dealt out by key into so many partitions at
    first. All later steps by key (pair rules, merges, change rows of several
    batches with the same ``parts``) work inside them without another exchange,
    so a task's memory follows the rows of a partition. Without, a key with a
    large share of all rows is combined before the exchange.
    """
    facts = reading_facts(bronze)
    if parts and policy == "reference":
        return dealt_pairs(facts.repartition(parts, *READING_KEY).dropDuplicates())
    return resolve_duplicate_pairs(facts.dropDuplicates(), policy=policy)


def index_readings(cleaned: DataFrame) -> DataFrame:
    """Attach start/end slot indices and the sample length in minutes."""
    return (cleaned
            .withColumns({"StartMeterSampleIndex": serial_index("StartDateTime"),
                          "EndMeterSampleIndex": serial_index("EndDateTime")})
            .withColumn("SampleRate", sample_minutes("StartMeterSampleIndex", "EndMeterSampleIndex")))


def null_index_rows(indexed: DataFrame) -> DataFrame:
    """Rows the calendar cannot place (off-grid minute or outside the horizon)."""
    return indexed.filter(F.col("StartMeterSampleIndex").isNull()
                          | F.col("EndMeterSampleIndex").isNull())


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that survive a predicate delete (a null predicate keeps the row)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def duplicate_rows(raw: DataFrame, keys=READING_KEY) -> DataFrame:
    """Raw rows of every key that is duplicated after exact-copy removal: a left
    join from the duplicated keys. A key with a null column is listed, but its
    null matches no raw row."""
    dup = duplicate_keys(reading_facts(raw).dropDuplicates(), keys)
    rest = [c for c in raw.columns if c not in keys]
    # keys come from ``raw``: without a null they all match, and with the raw
    # side streamed AQE can split a hot key
    matched = raw.join(dup, keys, "inner").select(*keys, "count", *rest)
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    types = {f.name: f.dataType for f in raw.schema.fields}
    alone = dup.filter(some_null).select(*keys, "count", *[F.lit(None).cast(types[c]).alias(c) for c in rest])
    return matched.unionByName(alone)
