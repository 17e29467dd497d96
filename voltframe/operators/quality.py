"""Quality gates: checks that abort a job, and check tables for reporting.

Gates run one aggregation job and raise; they are called by the jobs in
``voltframe.plans`` between stages, never inside the lazily built queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    pass


def null_counts(df: DataFrame, cols) -> dict[str, int]:
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def require_no_nulls(df: DataFrame, cols, what: str = "rows") -> None:
    bad = {c: n for c, n in null_counts(df, cols).items() if n}
    if bad:
        raise QualityError(f"{what}: null values in {bad}")


def key_duplicates(df: DataFrame, keys) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") > 1))


def require_unique(df: DataFrame, keys, what: str = "rows") -> None:
    n = key_duplicates(df, keys).limit(1).count()
    if n:
        sample = key_duplicates(df, keys).limit(5).collect()
        raise QualityError(f"{what}: duplicate keys {keys}, e.g. {sample}")


def full_row_duplicates(df: DataFrame, ignore=("_rescued_data", "_source_file")) -> DataFrame:
    """Rows that occur more than once on every column (metadata ignored),
    with their count."""
    cols = [c for c in df.columns if c not in ignore]
    return key_duplicates(df.select(*cols), cols)


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """Full-row duplicates are dropped (they carry no information)."""
    return df.dropDuplicates()


def observed(df: DataFrame, name: str):
    """Attach a row-count metric that is filled by the next action on ``df``.

    Returns ``(df, observation)``; ``observation.get`` has ``{"rows": n}``.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
