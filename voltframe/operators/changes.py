"""Table maintenance as dataflow: upsert, change rows, high-water marks and
re-aggregation scope -- plain DataFrame joins, no table format required.

Change rows carry ``_change_type`` (insert / update_preimage /
update_postimage / delete) and ``_commit_version``; a consumer keeps the
last upstream version it processed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE_TYPES = ("insert", "update_preimage", "update_postimage", "delete")


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted.

    Keys compare with plain equality, so a null key never matches and its
    source row is inserted. ``source`` must be unique on ``keys``.
    """
    return (target.join(source.select(*keys), list(keys), "left_anti")
            .unionByName(source))


def _change_rows(before: Column, after: Column) -> Column:
    same = F.coalesce(before.eqNullSafe(after), F.lit(False))
    both = before.isNotNull() & after.isNotNull()
    return F.filter(F.array(
        F.when(before.isNull(), F.struct(F.lit("insert").alias("t"), after.alias("r"))),
        F.when(after.isNull(), F.struct(F.lit("delete").alias("t"), before.alias("r"))),
        F.when(both & ~same, F.struct(F.lit("update_preimage").alias("t"), before.alias("r"))),
        F.when(both & ~same, F.struct(F.lit("update_postimage").alias("t"), after.alias("r"))),
    ), lambda x: x.isNotNull())


def diff_changes(before: DataFrame, after: DataFrame, keys, version: int) -> DataFrame:
    """Change rows that turn ``before`` into ``after`` (both unique on keys)."""
    cols = [c for c in after.columns if c not in keys]
    b = before.select(*keys, F.struct(*cols).alias("_b"))
    a = after.select(*keys, F.struct(*cols).alias("_a"))
    j = b.join(a, list(keys), "full_outer")
    return (j.select(*keys, F.explode(_change_rows(F.col("_b"), F.col("_a"))).alias("_c"))
            .select(*keys, *[F.col(f"_c.r.{c}").alias(c) for c in cols],
                    F.col("_c.t").alias("_change_type"),
                    F.lit(version).cast("bigint").alias("_commit_version")))


def upsert_changes(target: DataFrame, source: DataFrame, keys, version: int) -> DataFrame:
    """Change rows of ``upsert(target, source)`` computed from the source
    side only (a left join of the batch to the target), so their cost
    follows the batch, not the table."""
    cols = [c for c in source.columns if c not in keys]
    s = source.select(*keys, F.struct(*cols).alias("_a"))
    t = target.select(*keys, F.struct(*cols).alias("_b"))
    j = s.join(t, list(keys), "left")
    return (j.select(*keys, F.explode(_change_rows(F.col("_b"), F.col("_a"))).alias("_c"))
            .select(*keys, *[F.col(f"_c.r.{c}").alias(c) for c in cols],
                    F.col("_c.t").alias("_change_type"),
                    F.lit(version).cast("bigint").alias("_commit_version")))


def initial_load_changes(df: DataFrame, version: int) -> DataFrame:
    return df.withColumns({"_change_type": F.lit("insert"),
                           "_commit_version": F.lit(version).cast("bigint")})


def delete_changes(df: DataFrame, predicate: Column, version: int) -> DataFrame:
    """Change rows of a predicate delete (null predicate keeps the row)."""
    return (df.filter(F.coalesce(predicate, F.lit(False)))
            .withColumns({"_change_type": F.lit("delete"),
                          "_commit_version": F.lit(version).cast("bigint")}))


def postimages(changes: DataFrame) -> DataFrame:
    """Rows a downstream consumer applies: inserts and update post-images."""
    return changes.filter(~F.col("_change_type").isin("update_preimage", "delete"))


def changes_since(changes: DataFrame, version: int) -> DataFrame:
    return changes.filter(F.col("_commit_version") > version)


def changes_since_time(changes: DataFrame, ts) -> DataFrame:
    """Change rows committed after a point in time (``_commit_timestamp``)."""
    return changes.filter(F.col("_commit_timestamp") > F.lit(ts).cast("timestamp"))


def read_changes(log: DataFrame, since_version: int) -> DataFrame:
    """Change rows committed after ``since_version`` (the consumer's high
    water mark); on a log partitioned by ``_commit_version`` the filter
    prunes partitions."""
    return changes_since(log, since_version)


def latest_per_key(changes: DataFrame, keys) -> DataFrame:
    """One post-image per key: the one with the highest commit version
    (several changes to one key inside a window would otherwise collide).
    Uses an aggregate (max over a struct) rather than a window, so a key
    with many versions is combined map-side."""
    cols = [c for c in changes.columns if c not in keys]
    best = F.max(F.struct(F.col("_commit_version").alias("_v"),
                          *[F.col(c) for c in cols if c != "_commit_version"]))
    return (changes.groupBy(*keys).agg(best.alias("_m"))
            .select(*keys, *[F.col(f"_m.{c}").alias(c) for c in cols if c != "_commit_version"],
                    F.col("_m._v").alias("_commit_version")))


def change_history(changes: DataFrame) -> DataFrame:
    return changes.groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).alias("count"))


def high_water(changes: DataFrame) -> DataFrame:
    """The last version a consumer has to have processed."""
    return changes.agg(F.max("_commit_version").alias("HighWaterVersion"),
                       F.count(F.lit(1)).alias("ChangeRows"))


def affected_hours(changes: DataFrame, hour_keys, with_hour) -> DataFrame:
    """Distinct hour keys touched by a batch (``with_hour`` adds them)."""
    return with_hour(changes).select(*hour_keys).distinct()


def reaggregation_scope(upstream: DataFrame, changed: DataFrame, hour_keys, with_hour) -> DataFrame:
    """Upstream rows of every hour touched by ``changed`` -- whole hours
    only, so no partial hour is ever written, and nothing outside them is
    re-read (a left-semi join instead of "everything since the first
    changed day")."""
    touched = affected_hours(changed, hour_keys, with_hour)
    return with_hour(upstream).join(touched, list(hour_keys), "left_semi")


def first_changed_day(changes: DataFrame, ts_col: str = "StartDateTime"):
    """Earliest changed date of a batch (one scalar to the driver)."""
    return changes.agg(F.min(F.to_date(ts_col))).first()[0]


def since_first_change(upstream: DataFrame, changes: DataFrame, ts_col: str = "StartDateTime") -> DataFrame:
    """``reference_scope`` as one plan: the bound is a scalar subquery, so
    nothing runs before the result is asked for. No changes give no rows."""
    first = changes.agg(F.min(F.to_date(ts_col)).cast("timestamp")).scalar()
    return upstream.filter(F.col(ts_col) >= first)


def changes_after(changes: DataFrame, mark: DataFrame) -> DataFrame:
    """Change rows past a high-water mark (the row that ``high_water`` gave for
    what has been processed); all of them if nothing has."""
    version = F.coalesce(mark.select("HighWaterVersion").scalar(), F.lit(-1))
    return changes.filter(F.col("_commit_version") > version)


def reference_scope(upstream: DataFrame, changes: DataFrame, ts_col: str = "StartDateTime") -> DataFrame:
    """The reference's re-aggregation scope: every upstream row from the
    first changed day on. The bound is a literal, so it reaches the parquet
    scan as a pushed filter. Prefer ``reaggregation_scope`` (touched hours
    only); both give the same rows for the touched hours."""
    day = first_changed_day(changes, ts_col)
    if day is None:
        return upstream.limit(0)
    return upstream.filter(F.col(ts_col) >= F.lit(day).cast("timestamp"))
