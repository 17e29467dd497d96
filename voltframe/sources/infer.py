"""Column types of text extracts from one aggregate.

A value's place in the order null < int < decimal < double, date < timestamp,
and text above all, follows from its form. How many values fit each type adds
up over tasks, files and runs, so partial results merge; the column's type is
the first that all its values fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: forms of the types, each with those below it -------------
FORMS = {
    "int": r"^[+-]?[0-9]{1,9}$",
    "decimal": r"^[+-]?[0-9]{1,18}([.][0-9]{1,18})?$",
    "double": r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?Z?)?$",
}
# ---------------------------------------------------------------------------


def fit_counts(text: DataFrame) -> DataFrame:
    """One row a column of ``text``: ``column_name, n`` (values) and how many fit
    each of ``FORMS``. Counts of parts of a table add up to those of the whole."""
    sums = []
    for c in text.columns:
        fits = [F.count_if(F.col(c).rlike(form)).alias(kind) for kind, form in FORMS.items()]
        sums.append(F.struct(F.lit(c).alias("column_name"), F.count(F.col(c)).alias("n"), *fits).alias(c))
    return text.agg(*sums).select(F.explode(F.array(*[F.col(f"`{c}`") for c in text.columns])).alias("f")).select("f.*")


def merged_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("column_name").agg(*[F.sum(c).alias(c) for c in ("n", *FORMS)])


def inferred_types(counts: DataFrame) -> DataFrame:
    """``column_name, type, n, misfits``: ``misfits`` counts the values that keep a
    text column from the type that most of them fit (0 for other columns)."""
    n = F.col("n")
    kind: Column = F.when(n == 0, F.lit("null"))
    for name in FORMS:
        kind = kind.when(F.col(name) == n, F.lit(name))
    return counts.select("column_name", kind.otherwise("text").alias("type"), n,
                         (n - F.greatest(*[F.col(k) for k in FORMS])).alias("misfits"))
