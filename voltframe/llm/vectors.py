"""Checks shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, all components present and finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of equal length in double precision."""
    return np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)
