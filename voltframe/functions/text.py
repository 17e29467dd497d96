"""Text-shaped keys and tolerant parsing (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: formats of the landing files ----------------------------
LC_DATETIME_FORMAT = "M/d/yyyy H:mm"        # load-control Date + Start/StopTime
SHEET_DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"  # peak cell in the monthly workbook
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_local_datetime(date_col, time_col, fmt: str = LC_DATETIME_FORMAT) -> Column:
    """``concat_ws(' ', Date, Time)`` parsed; unparsable text gives null."""
    return F.try_to_timestamp(F.concat_ws(" ", _c(date_col), _c(time_col)), F.lit(fmt))


def program_id(program) -> Column:
    return F.regexp_replace(_c(program), " ", "_").cast("string")


def event_id(program, start_ts, end_ts) -> Column:
    """``<program with _>_<start>_<end>`` using Spark's timestamp text."""
    return F.concat_ws("_", program_id(program), _c(start_ts).cast("string"),
                       _c(end_ts).cast("string"))


def year_month(year, month, *more) -> Column:
    """Unpadded join key ``2024-8`` (``2024-8-SUB`` with more parts)."""
    parts = [_c(year).cast("string"), _c(month).cast("string")] + [_c(m).cast("string") for m in more]
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit("-"), p)
    return out


def strip_caps_to_double(c) -> Column:
    """Remove capital letters, then cast to double (null when not numeric)."""
    return F.regexp_replace(_c(c), "[A-Z]", "").try_cast("double")


def to_double(c) -> Column:
    return _c(c).try_cast("double")


def difference(a, b) -> Column:
    """b - a"""
    return _c(b) - _c(a)


def pct_difference(a, b) -> Column:
    """(b - a) / a as double, null when a is zero or null."""
    return F.try_divide((_c(b) - _c(a)).cast("double"), _c(a).cast("double"))
