"""The 5-minute serial time index and local-time helpers.

Every reading, load-control point and peak is addressed by an integer
``MeterSampleIndex``: the 1-based position of its 5-minute slot in a UTC
calendar. The index is pure arithmetic on epoch seconds, so no calendar table
has to be joined (or sorted on one partition) to attach it.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: calendar origin, step, horizon and local zone -----------
CALENDAR_START = "2021-01-01 00:00:00"      # UTC, index 1
CALENDAR_START_EPOCH = 1609459200           # unix seconds of CALENDAR_START
STEP_MINUTES = 5
STEP_SECONDS = 300
CALENDAR_FIRST_YEAR = 2021
CALENDAR_LAST_YEAR = 2040                   # last slot 2040-12-31 23:55 UTC
MAX_INDEX = 2103840                         # slots from 2021-01-01 to 2040-12-31 23:55
LOCAL_TZ = "America/Chicago"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def serial_index(ts) -> Column:
    """UTC timestamp -> 1-based 5-minute slot index, or null.

    Seconds are ignored (slots match to the minute); a minute off the 5-minute
    grid or an instant outside the calendar horizon gives null.
    """
    t = F.date_trunc("minute", _c(ts).cast("timestamp"))
    secs = F.unix_seconds(t)
    offset = secs - F.lit(CALENDAR_START_EPOCH)
    idx = F.floor(offset / STEP_SECONDS) + 1
    ok = (F.minute(t) % STEP_MINUTES == 0) & (offset >= 0) & (idx <= MAX_INDEX)
    return F.when(ok, idx.cast("int"))


def index_to_utc(idx) -> Column:
    """Slot index -> UTC timestamp of the slot start."""
    return F.timestamp_seconds(
        F.lit(CALENDAR_START_EPOCH) + (_c(idx).cast("long") - 1) * STEP_SECONDS)


def to_local(ts, tz: str = LOCAL_TZ) -> Column:
    """Local wall time of a UTC instant, as a timestamp whose parts are local
    under a UTC session; an error under any other session zone."""
    wrong = F.raise_error(F.concat(F.lit("spark.sql.session.timeZone must be UTC, not "), F.current_timezone()))
    return F.when(F.current_timezone().isin("UTC", "Etc/UTC", "GMT", "Z", "+00:00"),
                  F.from_utc_timestamp(_c(ts), tz)).otherwise(wrong.cast("timestamp"))


def require_whole_hours(tz: str, first_year: int = 2021, last_year: int = 2040) -> None:
    """Raise if a zone is ever off the whole hour: its local hours would lie
    across two UTC days."""
    zone = ZoneInfo(tz)
    for year in range(first_year, last_year + 1):
        for month in range(1, 13):
            if dt.datetime(year, month, 1, tzinfo=zone).utcoffset() % dt.timedelta(hours=1):
                raise ValueError(f"zone {tz} is not at whole hours from UTC")


def index_to_local(idx, tz: str = LOCAL_TZ) -> Column:
    return to_local(index_to_utc(idx), tz)


def hour_ending(local_ts) -> Column:
    """Hour ending 1..24 from the local *start* hour (0..23) + 1."""
    return (F.hour(_c(local_ts)) + 1).cast("int")


def sample_minutes(start_idx, end_idx) -> Column:
    return ((_c(end_idx) - _c(start_idx)) * STEP_MINUTES).cast("int")


def weekend_flag(local_ts) -> Column:
    """1 on Saturday/Sunday of the local date, else 0."""
    return F.when(F.dayofweek(_c(local_ts)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def date_parts(ts, prefix: str) -> list[Column]:
    """Year, Month, Day, Hour, Minute of ``ts`` named ``{prefix}Year`` ..."""
    t = _c(ts)
    return [F.year(t).alias(f"{prefix}Year"), F.month(t).alias(f"{prefix}Month"),
            F.dayofmonth(t).alias(f"{prefix}Day"), F.hour(t).alias(f"{prefix}Hour"),
            F.minute(t).alias(f"{prefix}Minute")]


def local_wall_instants(local_ts, tz: str = LOCAL_TZ) -> Column:
    """All UTC instants whose local wall time equals ``local_ts``.

    Same answer as an equi-join of local wall times against the calendar:
    two instants in the autumn overlap, none in the spring gap, else one.
    Candidates are the zone's conversion and one hour either side.
    """
    lt = _c(local_ts).cast("timestamp")
    guess = F.to_utc_timestamp(lt, tz)
    cands = F.array(guess - F.expr("INTERVAL 1 HOUR"), guess, guess + F.expr("INTERVAL 1 HOUR"))
    return F.array_sort(F.array_distinct(
        F.filter(cands, lambda u: F.from_utc_timestamp(u, tz) == lt)))
