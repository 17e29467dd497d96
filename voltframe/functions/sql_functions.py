"""The slot index, local time, event points and the holiday test as SQL functions.

``register_functions(spark)`` creates them as temporary functions, so that the
same work can be written as SQL text. Their bodies are SQL expressions, which
Spark inlines: the plans are those of the DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from voltframe.functions.holidays import FIXED_HOLIDAYS, JUNETEENTH_FIRST_YEAR, WEEKDAY_HOLIDAYS
from voltframe.functions.timeindex import (CALENDAR_START_EPOCH, LOCAL_TZ, MAX_INDEX, STEP_MINUTES, STEP_SECONDS)


def _slot(ts: str) -> str:
    since = f"(unix_seconds(date_trunc('MINUTE', {ts})) - {CALENDAR_START_EPOCH})"
    return (f"CASE WHEN minute({ts}) % {STEP_MINUTES} = 0 AND {since} >= 0 AND {since} div {STEP_SECONDS} < {MAX_INDEX} "
            f"THEN CAST({since} div {STEP_SECONDS} + 1 AS INT) END")


def _on_fixed_day(d: str) -> str:
    days = {name: f"month({d}) = {m} AND day({d}) = {k}" for name, m, k in FIXED_HOLIDAYS}
    return "(" + " OR ".join(f"({rule}" + (f" AND year({d}) >= {JUNETEENTH_FIRST_YEAR})" if "Juneteenth" in name else ")")
                             for name, rule in days.items()) + ")"


def _holiday(d: str) -> str:
    observed = (f"(dayofweek({d}) = 6 AND {_on_fixed_day(f'date_add({d}, 1)')})",
                f"(dayofweek({d}) = 2 AND {_on_fixed_day(f'date_sub({d}, 1)')})")
    nth = []
    for _, month, weekday, n in WEEKDAY_HOLIDAYS:
        which = f"ceil(day({d}) / 7) = {n}" if n > 0 else f"day({d}) + 7 > day(last_day({d}))"
        nth.append(f"(month({d}) = {month} AND dayofweek({d}) = {weekday} AND {which})")
    return " OR ".join((_on_fixed_day(d), *observed, *nth))


def register_functions(spark: SparkSession, tz: str = LOCAL_TZ) -> None:
    """``vf_slot(ts)``, ``vf_slot_start(slot)``, ``vf_local(ts)``, ``vf_local_slots(local)``
    (none, one or two slots), ``vf_is_holiday(date)`` and the table functions
    ``vf_points(first, last, before, after)`` and ``vf_day_slots(date)``."""
    near = ", ".join(f"to_utc_timestamp(local_time, '{tz}') {shift}" for shift in ("- INTERVAL 1 HOUR", "", "+ INTERVAL 1 HOUR"))
    bodies = {
        "vf_slot(ts TIMESTAMP) RETURNS INT": _slot("ts"),
        "vf_slot_start(slot INT) RETURNS TIMESTAMP":
            f"timestamp_seconds({CALENDAR_START_EPOCH} + CAST(slot - 1 AS BIGINT) * {STEP_SECONDS})",
        "vf_local(ts TIMESTAMP) RETURNS TIMESTAMP": f"from_utc_timestamp(ts, '{tz}')",
        "vf_local_slots(local_time TIMESTAMP) RETURNS ARRAY<INT>":
            f"transform(array_sort(array_distinct(filter(array({near}), u -> from_utc_timestamp(u, '{tz}') = local_time))), "
            f"u -> {_slot('u')})",
        "vf_is_holiday(d DATE) RETURNS BOOLEAN": _holiday("d"),
        "vf_points(first INT, last INT, before INT, after INT) RETURNS TABLE (MeterSampleIndex INT, LoadControlEvent INT)":
            "SELECT i, CASE WHEN i > first AND i <= last THEN 1 ELSE 0 END FROM (SELECT explode(CASE WHEN "
            "first - before <= last + after THEN sequence(first - before, last + after) ELSE array() END) AS i)",
        "vf_day_slots(d DATE) RETURNS TABLE (MeterSampleIndex INT)":
            f"SELECT CAST(unix_seconds(CAST(d AS TIMESTAMP)) - {CALENDAR_START_EPOCH} AS BIGINT) div {STEP_SECONDS} + 1 + k "
            f"FROM (SELECT explode(sequence(0, {86400 // STEP_SECONDS - 1})) AS k)",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
