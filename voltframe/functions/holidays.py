"""US federal holidays as a rule-built dimension (no per-row Python).

``us_holidays(years)`` turns a DataFrame of years into one row per holiday
and observed day. It replaces a per-row UDF over the 5-minute calendar with
a tiny dimension that is broadcast-joined on the local date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: US federal holidays -------------------------------------
# (name, month, day) for fixed dates; observed on Friday when on a Saturday
# and on Monday when on a Sunday. Juneteenth applies from 2021.
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1),
    ("Juneteenth National Independence Day", 6, 19),
    ("Independence Day", 7, 4),
    ("Veterans Day", 11, 11),
    ("Christmas Day", 12, 25),
]
# (name, month, weekday 1=Sunday..7=Saturday, nth; -1 = last)
WEEKDAY_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 2, 3),
    ("Washington's Birthday", 2, 2, 3),
    ("Memorial Day", 5, 2, -1),
    ("Labor Day", 9, 2, 1),
    ("Columbus Day", 10, 2, 2),
    ("Thanksgiving", 11, 5, 4),
]
JUNETEENTH_FIRST_YEAR = 2021
# ---------------------------------------------------------------------------


def _nth_weekday(year: Column, month: int, weekday: int, nth: int) -> Column:
    if nth > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        shift = (F.lit(weekday) - F.dayofweek(first) + 7) % 7
        return F.date_add(first, (shift + 7 * (nth - 1)).cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    back = (F.dayofweek(last) - F.lit(weekday) + 7) % 7
    return F.date_sub(last, back.cast("int"))


def _observed(d: Column) -> Column:
    dow = F.dayofweek(d)
    return (F.when(dow == 7, F.date_sub(d, 1))
             .when(dow == 1, F.date_add(d, 1))
             .otherwise(d))


def us_holidays(years: DataFrame, year_col: str = "Year") -> DataFrame:
    """years (one column of int years) -> Year, HolidayDate, HolidayName."""
    y = F.col(year_col).cast("int")
    entries = []
    for name, m, d in FIXED_HOLIDAYS:
        actual = F.make_date(y, F.lit(m), F.lit(d))
        active = F.lit(True) if m != 6 else (y >= JUNETEENTH_FIRST_YEAR)
        obs = _observed(actual)
        entries.append(F.when(active, F.struct(actual.alias("d"), F.lit(name).alias("n"))))
        # an observed day inside the same year (New Year's Friday before is
        # handled from the following year below)
        entries.append(F.when(active & (obs != actual) & (F.year(obs) == y),
                              F.struct(obs.alias("d"), F.lit(name + " (observed)").alias("n"))))
    nxt = F.make_date(y + 1, F.lit(1), F.lit(1))
    entries.append(F.when(F.dayofweek(nxt) == 7,
                          F.struct(F.date_sub(nxt, 1).alias("d"),
                                   F.lit("New Year's Day (observed)").alias("n"))))
    for name, m, wd, nth in WEEKDAY_HOLIDAYS:
        entries.append(F.struct(_nth_weekday(y, m, wd, nth).alias("d"), F.lit(name).alias("n")))
    arr = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return (years.select(y.alias("Year")).distinct()
            .select("Year", F.explode(arr).alias("h"))
            .select("Year", F.col("h.d").alias("HolidayDate"), F.col("h.n").alias("HolidayName")))


def holiday_flag(df: DataFrame, local_ts_col: str, holidays: DataFrame,
                 out_col: str = "Holiday") -> DataFrame:
    """Add a 0/1 flag: the local date of ``local_ts_col`` is a holiday.

    ``holidays`` has a handful of rows per year, so it is broadcast.
    """
    days = F.broadcast(holidays.select(F.col("HolidayDate").alias("_hd")).distinct()
                       .withColumn("_hflag", F.lit(1)))
    return (df.join(days, F.to_date(F.col(local_ts_col)) == F.col("_hd"), "left")
              .withColumn(out_col, F.coalesce(F.col("_hflag"), F.lit(0)))
              .drop("_hd", "_hflag"))
