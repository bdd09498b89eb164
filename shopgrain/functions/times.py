"""Date and time helpers for TIMESTAMP_NTZ columns.

None of them goes through a zoned timestamp, so results do not depend on the session time zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# English day and month names, Sunday and January first.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December"]


def ntz(text: str) -> Column:
    """Constant TIMESTAMP_NTZ. A Python datetime literal would be zoned and block pushdown."""
    return F.lit(text).cast("timestamp_ntz")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def day_id(c: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def dow_sunday0(c: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(c) - 1


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def _pick(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def day_name(dow: Column) -> Column:
    """Name of a day of week that counts from Sunday = 0."""
    return _pick(DAY_NAMES, dow + 1)


def month_name(c: Column) -> Column:
    return _pick(MONTH_NAMES, F.month(c))


def whole_days(start: Column, end: Column) -> Column:
    """Completed 24-hour periods from start to end; not the count of midnights crossed."""
    return F.extract(F.lit("DAY"), end - start)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end, fraction included, as DOUBLE."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


def minute_crossings(start: Column, end: Column) -> Column:
    """How many minute boundaries lie between start and end: 10:00:59 to 10:01:01 is 1."""
    def micros(seconds: Column) -> Column:
        return F.floor(seconds * 1e6 + 0.5)

    into_minute = F.extract(F.lit("SECOND"), start).cast("double")
    since_minute = micros(elapsed_seconds(start, end)) + micros(into_minute)
    return F.floor(since_minute / 6e7)


def in_month(c: Column, first_day: date) -> Column:
    """True inside the month of first_day, as a half-open range that Parquet can prune on."""
    start = first_day.replace(day=1)
    year, month = divmod(start.year * 12 + start.month, 12)
    after = date(year, month + 1, 1)
    return (c >= ntz(f"{start} 00:00:00")) & (c < ntz(f"{after} 00:00:00"))
