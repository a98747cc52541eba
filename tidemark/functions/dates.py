"""Date arithmetic on zone-less timestamps.

``datediff`` counts the unit boundaries between two moments, where Spark's own
``timestampdiff`` counts whole elapsed units. All of it is integer arithmetic
on microseconds or days since 1970, so the session time zone has no say.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column

# Microseconds per unit.
MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
}
# Months per unit.
MONTHS = {"month": 1, "quarter": 3, "year": 12}
DATE_PARTS = (*MICROS, "day", "week", *MONTHS)


def check_part(datepart: str) -> str:
    part = datepart.lower()
    if part not in DATE_PARTS:
        raise ValueError(f"unsupported date part {datepart!r}; use one of {DATE_PARTS}")
    return part


def as_timestamp(value) -> Column:
    return as_column(value).cast("timestamp_ntz")


def moment(value) -> Column:
    """A given point in time: text, date or datetime; never a column name.

    Datetimes go through text, since Spark reads them in the zone of the Python process.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_micros(value) -> Column:
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, as_timestamp(value))


def floor_div(value: Column, unit: int) -> Column:
    """Integer division rounding down, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(unit)), F.lit(unit))


def _ordinal(value, part: str) -> Column:
    """Number of the unit that contains the moment, rising by one per unit."""
    if part in MICROS:
        return floor_div(epoch_micros(value), MICROS[part])
    day = as_timestamp(value).cast("date")
    if part == "day":
        return F.unix_date(day).cast("long")
    if part == "week":
        # day 0 was a Thursday; +4 makes each Sunday a multiple of seven
        return floor_div((F.unix_date(day) + 4).cast("long"), 7)
    months = (F.year(day) * 12 + F.month(day) - 1).cast("long")
    return months if part == "month" else floor_div(months, MONTHS[part])


def datediff(first, second, datepart: str) -> Column:
    """Unit boundaries crossed going from ``first`` to ``second``; weeks start on Sunday."""
    part = check_part(datepart)
    return _ordinal(second, part) - _ordinal(first, part)


def dateadd(datepart: str, count, start) -> Column:
    """``start`` moved by ``count`` units; month ends clip (Jan 31 + 1 month = Feb 28)."""
    part = check_part(datepart)
    count = count if isinstance(count, Column) else F.lit(count)
    return F.timestamp_add(part.upper(), count, as_timestamp(start))


def date_trunc(datepart: str, value) -> Column:
    """Start of the unit that holds ``value``; weeks start on Monday."""
    part, ts = check_part(datepart), as_timestamp(value)
    if part in MICROS:
        rest = F.pmod(epoch_micros(ts), F.lit(MICROS[part]))
        return F.timestamp_add("MICROSECOND", -rest, ts)
    day = ts.cast("date")
    return (day if part == "day" else F.trunc(day, part)).cast("timestamp_ntz")


def last_day(value, datepart: str) -> Column:
    """Last date of the day, week, month, quarter or year that holds ``value``."""
    part, day = check_part(datepart), as_column(value).cast("date")
    if part == "day":
        return day
    if part == "week":
        return F.date_add(F.trunc(day, "week"), 6)
    if part in MONTHS:
        return F.date_sub(F.add_months(F.trunc(day, part), MONTHS[part]), 1)
    raise ValueError(f"last_day needs a part of a day or longer, not {datepart!r}")


def current_timestamp() -> Column:
    return F.localtimestamp()


def current_timestamp_in_utc() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
