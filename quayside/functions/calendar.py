"""Calendar expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.numeric import gap
from quayside.functions.text import as_col

_MONDAY = date(1970, 1, 5)
_MICROS_PER_DAY = 86_400_000_000


def parse_timestamp(c: Column | str, formats: Sequence[str]) -> Column:
    """First format that parses wins; text that fits none becomes NULL."""
    return F.coalesce(*[F.try_to_timestamp(as_col(c), F.lit(f)) for f in formats])


def days_apart(a: Column | str, b: Column | str) -> Column:
    """Absolute distance in fractional days."""
    left = F.unix_micros(as_col(a).cast("timestamp"))
    right = F.unix_micros(as_col(b).cast("timestamp"))
    return gap(left, right) / F.lit(_MICROS_PER_DAY)


def shift_days(d: Column | str, days: int) -> Column:
    return F.date_add(as_col(d), days)


def year_month(d: Column | str) -> tuple[Column, Column]:
    return F.year(as_col(d)), F.month(as_col(d))


def iso_week_day(d: Column | str, day: int = 3) -> Column:
    """The given ISO weekday (1 is Monday) of the ISO week that contains `d`."""
    return F.date_add(F.trunc(as_col(d), "week"), day - 1)


def _workdays_before(n: Column) -> Column:
    """Weekdays among the first `n` days that follow a Monday."""
    return F.floor(n / F.lit(7)) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def busdays(start: Column | str, end: Column | str) -> Column:
    """Weekdays in [start, end); negative when end precedes start; NULL without an end."""
    a = F.datediff(F.to_date(as_col(start)), F.lit(_MONDAY))
    b = F.datediff(F.to_date(as_col(end)), F.lit(_MONDAY))
    # Counted backwards, the interval is open at the other end: shift it by a day.
    shift = F.when(b < a, F.lit(1)).otherwise(F.lit(0))
    return _workdays_before(b + shift) - _workdays_before(a + shift)


def next_business_day(d: Column | str) -> Column:
    """Friday jumps to Monday; every other day, Saturday included, to the next day."""
    c = as_col(d)
    return F.date_add(c, F.when(F.weekday(c) == 4, F.lit(3)).otherwise(F.lit(1)))


def month_index(year: Column | str, month: Column | str) -> Column:
    """Months on one continuous axis, so that windows may cross a year end."""
    return as_col(year) * 12 + as_col(month)


def shift_month(as_of: date, months: int) -> tuple[int, int]:
    """(year, month) that lies `months` away from the month of `as_of`."""
    index = as_of.year * 12 + as_of.month - 1 + months
    return index // 12, index % 12 + 1
