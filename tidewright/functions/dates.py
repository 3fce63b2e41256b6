"""Date differences counted in calendar boundaries, and date ranges that reach the file scan."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_crossed(start, end) -> Column:
    """Number of midnights between two instants, whatever the time of day."""
    return F.date_diff(end, start)


def month_number(at) -> Column:
    """Months since year 0, so that a difference of two counts month boundaries."""
    return F.year(at) * 12 + F.month(at)


def months_crossed(start, end) -> Column:
    """Number of month boundaries between two instants (31 January to 1 February is 1)."""
    return month_number(end) - month_number(start)


def on_days(column, first, last=None) -> Column:
    """True on the days first..last, both included.

    Written as a half-open range over the raw column, so that Parquet statistics prune row groups; a
    cast of the column to a date would hide it from the scan.
    """
    first = _date(first)
    last = _date(last) if last is not None else first
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(first)) & (column < F.lit(last + dt.timedelta(days=1)))


def in_years(column, first, last=None) -> Column:
    """True in the calendar years first..last; a year given as text is read as a number."""
    first = int(first)
    last = int(last) if last is not None else first
    return on_days(column, dt.date(first, 1, 1), dt.date(last, 12, 31))


def _date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
