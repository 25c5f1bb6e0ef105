"""Calendar arithmetic with warehouse semantics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_before(reference_date: dt.date, days: int) -> Column:
    """A literal, so that the comparison reaches the file scan."""
    return F.lit(reference_date - dt.timedelta(days=days))


def months_before(reference_date: dt.date, months: int) -> Column:
    """Calendar months back; a day past the month's end is clipped."""
    return F.add_months(F.lit(reference_date), -months)


def day_gap(start: Column, end: Column) -> Column:
    """Number of midnights between two dates or timestamps."""
    return F.datediff(end, start)


def month_gap(start: Column, end: Column) -> Column:
    """Number of month starts crossed: 31 Jan to 1 Feb is 1."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def iso_timestamp(moment: Column) -> Column:
    """UTC timestamp as ISO-8601 text with microseconds and offset."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def run_timestamp(moment: dt.datetime) -> Column:
    """A run's wall-clock time as a zone-free literal, equal on every row."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
