"""Calendar helpers (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(col: Column | str) -> Column:
    """YYYYMMDD integer key of a date or timestamp."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def month_key(col: Column | str) -> Column:
    """YYYYMM integer of a date or timestamp."""
    return F.date_format(_c(col), "yyyyMM").cast("int")


def iso_weekday(col: Column | str) -> Column:
    """1 = Monday … 7 = Sunday (Spark's ``dayofweek`` starts on Sunday)."""
    return (F.weekday(_c(col)) + F.lit(1)).cast("int")


def week_ending_monday(col: Column | str) -> Column:
    """Label of a weekly bucket that runs Tuesday..Monday, named by its closing
    Monday (pandas ``resample('W-MON')``).  A Monday maps to itself."""
    return F.next_day(F.date_sub(F.to_date(_c(col)), 1), "MO")


def month_index(year: Column | str, month: Column | str) -> Column:
    """Consecutive month number (year*12 + month - 1) for calendar shifts."""
    return (_c(year) * F.lit(12) + _c(month) - F.lit(1)).cast("int")


def time_of_day(col: Column | str) -> Column:
    """``HH:mm:ss`` text of a timestamp (the warehouse's TIME column)."""
    return F.date_format(_c(col), "HH:mm:ss")
