"""Division and rounding rules shared by every query.

* SQL-style ratios use ``try_divide``: a zero or NULL denominator gives NULL
  (MySQL semantics), never an ANSI error.
* DAX-style ratios (``DIVIDE(a, b, 0)``) fall back to 0.
* Rounded outputs go through ``DECIMAL(28,8)`` and are rounded half away from
  zero, then leave as DOUBLE, so both Spark and the DuckDB oracle round the
  same decimal value instead of a binary double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / den in DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def dax_div(num: Column, den: Column) -> Column:
    """DAX ``DIVIDE(num, den, 0)``: 0 when den is 0 or blank."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def round_half_up(col: Column, scale: int) -> Column:
    return F.round(col.cast("decimal(28,8)"), scale).cast("double")


def round2(col: Column) -> Column:
    return round_half_up(col, 2)
