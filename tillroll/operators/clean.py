"""Cleaning of raw lines (one narrow pass, no shuffle).

Every input row leaves with exactly one ``status``:

* ``quarantined``      – a value the warehouse cannot store: no invoice, no
  quantity, no parseable date, no country, or a price/amount that overflows
  DECIMAL(10,2)/DECIMAL(12,2);
* ``dropped_price``    – price not > 0 (NULL and NaN included);
* ``dropped_quantity`` – quantity = 0;
* ``clean``            – everything else.

So ``rows_in = quarantined + dropped_price + dropped_quantity + rows_out``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pystrip
from ..schemas import GUEST_CUSTOMER_ID

STATUS_CLEAN = "clean"
STATUS_QUARANTINED = "quarantined"
STATUS_DROPPED_PRICE = "dropped_price"
STATUS_DROPPED_QUANTITY = "dropped_quantity"

CLEAN_COLUMNS = ("invoice", "stock_code", "description", "quantity", "invoice_date",
                 "price", "customer_id", "country", "source_rank", "is_return", "line_total")


def nan_to_null(df: DataFrame, cols=("price", "customer_id")) -> DataFrame:
    """Float NaN → NULL (Spark orders NaN above every number, so ``NaN > 0`` is
    true; pandas treats NaN as missing)."""
    for c in cols:
        df = df.withColumn(c, F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)))
    return df


def clean_lines(raw: DataFrame) -> DataFrame:
    """Typed raw lines → cleaned lines with ``status`` (see module doc)."""
    df = nan_to_null(raw)
    unit_price = F.col("price").try_cast("decimal(10,2)")
    df = df.select(
        *[c for c in df.columns if c not in ("description", "stock_code", "customer_id", "price")],
        F.coalesce(pystrip("description"), F.lit("UNKNOWN PRODUCT")).alias("description"),
        F.coalesce(F.upper(pystrip("stock_code")), F.lit("UNKNOWN")).alias("stock_code"),
        F.coalesce(F.col("customer_id"), F.lit(float(GUEST_CUSTOMER_ID)))
         .try_cast("int").alias("customer_id"),
        F.col("price").alias("_price"),
        unit_price.alias("price"),
    )
    line_total = (F.col("quantity") * F.col("price")).try_cast("decimal(12,2)")
    df = df.withColumn("line_total", line_total).withColumn(
        "is_return", F.coalesce(F.col("invoice").startswith("C"), F.lit(False)))
    unstorable = (
        F.col("invoice").isNull() | F.col("quantity").isNull()
        | F.col("invoice_date").isNull() | F.col("country").isNull()
        | F.col("customer_id").isNull()
        | ((F.col("_price") > 0) & (F.col("price").isNull() | F.col("line_total").isNull()))
    )
    status = (F.when(unstorable, F.lit(STATUS_QUARANTINED))
               .when(~F.coalesce(F.col("_price") > 0, F.lit(False)), F.lit(STATUS_DROPPED_PRICE))
               .when(F.col("quantity") == 0, F.lit(STATUS_DROPPED_QUANTITY))
               .otherwise(F.lit(STATUS_CLEAN)))
    return df.withColumn("status", status).drop("_price")


def clean_rows(raw: DataFrame) -> DataFrame:
    """The clean lines only, for a single pass over raw lines.

    What a base column already rules out is filtered on that column, before the
    strings are stripped and the amounts computed; the status then settles the rest."""
    price = F.col("price")
    possible = (F.col("invoice").isNotNull() & F.col("invoice_date").isNotNull() & F.col("country").isNotNull()
                & (F.col("quantity") != 0) & (price > 0) & ~F.isnan(price))
    return clean_only(clean_lines(raw.where(possible)))


def clean_only(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("status") == STATUS_CLEAN)


def clean_flat(lines: DataFrame) -> DataFrame:
    """The cleaned flat file (clean rows, business columns only)."""
    return clean_only(lines).select(*CLEAN_COLUMNS)


def clean_flat_from_raw(raw: DataFrame) -> DataFrame:
    """The same straight from the raw lines."""
    return clean_rows(raw).select(*CLEAN_COLUMNS)


def report_columns() -> list:
    s = F.col("status")
    return [F.count(F.lit(1)).alias("rows_in"),
            F.count_if(s == STATUS_QUARANTINED).alias("quarantined"),
            F.count_if(s == STATUS_DROPPED_PRICE).alias("dropped_price"),
            F.count_if(s == STATUS_DROPPED_QUANTITY).alias("dropped_quantity"),
            F.count_if(s == STATUS_CLEAN).alias("rows_out")]


def clean_report(lines: DataFrame) -> DataFrame:
    """Row reconciliation of the cleaning step, one pass with conditional counts."""
    return lines.agg(*report_columns())
