"""Schema contracts of the warehouse (explicit StructTypes, never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

GUEST_CUSTOMER_ID = 99999

# Header names used by the regional extracts (fixed values of the source format).
RAW_HEADER = ("Invoice", "StockCode", "Description", "Quantity", "InvoiceDate",
              "Price", "Customer ID", "Country")

RAW = T.StructType([
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("source_rank", T.IntegerType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("is_weekend", T.IntegerType(), False),
])

DIM_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.IntegerType(), False),
    T.StructField("country", T.StringType(), False),
])

DIM_PRODUCTS = T.StructType([
    T.StructField("product_code", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
])

DIM_BRANCHES = T.StructType([
    T.StructField("branch_id", T.IntegerType(), False),
    T.StructField("branch_name", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
])

FACT_SALES = T.StructType([
    T.StructField("sales_id", T.LongType(), False),
    T.StructField("invoice_no", T.StringType(), False),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("branch_id", T.IntegerType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("transaction_time", T.StringType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DecimalType(10, 2), False),
    T.StructField("line_total", T.DecimalType(12, 2), False),
    T.StructField("is_return", T.BooleanType(), False),
])

# Declared column lengths of the warehouse DDL (VARCHAR(n)); Spark strings are
# unbounded, so they are audited as data (audit_constraints).
VARCHAR_LIMITS = {
    ("dim_customers", "country"): 100,
    ("dim_products", "product_code"): 50,
    ("dim_products", "product_name"): 255,
    ("dim_branches", "branch_name"): 100,
    ("dim_branches", "country"): 100,
    ("fact_sales", "invoice_no"): 50,
    ("fact_sales", "product_code"): 50,
}

# Partition column of the stored fact (YYYYMM of date_key); not a business column.
MONTH_PARTITION = "sales_month"

FACT_COLUMNS = ("invoice_no", "customer_id", "product_code", "branch_id", "date_key",
                "transaction_time", "quantity", "unit_price", "line_total", "is_return")


def same_fields(actual: T.StructType, expected: T.StructType) -> bool:
    """Names and types equal (nullability is not compared)."""
    return [(f.name, f.dataType) for f in actual.fields] == \
           [(f.name, f.dataType) for f in expected.fields]
