"""Fact builder and the star view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, time_of_day
from ..schemas import FACT_COLUMNS, GUEST_CUSTOMER_ID


def fact_sales(clean: DataFrame, dim_branches: DataFrame) -> DataFrame:
    """Cleaned lines → fact rows.  ``branch_id`` is a left lookup by country.
    The branch dimension (one row per distinct country) is broadcast by Spark's
    own size check — statically from the parquet size, or at run time by AQE —
    so the lookup is map-side unless the country column explodes."""
    branches = dim_branches.select("country", "branch_id")
    return (clean.join(branches, "country", "left")
            .select(F.col("line_id").alias("sales_id"),
                    F.col("invoice").alias("invoice_no"),
                    "customer_id",
                    F.col("stock_code").alias("product_code"),
                    "branch_id",
                    date_key("invoice_date").alias("date_key"),
                    time_of_day("invoice_date").alias("transaction_time"),
                    "quantity",
                    F.col("price").alias("unit_price"),
                    "line_total",
                    "is_return"))


def bi_projection(fact: DataFrame) -> DataFrame:
    """The BI model's fact scan: the ten business columns (no surrogate id)."""
    return fact.select(*FACT_COLUMNS)


#: Parts that the guest rows are spread over where they meet the customer dimension.
GUEST_PARTS = 1024


def with_customer_country(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Fact rows with ``customer_country``.

    The guest id is about a quarter of all rows.  Its country is one value, looked up
    once; in the join the guest rows carry a part number that no customer has, so
    they spread over the tasks instead of meeting in one."""
    guest = F.col("customer_id") == GUEST_CUSTOMER_ID
    part = F.when(guest, 1 + F.pmod(F.xxhash64("invoice_no", "product_code", "date_key"), F.lit(GUEST_PARTS))).otherwise(F.lit(0))
    # zero for every customer, but not a literal, which the optimizer would take out of the join key
    zero = F.pmod(F.col("customer_id").cast("long"), F.lit(1))
    others = dim_customers.where(F.col("customer_id") != GUEST_CUSTOMER_ID).select(
        "customer_id", zero.alias("_part"), F.col("country").alias("_country"))
    guest_country = (dim_customers.where(F.col("customer_id") == GUEST_CUSTOMER_ID)
                     .agg(F.max("country").alias("country")).scalar())
    rows = fact.withColumn("_part", part.cast("long")).join(others, ["customer_id", "_part"], "left")
    country = F.when(guest, guest_country).otherwise(F.col("_country"))
    return rows.select(*fact.columns, country.alias("customer_country"))


def star_view(star) -> DataFrame:
    """Fact with its four dimensions (each dimension filters the fact one way).

    No join hints: Catalyst broadcasts a dimension whose measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (calendar and branches always are
    in practice), AQE converts at run time when a shuffled side turns out small,
    and a large customer/product dimension is shuffle-joined, the guest rows spread
    beforehand (``with_customer_country``), other hot keys split by AQE."""
    f = with_customer_country(star.fact, star.dim_customers)
    dd = star.dim_date.select("date_key", "year", "month")
    db = star.dim_branches.select("branch_id", "branch_name")
    dp = star.dim_products.select("product_code", "product_name")
    return (f.join(dd, "date_key", "left").join(db, "branch_id", "left")
             .join(dp, "product_code", "left")
             .select(*FACT_COLUMNS, "year", "month", "product_name", "branch_name",
                     "customer_country"))
