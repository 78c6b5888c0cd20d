"""Business SQL queries of the warehouse (KPIs, growth, basket, ranking,
market share, customer frequency)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ratios import round2, safe_div
from ..schemas import GUEST_CUSTOMER_ID

def _ret() -> F.Column:
    return F.col("is_return")


def _lt() -> F.Column:
    return F.col("line_total")


def _money(c: F.Column) -> F.Column:
    """Money leaves the engine as DOUBLE (exact decimal sum, cast once)."""
    return c.cast("double")


def kpi_totals(fact: DataFrame) -> DataFrame:
    """Gross, returns, net and return rate in one scan (conditional sums)."""
    agg = fact.agg(F.sum(F.when(~_ret(), _lt()).otherwise(F.lit(0))).alias("g"),
                   F.sum(F.when(_ret(), _lt()).otherwise(F.lit(0))).alias("r"),
                   F.sum(_lt()).alias("n"))
    return agg.select(
        _money(F.col("g")).alias("gross_sales_gbp"),
        _money(F.col("r")).alias("returns_gbp"),
        _money(F.col("n")).alias("net_sales_gbp"),
        round2(safe_div(F.abs(F.col("r").cast("double")) * 100.0, F.col("g"))).alias("return_rate_pct"),
    )


def monthly_net(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Net sales per (year, month) through the date dimension.  The fact is
    pre-aggregated per day first, so only one row per date meets the join."""
    daily = fact.groupBy("date_key").agg(F.sum(_lt()).alias("net"))
    dd = dim_date.select("date_key", "year", "month")
    return daily.join(dd, "date_key").groupBy("year", "month").agg(F.sum("net").alias("net_sales"))


def mom_growth(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Month-over-month growth against the previous month *with sales* (a row
    LAG): a month without sales is skipped, not zero.  The first month is
    dropped.  The window runs over the monthly aggregate only."""
    m = monthly_net(fact, dim_date)
    w = Window.orderBy("year", "month")
    g = m.withColumn("prev", F.lag("net_sales", 1).over(w)).where(F.col("prev").isNotNull())
    return g.select(
        "year", "month",
        _money(F.col("net_sales")).alias("net_sales_gbp"),
        _money(F.col("prev")).alias("prev_month_sales_gbp"),
        round2(safe_div((F.col("net_sales") - F.col("prev")).cast("double") * 100.0,
                        F.col("prev"))).alias("mom_growth_pct"),
    )


def aov_basket(fact: DataFrame) -> DataFrame:
    """Purchase orders, average order value and items per basket (returns out).

    Written as an explicit per-invoice pre-aggregate: the distinct count becomes
    a plain count and the shuffle carries one row per invoice and partition."""
    per_inv = (fact.where(~_ret()).groupBy("invoice_no")
               .agg(F.sum(_lt()).alias("amount"), F.sum("quantity").alias("units")))
    t = per_inv.agg(F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount"),
                    F.sum("units").alias("units"))
    return t.select(
        F.col("orders").alias("total_orders"),
        round2(safe_div(F.col("amount"), F.col("orders"))).alias("average_order_value_gbp"),
        round2(safe_div(F.col("units"), F.col("orders"))).alias("average_items_per_basket"),
    )


def top_products(fact: DataFrame, dim_products: DataFrame, n: int = 10) -> DataFrame:
    """Products by purchase sales with DENSE_RANK ≤ n (ties kept, so the result
    may exceed n rows).  Aggregates per product before the product join; the
    rank filter becomes a partial + final WindowGroupLimit, so only ≤ n ranks
    per task reach the single-partition window."""
    per_prod = (fact.where(~_ret()).groupBy("product_code")
                .agg(F.sum(_lt()).alias("net"), F.sum("quantity").alias("units")))
    j = per_prod.join(dim_products, "product_code")
    w = Window.orderBy(F.col("net").desc())
    ranked = j.withColumn("sales_rank", F.dense_rank().over(w)).where(F.col("sales_rank") <= n)
    return ranked.select(
        F.col("sales_rank").cast("int").alias("sales_rank"),
        "product_code", "product_name",
        _money(F.col("net")).alias("net_sales_gbp"),
        F.col("units").cast("long").alias("total_units_sold"),
    )


def branch_share(fact: DataFrame, dim_branches: DataFrame) -> DataFrame:
    """Net sales per branch and share of the net over *all* fact rows (rows
    without a matching branch still count in the denominator).  One fact scan:
    the per-branch aggregate keeps the NULL/orphan groups for the total."""
    per_branch = fact.groupBy("branch_id").agg(F.sum(_lt()).alias("net"))
    with_total = per_branch.withColumn("total", F.sum("net").over(Window.partitionBy()))
    j = with_total.join(dim_branches, "branch_id")
    return j.select(
        "branch_id", "branch_name", "country",
        _money(F.col("net")).alias("net_sales_gbp"),
        round2(safe_div(F.col("net").cast("double") * 100.0, F.col("total"))).alias("market_share_pct"),
    ).orderBy(F.col("net_sales_gbp").desc())


SEGMENTS = (
    # Segment labels of the frequency profile.
    "1. Single-purchase Customers",
    "2. Repeat Customers (2-5 orders)",
    "3. Frequent Buyers (6-15 orders)",
    "4. Power Buyers (15+ orders)",
)


def customer_segments(fact: DataFrame) -> DataFrame:
    """Customers by number of distinct invoices (returns count as orders, the
    guest id is excluded before the shuffle)."""
    per_cust = (fact.where(F.col("customer_id") != GUEST_CUSTOMER_ID)
                .groupBy("customer_id").agg(F.count_distinct("invoice_no").alias("orders")))
    o = F.col("orders")
    seg = (F.when(o == 1, F.lit(SEGMENTS[0]))
            .when(o.between(2, 5), F.lit(SEGMENTS[1]))
            .when(o.between(6, 15), F.lit(SEGMENTS[2]))
            .otherwise(F.lit(SEGMENTS[3])))
    counts = per_cust.groupBy(seg.alias("customer_segment")).agg(F.count(F.lit(1)).alias("customer_count"))
    total = F.sum("customer_count").over(Window.partitionBy())
    return counts.select(
        "customer_segment", "customer_count",
        round2(safe_div(F.col("customer_count").cast("double") * 100.0, total)).alias("pct_of_customer_base"),
    ).orderBy("customer_segment")
