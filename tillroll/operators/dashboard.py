"""Datasets behind the dashboard visuals (the drawing itself is out of scope)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ratios import round2, round_half_up, safe_div
from ..schemas import GUEST_CUSTOMER_ID
from .aggregates import covering
from .measures import evaluate
from .timeintel import shifted

CARD_MEASURES = ("net_sales", "total_transactions", "aov", "return_rate")


def cards(star) -> DataFrame:
    return evaluate(star, CARD_MEASURES)


def sliced_cards(star, slicers=None) -> DataFrame:
    """KPI cards under slicers; a ``date_key`` range reaches the fact scan as
    partition and pushed filters, a branch-country list filters through the branch
    dimension.  No slicers (None or empty) means unfiltered."""
    return evaluate(star, CARD_MEASURES, where=slicers)


def trend(star) -> DataFrame:
    """Monthly net sales with the whole same month of the previous year overlaid."""
    m = shifted(star, whole_months=True)
    return m.select("year", "month", F.col("net").cast("double").alias("net_sales"),
                    F.col("ly").cast("double").alias("net_sales_ly"))


def _share(df: DataFrame, key: str) -> DataFrame:
    total = F.sum("net").over(Window.partitionBy())
    return df.select(key, F.col("net").cast("double").alias("net_sales"),
                     round2(safe_div(F.col("net").cast("double") * 100.0, total)).alias("share_pct"))


def region_share(star) -> DataFrame:
    per_branch = covering(star, ["branch_id"], {}).fact.groupBy("branch_id").agg(F.sum("line_total").alias("net"))
    j = per_branch.join(star.dim_branches.select("branch_id", "region"), "branch_id", "left")
    return _share(j.groupBy("region").agg(F.sum("net").alias("net")), "region")


def country_sales(star) -> DataFrame:
    return evaluate(star, ("net_sales",), by=("country",))


def product_matrix(star) -> DataFrame:
    return evaluate(star, ("net_sales", "return_rate", "gross_margin"), by=("product_code",))


def price_quantity(star) -> DataFrame:
    """Price/quantity points per product (purchases only) and the log-log slope
    (price elasticity) of each product's points; NULL with a single price.

    The slope is a partial aggregate per product joined back to the points,
    so a product with very many price points never sits in one window task."""
    pts = (star.fact.where(~F.col("is_return"))
           .groupBy("product_code", "unit_price").agg(F.sum("quantity").alias("quantity")))
    x, y = F.ln(F.col("unit_price").cast("double")), F.ln(F.col("quantity").cast("double"))
    per = pts.groupBy("product_code").agg(
        F.when((F.min("unit_price") < F.max("unit_price")) & (F.min("quantity") > 0),
               F.regr_slope(y, x)).alias("slope"))
    return pts.join(per, "product_code").select(
        "product_code", F.col("unit_price").cast("double").alias("unit_price"),
        F.col("quantity").cast("long").alias("quantity"), round_half_up(F.col("slope"), 6).alias("slope"))


def guest_split(star) -> DataFrame:
    g = star.fact.groupBy((F.col("customer_id") == GUEST_CUSTOMER_ID).alias("is_guest")).agg(
        F.sum("line_total").alias("net"))
    return _share(g, "is_guest")
