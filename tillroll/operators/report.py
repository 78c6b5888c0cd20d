"""Figures of the written business report, computed instead of quoted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ratios import round2, safe_div
from .aggregates import covering
from .measures import evaluate
from .numbering import running
from .timeintel import monthly_sales


def quarter_share(star) -> DataFrame:
    """Each quarter's share of its year's net sales."""
    q = (covering(star, ["date_key"], {}).fact.groupBy("date_key").agg(F.sum("line_total").alias("net"))
         .join(star.dim_date.select("date_key", "year", "quarter"), "date_key")
         .groupBy("year", "quarter").agg(F.sum("net").alias("net")))
    year_total = F.sum("net").over(Window.partitionBy("year"))
    return q.select("year", "quarter", F.col("net").cast("double").alias("net_sales"),
                    round2(safe_div(F.col("net").cast("double") * 100.0, year_total)).alias("share_pct"))


def q1_dip(star) -> DataFrame:
    """Average monthly sales of Q4 against the following Q1 (months with sales)."""
    m = monthly_sales(covering(star, ["date_key"], {}).fact, star.dim_date).withColumn(
        "quarter", F.quarter(F.make_date("year", "month", F.lit(1))))
    qa = m.groupBy("year", "quarter").agg(
        safe_div(F.sum("net"), F.count(F.lit(1))).alias("avg_month"))
    q4 = qa.where(F.col("quarter") == 4).select("year", F.col("avg_month").alias("q4"))
    q1 = qa.where(F.col("quarter") == 1).select((F.col("year") - 1).alias("year"),
                                                F.col("avg_month").alias("q1"))
    j = q4.join(q1, "year")
    return j.select("year", F.col("q4").alias("q4_avg_month"), F.col("q1").alias("next_q1_avg_month"),
                    round2(safe_div((F.col("q1") - F.col("q4")) * 100.0, F.col("q4"))).alias("change_pct"))


def return_rate_by_country(star) -> DataFrame:
    r = evaluate(star, ("gross_sales", "returns_value"), by=("country",))
    return r.select("country", round2(safe_div(F.abs(F.col("returns_value")) * 100.0,
                                               F.col("gross_sales"))).alias("return_rate_pct"))


def sku_concentration(star, top_n: int = 20) -> DataFrame:
    """Share of net sales made by the top-N products (ties broken by code).

    The top N come from an ordered limit (partial top-k per task, then a merge),
    the total from the same per-product aggregate; both meet in one final
    aggregate over N + 1 rows."""
    per = covering(star, ["product_code"], {}).fact.groupBy("product_code").agg(F.sum("line_total").alias("net"))
    top = (per.orderBy(F.col("net").desc(), F.col("product_code")).limit(top_n)
           .select(F.col("net").alias("top"), F.lit(None).cast(per.schema["net"].dataType).alias("all")))
    allp = per.agg(F.sum("net").alias("all")).select(
        F.lit(None).cast(per.schema["net"].dataType).alias("top"), "all")
    t = top.unionByName(allp).agg(F.sum("top").alias("top"), F.sum("all").alias("all"))
    return t.select(F.lit(top_n).alias("top_n"),
                    round2(safe_div(F.col("top").cast("double") * 100.0, F.col("all"))).alias("share_pct"))


def concentration_curve(star) -> DataFrame:
    """Products by falling net sales with their rank and the share of all net sales that they and those before them make.

    Equal sales go by code, as in ``sku_concentration``, whose figure is the curve's value
    at its rank.  Ranks and running sums are found range by range."""
    per = covering(star, ["product_code"], {}).fact.groupBy("product_code").agg(F.sum("line_total").alias("net"))
    curve = running(per, [F.col("net").desc(), F.col("product_code").asc()], "net")
    return curve.select("product_code", F.col("rank").cast("long").alias("rank"), F.col("net").cast("double").alias("net_sales"),
                        round2(safe_div(F.col("running").cast("double") * 100.0, F.col("total"))).alias("cumulative_pct"))
