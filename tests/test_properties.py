"""Property tests: built-in Column helpers agree with the Python/pandas
semantics they reproduce, and whole-table identities hold at sf0.01."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SF001

import __spark_entry__ as E
from tillroll.functions.dates import week_ending_monday
from tillroll.functions.ratios import round2
from tillroll.functions.text import pystrip
from tillroll.plans.warehouse import open_star
from tillroll.schemas import DIM_BRANCHES, DIM_CUSTOMERS, DIM_DATE, DIM_PRODUCTS, FACT_SALES, MONTH_PARTITION, same_fields

_WS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　"
_text = st.text(alphabet=st.sampled_from(list(_WS) + list("abé中")), max_size=12)


@settings(max_examples=30, deadline=None)
@given(st.lists(_text, min_size=1, max_size=20))
def test_pystrip_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.s for r in df.select(pystrip("s").alias("s")).collect()]
    assert got == [v.strip() for v in values]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(2009, 1, 1), max_value=dt.datetime(2012, 12, 31)),
                min_size=1, max_size=30, unique=True))
def test_week_buckets_match_pandas_resample(spark, stamps):
    # value 2**i per point: every bucket sum identifies exactly which points it holds
    vals = [float(2 ** i) for i in range(len(stamps))]
    df = spark.createDataFrame(list(zip(stamps, vals)), "ts timestamp_ntz, v double")
    got = {r.w: r.v for r in df.groupBy(week_ending_monday("ts").alias("w"))
           .agg(F.sum("v").alias("v")).collect()}
    want = pd.Series(vals, index=pd.DatetimeIndex(stamps)).resample("W-MON").sum()
    want = {k.date(): v for k, v in want.items() if v != 0}
    assert got == want


@settings(max_examples=20, deadline=None)
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=3), min_size=1, max_size=20))
def test_round2_half_away_from_zero(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.x for r in df.select(round2(F.col("x")).alias("x")).collect()]
    want = [float(Decimal(repr(float(v))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values]
    assert got == want


def test_star_conforms_to_schema_contracts(spark):
    s = open_star(spark, SF001)
    assert same_fields(s.dim_date.schema, DIM_DATE)
    assert same_fields(s.dim_customers.schema, DIM_CUSTOMERS)
    assert same_fields(s.dim_products.schema, DIM_PRODUCTS)
    assert same_fields(s.dim_branches.schema, DIM_BRANCHES)
    assert same_fields(s.fact.drop(MONTH_PARTITION).schema, FACT_SALES)


def test_money_identities(spark):
    q = E.queries()
    k = q["kpi_totals"](spark, SF001).first()
    assert abs(k.gross_sales_gbp + k.returns_gbp - k.net_sales_gbp) < 1e-6
    shares = [r.market_share_pct for r in q["branch_share"](spark, SF001).collect()]
    assert abs(sum(shares) - 100.0) < 0.01 * len(shares)
    weekly = q["weekly_series"](spark, SF001).where("series_key = 'ALL'").agg(F.sum("y")).first()[0]
    assert abs(weekly - k.gross_sales_gbp) < 1e-3
    per_country = q["weekly_series"](spark, SF001).where("series_key != 'ALL'").agg(F.sum("y")).first()[0]
    assert abs(per_country - weekly) < 1e-3


def test_count_identities(spark):
    q = E.queries()
    seg = sum(r.customer_count for r in q["customer_segments"](spark, SF001).collect())
    active = q["m_customers"](spark, SF001).agg(F.sum("active_customers")).first()[0]
    s = open_star(spark, SF001)
    distinct = s.fact.where("customer_id != 99999").select("customer_id").distinct().count()
    assert seg == distinct and active >= distinct
    rep = q["clean_report"](spark, SF001).first()
    assert rep.rows_in == rep.quarantined + rep.dropped_price + rep.dropped_quantity + rep.rows_out
    assert rep.rows_out == s.fact.count()
    ri = q["audit_referential"](spark, SF001).first()
    assert ri.total_fact_rows == ri.matching_customers == ri.matching_products == \
        ri.matching_branches == ri.matching_dates


def test_observed_etl_report_equals_clean_report(spark):
    from tillroll.plans.warehouse import etl_report
    s = open_star(spark, SF001)
    rep = E.queries()["clean_report"](spark, SF001).first().asDict()
    assert etl_report(spark, s) == rep


_desc = st.sampled_from(["mug", "cup", "bowl", "MUG"])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), _desc, st.sampled_from([1.0, 2.0, 3.0]),
                          st.sampled_from(["France", "Japan", "EIRE"])), min_size=1, max_size=30))
def test_dims_match_pandas(spark, rows):
    from helpers import star_from_raw
    base = dt.datetime(2010, 1, 1)
    lines = [dict(invoice=str(i), stock_code=c, description=d, customer_id=cid, country=co,
                  invoice_date=base + dt.timedelta(hours=i)) for i, (c, d, cid, co) in enumerate(rows)]
    s = star_from_raw(spark, lines)
    pdf = pd.DataFrame(lines)
    # product name: pandas mode (sorted, first) per code
    want_p = pdf.groupby("stock_code")["description"].agg(lambda x: x.mode()[0]).to_dict()
    got_p = {r.product_code: r.product_name for r in s.dim_products.collect()}
    assert got_p == want_p
    # customer country: last country after sorting by time (timestamps are unique here)
    want_c = (pdf.sort_values("invoice_date").groupby("customer_id")["country"].last()
              .rename(index=lambda v: int(v)).to_dict())
    got_c = {r.customer_id: r.country for r in s.dim_customers.collect()}
    assert got_c == want_c


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.datetimes(min_value=dt.datetime(2010, 1, 1), max_value=dt.datetime(2010, 6, 30)),
                          st.integers(min_value=1, max_value=9)), min_size=1, max_size=25))
def test_gap_filled_weekly_series_matches_pandas(spark, points):
    from helpers import star_from_raw
    from tillroll.operators.forecast import gap_fill, weekly_series
    s = star_from_raw(spark, [dict(invoice=str(i), invoice_date=t, quantity=q, price=1.0)
                              for i, (t, q) in enumerate(points)])
    got = [(r.week, r.y) for r in gap_fill(weekly_series(s, per_country=False)).orderBy("week").collect()]
    ts = pd.Series([float(q) for _, q in points], index=pd.DatetimeIndex([t for t, _ in points]))
    want = [(k.date(), v) for k, v in ts.resample("W-MON").sum().items()]
    assert got == want
