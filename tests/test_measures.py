import pytest
from helpers import line, star_from_raw
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillroll.operators import dashboard as G
from tillroll.operators import measures as M
from tillroll.operators import timeintel as TI


def _star(spark):
    return star_from_raw(spark, [
        line("1", (2010, 1, 5, 1), customer_id=1.0, quantity=2, price=10.0, country="France"),
        line("1", (2010, 1, 5, 1), customer_id=1.0, quantity=1, price=5.0, country="France"),
        line("C2", (2010, 1, 9, 1), customer_id=1.0, quantity=-1, price=10.0, country="France"),
        line("3", (2010, 2, 1, 1), customer_id=None, quantity=4, price=1.0, country="Japan"),
        line("4", (2011, 1, 7, 1), customer_id=2.0, quantity=1, price=50.0, country="Japan"),
    ])


def test_core_measures(spark):
    s = _star(spark)
    r = M.evaluate(s, M.MEASURES).first()
    assert r.net_sales == 69.0 and r.gross_sales == 79.0 and r.returns_value == -10.0
    assert abs(r.return_rate - 10.0 / 79.0) < 1e-12
    assert r.total_transactions == 4 and r.net_transactions == 3
    assert abs(r.gross_profit - 27.6) < 1e-9 and abs(r.gross_margin - 0.4) < 1e-12
    assert abs(r.aov - 79.0 / 3) < 1e-12
    assert abs(r.items_per_basket - 7.0 / 3) < 1e-12      # quantity includes the return line
    assert r.active_customers == 2 and abs(r.avg_clv - 34.5) < 1e-12
    assert abs(r.target_sales - 75.9) < 1e-9


def test_filter_context(spark):
    s = _star(spark)
    by = {r.country: r.net_sales for r in M.evaluate(s, ("net_sales",), by=("country",)).collect()}
    assert by == {"France": 15.0, "Japan": 54.0}
    sl = M.evaluate(s, ("net_sales",), where={"date_key": (20100101, 20101231),
                                              "country": ["Japan"]}).first()
    assert sl.net_sales == 4.0
    cards = G.cards(s).first()
    assert cards.net_sales == 69.0 and cards.total_transactions == 4


def test_ytd_and_sssg(spark):
    s = _star(spark)
    y = {(r.year, r.month): r for r in TI.ytd(s).collect()}
    assert y[(2010, 2)].sales_ytd == 19.0 and y[(2011, 1)].sales_ytd == 50.0
    # the calendar ends on 7 January: like for like, the return of the 9th a year before does not count
    assert y[(2011, 1)].sales_ly_ytd == 25.0
    assert abs(y[(2011, 1)].yoy_growth - (50.0 - 25.0) / 25.0) < 1e-12
    whole = {(r.year, r.month): r for r in TI.ytd(s, whole_months=True).collect()}
    assert whole[(2011, 1)].sales_ly_ytd == 15.0
    assert abs(whole[(2011, 1)].yoy_growth - (50.0 - 15.0) / 15.0) < 1e-12
    ss = {(r.year, r.month, r.branch_id): r for r in TI.same_store(s).collect()}
    jp = [k for k in ss if k[:2] == (2011, 1)]
    assert len(jp) == 2   # Japan (this year) and France (last year's January)


def test_retention_ignores_guest(spark):
    s = star_from_raw(spark, [
        line("1", (2010, 1, 5, 1), customer_id=7.0), line("2", (2010, 2, 5, 1), customer_id=7.0),
        line("3", (2010, 1, 6, 1), customer_id=None), line("4", (2010, 2, 6, 1), customer_id=None),
        line("5", (2010, 1, 7, 1), customer_id=8.0)])
    r = {(x.year, x.month): x for x in TI.retention(s).collect()}
    assert (r[(2010, 2)].customers_prev, r[(2010, 2)].customers_retained) == (2, 1)
    assert r[(2010, 2)].retention_rate == 0.5 and r[(2010, 1)].retention_rate == 0.0


def test_evaluate_by_invoice_and_customer(spark):
    s = _star(spark)
    r = {x.invoice_no: x for x in M.evaluate(s, ("net_sales", "total_transactions"),
                                             by=("invoice_no",)).collect()}
    assert r["1"].net_sales == 25.0 and r["1"].total_transactions == 1
    c = {x.customer_id: x.active_customers
         for x in M.evaluate(s, ("active_customers",), by=("customer_id",)).collect()}
    assert c == {1: 1, 2: 1, 99999: 0}


def test_relative_date_slider(spark):
    s = _star(spark)   # calendar ends 2011-01-07
    r = M.evaluate(s, ("net_sales", "total_transactions"), where={"last_months": 12}).first()
    # window 2010-01-08 .. 2011-01-07: C2 (2010-01-09, -10), 3 (2010-02-01, 4), 4 (2011-01-07, 50)
    assert r.net_sales == 44.0 and r.total_transactions == 3
    r2 = M.evaluate(s, ("net_sales",), by=("country",), where={"last_months": 1}).collect()
    assert [(x.country, x.net_sales) for x in r2] == [("Japan", 50.0)]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_line = st.fixed_dictionaries({
    "invoice": st.sampled_from(["1", "2", "3", "C4", "C5", "6"]),
    "customer_id": st.sampled_from([1.0, 2.0, 3.0, None]),
    "quantity": st.integers(min_value=-3, max_value=5).filter(lambda q: q != 0),
    "price": st.sampled_from([0.5, 1.25, 3.0]),
    "country": st.sampled_from(["France", "Japan"]),
})


@settings(max_examples=15, deadline=None)
@given(st.lists(_line, min_size=1, max_size=25))
def test_measures_match_pandas(spark, rows):
    import pandas as pd
    s = star_from_raw(spark, [line(r["invoice"], **{k: v for k, v in r.items() if k != "invoice"})
                              for r in rows])
    got = {r.country: r for r in M.evaluate(s, M.MEASURES, by=("country",)).collect()}
    df = pd.DataFrame(rows)
    df["cust"] = df["customer_id"].fillna(99999).astype(int)
    df["lt"] = df["quantity"] * df["price"]
    df["ret"] = df["invoice"].str.startswith("C")
    for country, g in df.groupby("country"):
        r = got[country]
        gross = g.loc[~g.ret, "lt"].sum() if (~g.ret).any() else None
        returns = g.loc[g.ret, "lt"].sum() if g.ret.any() else None
        purchase = g.loc[~g.ret, "invoice"].nunique()
        customers = g.loc[g.cust != 99999, "cust"].nunique()
        net = g["lt"].sum()
        assert abs(r.net_sales - net) < 1e-9
        assert (r.gross_sales is None) == (gross is None) and (gross is None or abs(r.gross_sales - gross) < 1e-9)
        assert (r.returns_value is None) == (returns is None)
        assert r.total_transactions == g["invoice"].nunique() and r.net_transactions == purchase
        assert r.active_customers == customers
        assert abs(r.items_per_basket - (g["quantity"].sum() / purchase if purchase else 0.0)) < 1e-9
        assert abs(r.avg_clv - (net / customers if customers else 0.0)) < 1e-9
        want_rate = abs(returns) / gross if (returns is not None and gross) else 0.0
        assert abs(r.return_rate - want_rate) < 1e-9


def test_no_slicers_means_unfiltered(spark):
    s = _star(spark)
    assert G.sliced_cards(s, {}).collect() == G.sliced_cards(s).collect() == G.cards(s).collect()


def test_column_filter_on_a_dimension_attribute(spark):
    from pyspark.sql import functions as F
    s = _star(spark)
    assert M.evaluate(s, ("net_sales",), where=F.col("country") == "France").first().net_sales == 15.0


def test_open_last_month_is_compared_like_for_like(spark):
    s = star_from_raw(spark, [line("1", (2010, 12, 5, 1), price=10.0, country="France"),
                              line("2", (2010, 12, 25, 1), price=90.0, country="France"),
                              line("3", (2011, 12, 9, 1), price=20.0, country="France")])
    last = {True: None, False: None}
    for whole in last:
        last[whole] = [r for r in TI.same_store(s, whole_months=whole).collect() if (r.year, r.month) == (2011, 12)][0]
    assert (last[False].sales_ly, last[False].sssg) == (10.0, 1.0)
    assert (last[True].sales_ly, last[True].sssg) == (100.0, -0.8)
    y = [r for r in TI.ytd(s).collect() if (r.year, r.month) == (2011, 12)][0]
    assert (y.sales_ly_ytd, y.yoy_growth) == (10.0, 1.0)


def test_time_measures_under_groups_and_slicers(spark):
    s = _star(spark)
    rows = {(r.country, r.year, r.month): r for r in
            M.evaluate(s, ("net_sales", "net_sales_pm", "sales_ytd", "customers_prev"), by=("country",)).collect()}
    assert len(rows) == 2 * 13                                   # every month of the calendar for both countries
    assert rows["France", 2010, 2].net_sales_pm == 15.0 and rows["France", 2010, 2].net_sales is None
    assert rows["France", 2010, 2].customers_prev == 1 and rows["Japan", 2010, 2].customers_prev == 0
    only = M.evaluate(s, ("net_sales_pm",), where={"country": "France", "date_key": (20100201, 20100228)}).collect()
    assert [(r.year, r.month, r.net_sales_pm) for r in only] == [(2010, 2, 15.0)]


def test_column_filters_join_what_they_refer_to(spark):
    s = star_from_raw(spark, [line("1", country="France"), line("2", (2011, 3, 1, 9), country="EIRE", stock_code="country")])
    read = lambda where: M.evaluate(s, ("net_sales",), where=where)
    assert read((F.col("country") == "France") & (F.col("year") == 2010)).first().net_sales == 1.0
    assert M._where_columns(s, (F.col("country") == "France") & (F.col("year") == 2010)) == ["country", "year"]
    assert M._where_columns(s, F.col("product_code") == "country") == []            # a word in a literal
    assert read(F.lower("product_code") == "country").first().net_sales == 1.0
    assert M._where_columns(s, {"region": "UK"}) == ["region"] and M._where_columns(s, None) == []
    with pytest.raises(AnalysisException):
        read(F.col("no_such_column") == 1)
