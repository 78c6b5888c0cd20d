import datetime as dt

from helpers import line, star_from_raw

from tillroll.operators import audit as D
from tillroll.operators import business as E
from tillroll.operators import dims as DM


def test_dim_customers_latest_with_tiebreak(spark):
    t = (2010, 12, 1, 9)
    s = star_from_raw(spark, [
        line("100", (2010, 11, 1, 9), customer_id=5.0, country="France"),
        line("101", t, customer_id=5.0, country="Germany"),
        line("102", t, customer_id=5.0, country="EIRE"),      # same time, larger invoice wins
        line("200", t, customer_id=6.0, country="Spain"),
        line("200", t, customer_id=6.0, country="Italy"),     # same time and invoice: larger country
    ])
    got = {r.customer_id: r.country for r in s.dim_customers.collect()}
    assert got == {5: "EIRE", 6: "Spain"}


def test_dim_products_mode_tie_smallest(spark):
    s = star_from_raw(spark, [dict(stock_code="P", description=d) for d in ("b", "a", "b", "a", "c")]
                      + [dict(stock_code="Q", description="z")])
    got = {r.product_code: r.product_name for r in s.dim_products.collect()}
    assert got == {"P": "a", "Q": "z"}


def test_dim_branches_names_and_order(spark):
    s = star_from_raw(spark, [
        dict(country="Hong Kong", source_rank=5), dict(country="United Kingdom", source_rank=2),
        dict(country="United Kingdom", source_rank=1, invoice_date=dt.datetime(2011, 5, 1)),
        dict(country="Brazil", source_rank=6), dict(country="Germany", source_rank=3)])
    rows = sorted((r.branch_id, r.branch_name, r.region) for r in s.dim_branches.collect())
    assert rows == [(1, "Branch_UK_United_Kingdom", "UK"), (2, "Branch_EUROPE_Germany", "EUROPE"),
                    (3, "Branch_ASIA_PAC_Hong_Kong", "ASIA_PAC"),
                    (4, "Branch_REST_OF_WORLD_Brazil", "REST_OF_WORLD")]


def test_dim_date_row(spark):
    s = star_from_raw(spark, [line(when=(2010, 11, 14, 8)), line(when=(2010, 11, 16, 23))])
    rows = {r.date_key: r for r in s.dim_date.collect()}
    assert sorted(rows) == [20101114, 20101115, 20101116]
    r = rows[20101115]
    assert (r.date, r.year, r.quarter, r.month, r.day, r.day_of_week, r.is_weekend) == \
        (dt.date(2010, 11, 15), 2010, 4, 11, 15, 1, 0)
    assert rows[20101114].day_of_week == 7 and rows[20101114].is_weekend == 1


def test_fact_columns(spark):
    s = star_from_raw(spark, [line("C7", (2010, 11, 15, 18, 5, 9), quantity=-2, price=3.0)])
    f = s.fact.first()
    assert (f.invoice_no, f.date_key, f.transaction_time, f.is_return, float(f.line_total)) == \
        ("C7", 20101115, "18:05:09", True, -6.0)


def test_dedupe_first_row_wins(spark):
    df = spark.createDataFrame([("A", "second", 2), ("A", "first", 1), ("B", "only", 5)],
                               "product_code string, product_name string, ord int")
    from pyspark.sql import functions as F
    out = DM.dedupe_dim(df, "product_code", [F.col("ord")])
    assert {r.product_code: r.product_name for r in out.collect()} == {"A": "first", "B": "only"}


def test_audit_duplicates_row_numbers(spark):
    s = star_from_raw(spark, [line("9")] * 3 + [line("8")])
    got = sorted(r.row_num for r in D.audit_duplicates(s.fact).collect())
    assert got == [2, 3]
    # the cut at limit+1 keeps the ordered listing exact
    s2 = star_from_raw(spark, [line("9")] * 6)
    assert [r.row_num for r in D.audit_duplicates(s2.fact, limit=3).collect()] == [2, 3, 4]


def test_audit_sign_and_orphans(spark):
    s = star_from_raw(spark, [line("5", quantity=-5), line("C6", quantity=-1), line("7")])
    assert [(r.invoice_no, r.quantity) for r in D.audit_sign(s.fact).collect()] == [("5", -5)]
    # a product code without a dimension row
    s.dim_products = s.dim_products.where("product_code != 'A1'")
    ri = D.audit_referential(s).first()
    assert ri.total_fact_rows == 3 and ri.matching_products == 0 and ri.matching_customers == 3
    orphans = {r.dimension: r.orphan_rows for r in D.audit_orphans(s).collect()}
    assert orphans == {"customers": 0, "products": 3, "branches": 0, "dates": 0}
    cons = {(r.table_name, r.rule): r.violations for r in D.audit_constraints(s).collect()}
    assert cons[("fact_sales", "foreign_key:products")] == 3
    assert cons[("dim_branches", "unique:country")] == 0


def test_kpis_only_returns(spark):
    s = star_from_raw(spark, [line("C1", quantity=-2)])
    k = E.kpi_totals(s.fact).first()
    assert k.gross_sales_gbp == 0.0 and k.returns_gbp == -2.0 and k.return_rate_pct is None
    from tillroll.operators.measures import evaluate
    assert evaluate(s, ("return_rate",)).first().return_rate == 0.0


def test_mom_growth_skips_missing_month(spark):
    s = star_from_raw(spark, [line(when=(2010, 1, 5, 1), price=10.0),
                              line(when=(2010, 3, 5, 1), price=20.0)])
    rows = E.mom_growth(s.fact, s.dim_date).collect()
    assert [(r.month, r.prev_month_sales_gbp, r.mom_growth_pct) for r in rows] == [(3, 10.0, 100.0)]
    from tillroll.operators.timeintel import prev_month
    pm = {r.month: r for r in prev_month(s).collect()}
    assert pm[3].net_sales_pm is None and pm[3].mom_growth == 0.0
    assert pm[2].net_sales is None and pm[2].mom_growth == -1.0


def test_top_products_ties(spark):
    rows = [dict(stock_code=f"P{i:02d}", price=float(100 - i)) for i in range(10)]
    rows.append(dict(stock_code="P99", price=91.0))   # ties with rank 10
    s = star_from_raw(spark, rows)
    got = E.top_products(s.fact, s.dim_products, 10).collect()
    assert len(got) == 11 and max(r.sales_rank for r in got) == 10


def test_customer_segments(spark):
    rows = []
    for cust, n in ((1, 1), (2, 2), (3, 5), (4, 6), (5, 15), (6, 16)):
        rows += [line(f"{cust}-{k}", customer_id=float(cust)) for k in range(n)]
    rows.append(line("g", customer_id=None))
    s = star_from_raw(spark, rows)
    got = {r.customer_segment[0]: r.customer_count for r in E.customer_segments(s.fact).collect()}
    assert got == {"1": 1, "2": 2, "3": 2, "4": 1}


def test_branch_share_sums_to_100(spark):
    s = star_from_raw(spark, [dict(country=c, price=p) for c, p in
                              (("France", 1.0), ("Japan", 2.0), ("USA", 3.0))])
    shares = [r.market_share_pct for r in E.branch_share(s.fact, s.dim_branches).collect()]
    assert abs(sum(shares) - 100.0) < 0.05


def test_audit_duplicates_chunked_listing(spark):
    s = star_from_raw(spark, [line("9")] * 7 + [line("8")] * 2)
    got = sorted((r.invoice_no, r.row_num) for r in
                 D.audit_duplicates(s.fact, keys=("invoice_no",), limit=None, chunk=2).collect())
    assert got == [("8", 2)] + [("9", k) for k in range(2, 8)]


def test_queries_on_an_empty_star(spark):
    from tillroll.operators import dashboard as G
    from tillroll.operators import forecast as I
    from tillroll.operators import measures as M
    from tillroll.operators import timeintel as TI
    s = star_from_raw(spark, [dict(price=0.0), dict(quantity=None)])
    assert s.fact.count() == 0 and s.dim_date.count() == 0
    k = E.kpi_totals(s.fact).collect()
    assert len(k) == 1 and k[0].net_sales_gbp is None and k[0].return_rate_pct is None
    assert E.mom_growth(s.fact, s.dim_date).count() == 0
    assert E.top_products(s.fact, s.dim_products).count() == 0
    assert D.audit_guest(s.fact).count() == 0
    assert D.audit_referential(s).first().total_fact_rows == 0
    assert M.evaluate(s, M.MEASURES).count() == 1
    assert TI.retention(s).count() == 0 and G.price_quantity(s).count() == 0
    assert I.fit(I.gap_fill(I.weekly_series(s)), 13).count() == 0
