"""Stored totals: same figures as the fact under any context, and no scan of the fact where they cover it."""

import random
from dataclasses import replace

import pytest
from helpers import SF001, line, star_from_raw

import __spark_entry__ as E
from tillroll.operators import aggregates as A
from tillroll.operators import measures as M
from tillroll.operators import timeintel as TI
from tillroll.plans.warehouse import open_star

BYS = ((), ("country",), ("region", "year"), ("year", "month"), ("date_key",), ("branch_id",), ("product_code",),
       ("product_name",), ("product_code", "quarter"), ("is_weekend",), ("customer_country",), ("country", "product_code"))
WHERES = (None, {"year": 1997}, {"date_key": (19960315, 19970902)}, {"country": ["United Kingdom", "France", "USA"]}, {"region": "EUROPE", "month": [1, 12]},
          {M.RELATIVE_MONTHS: 7}, {"product_code": "P17"}, {"is_return": True}, {"day_of_week": (6, 7), "country": "Germany"}, {"customer_country": "Japan"})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_random_contexts_give_the_figures_of_the_fact(spark):
    star = open_star(spark, SF001)
    plain = replace(star, aggregates={})
    assert set(star.aggregates) == {*A.KEYS, A.SKETCHES, A.BITMAPS}
    rnd = random.Random(3)
    read = 0
    for _ in range(25):
        by, where = rnd.choice(BYS), rnd.choice(WHERES)
        measures = rnd.sample(M.MEASURES, rnd.randrange(1, 5))
        if rnd.random() < 0.6:
            measures = [m for m in measures if m not in M._CUSTOMER_MEASURES] or ["net_sales"]
        one, other = M.evaluate(star, measures, by, where), M.evaluate(plain, measures, by, where)
        assert one.dtypes == other.dtypes and rows(one) == rows(other), (measures, by, where)
        read += "fact_sales" not in files(one)
    assert read > 8


def test_months_give_the_figures_of_the_fact(spark):
    star = open_star(spark, SF001)
    plain = replace(star, aggregates={})
    for by, where in (((), None), (("country",), {"year": (1996, 1997)}), (("product_code",), {"region": "UK"}), (("region",), {M.RELATIVE_MONTHS: 15})):
        assert rows(TI.shifted(star, by, where)) == rows(TI.shifted(plain, by, where))
    for fn in (TI.retention, lambda s: M.evaluate(s, ("net_sales", "retention_rate"), by=("region",))):
        assert rows(fn(star)) == rows(fn(plain))


def files(df) -> str:
    """Names of the stored tables that a query reads."""
    return " ".join(sorted({f.rsplit("/", 3)[-2] if "sales_month=" not in f else "fact_sales" for f in df.inputFiles()}))


@pytest.mark.parametrize("key,table", [
    ("dash_cards", "agg_invoice"), ("dash_sliced", "agg_invoice"), ("dash_trend", "agg_day_branch"), ("dash_country", "agg_day_branch"),
    ("dash_region_share", "agg_day_branch"), ("dash_product_matrix", "agg_day_product"), ("m_ytd_by_region", "agg_day_branch"),
    ("m_sssg", "agg_day_branch"), ("m_core", "agg_invoice"), ("m_target", "agg_day_branch"), ("rep_sku_concentration", "agg_day_product"),
    ("weekly_series", "agg_day_branch"), ("rep_q1_dip", "agg_day_branch")])
def test_covered_queries_do_not_read_the_fact(spark, key, table):
    read = files(E.queries()[key](spark, SF001))
    assert table in read and "fact_sales" not in read


def test_customer_questions_and_column_filters_read_the_fact(spark):
    from pyspark.sql import functions as F
    star = open_star(spark, SF001)
    assert "fact_sales" in files(M.evaluate(star, ("active_customers",)))
    assert "fact_sales" in files(M.evaluate(star, ("net_sales",), where=F.col("quantity") > 3))
    assert "fact_sales" in files(M.evaluate(star, ("net_sales",), where={"quantity": 3}))


def test_aggregates_keep_every_total(spark):
    star = star_from_raw(spark, [line("1", quantity=2, price=1.5), line("1", stock_code="B", quantity=3, price=2.0), line("C2", quantity=-1, price=1.5),
                                 line("1", (2010, 11, 16, 9), quantity=5, price=0.1), line("1", country="France")])
    for name, keys in A.KEYS.items():
        agg = A.aggregate(star.fact, name)
        assert agg.select(*keys).distinct().count() == agg.count()
        totals = "sum(line_total)", "sum(quantity)"
        assert tuple(agg.selectExpr(*totals).first()) == tuple(star.fact.selectExpr(*totals).first())
    from_invoices = A.aggregate(A.aggregate(star.fact, "agg_invoice"), "agg_day_branch")
    assert rows(from_invoices) == rows(A.aggregate(star.fact, "agg_day_branch"))
    covered = A.covering(replace(star, aggregates={"agg_invoice": A.aggregate(star.fact, "agg_invoice")}), ["invoice_no"], {})
    assert "product_code" not in covered.fact.columns
    # an invoice over two days and two branches counts once in the whole, and once in each
    stored = replace(star, aggregates={n: A.aggregate(star.fact, n) for n in A.KEYS})
    assert M.evaluate(stored, ("total_transactions",)).first()[0] == 2
    assert rows(M.evaluate(stored, ("total_transactions",), by=("country",))) == rows(M.evaluate(star, ("total_transactions",), by=("country",)))


@pytest.mark.parametrize("by,where", [((), None), (("country",), None), (("region",), {"country": ["United Kingdom", "France", "USA"]}),
                                      (("branch_id",), {"year": (1994, 1996)}), ((), {M.RELATIVE_MONTHS: 9})])
def test_retention_by_bitmaps_equals_retention_by_rows(spark, by, where):
    star = open_star(spark, SF001)
    one, other = TI.retention(star, by, where), TI.retention(replace(star, aggregates={}), by, where)
    assert one.dtypes == other.dtypes and rows(one) == rows(other)
    assert "bitmap_customers" in files(one) and "fact_sales" not in files(one)


def test_retention_of_products_reads_the_fact(spark):
    assert "fact_sales" in files(TI.retention(open_star(spark, SF001), where={"product_code": "SKU-17"}))


def test_bitmaps_over_several_buckets(spark):
    ids = [1, 32767, 32768, 32769, 65537, 70000]
    star = star_from_raw(spark, [line(f"{m}{c}", (2010, m, 3, 9), customer_id=float(c), country="France" if c % 2 else "EIRE")
                                 for m in (1, 2, 3, 5) for c in ids if (c + m) % 4])
    stored = replace(star, aggregates={A.BITMAPS: A.customer_bitmaps(star.fact)})
    assert stored.aggregates[A.BITMAPS].select("bucket").distinct().count() == 3
    for by in ((), ("country",)):
        assert rows(TI.retention(stored, by)) == rows(TI.retention(star, by))
    assert not A.dense_customers(star_from_raw(spark, [line("1", customer_id=1.0), line("2", customer_id=2e9)]).fact)
    assert A.dense_customers(star.fact) and A.dense_customers(star.fact.limit(0))


def test_sketches_count_customers_within_their_error(spark):
    star = open_star(spark, SF001)
    for by, where in (((), None), (("country",), None), (("year", "month"), {"region": "EUROPE"}), (("quarter",), {M.RELATIVE_MONTHS: 30})):
        near, exact = M.approx_customers(star, by, where), M.evaluate(star, ("active_customers",), by, where)
        assert near.dtypes == exact.dtypes and "fact_sales" not in files(near)
        key = list(range(len(by)))
        wanted = {tuple(r[i] for i in key): r.active_customers for r in exact.collect()}
        found = {tuple(r[i] for i in key): r.active_customers for r in near.collect()}
        for group, n in wanted.items():
            assert abs(found.get(group, 0) - n) <= max(1, 0.05 * n)
    from pyspark.sql import functions as F
    assert rows(M.approx_customers(star, where=F.col("quantity") > 0)) and "fact_sales" in files(M.approx_customers(star, by=("product_code",)))
    big = spark.range(200_000).selectExpr("CAST(id % 50000 + 1 AS int) AS customer_id", "CAST(20100101 + id % 28 AS int) AS date_key", "1 AS branch_id")
    parts = replace(star, aggregates={A.SKETCHES: A.customer_sketches(big)})
    assert abs(M.approx_customers(parts).first()[0] - 50_000) < 0.04 * 50_000
    assert M.approx_customers(replace(star, fact=star.fact.limit(0), aggregates={}), by=("country",)).collect() == []
