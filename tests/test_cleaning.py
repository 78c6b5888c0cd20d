import math
from decimal import Decimal

from helpers import raw_rows

from tillroll.functions.text import pystrip
from tillroll.operators import clean as C


def _clean(spark, rows):
    out = C.clean_lines(raw_rows(spark, rows)).orderBy("line_id").collect()
    return out


def test_description_strip_and_fill(spark):
    r = _clean(spark, [dict(description="\t MUG  "), dict(description=None),
                       dict(description="   "), dict(description=" cup \x1c")])
    assert [x.description for x in r] == ["MUG", "UNKNOWN PRODUCT", "", "cup"]


def test_pystrip_keeps_inner_whitespace(spark):
    df = spark.createDataFrame([(" a \t b ",)], "s string")
    assert df.select(pystrip("s").alias("s")).first().s == "a \t b"


def test_stock_code(spark):
    r = _clean(spark, [dict(stock_code=" 85123a "), dict(stock_code=None)])
    assert [x.stock_code for x in r] == ["85123A", "UNKNOWN"]


def test_customer_guest(spark):
    r = _clean(spark, [dict(customer_id=None), dict(customer_id=math.nan), dict(customer_id=17850.0)])
    assert [x.customer_id for x in r] == [99999, 99999, 17850]


def test_price_filter(spark):
    r = _clean(spark, [dict(price=0.0), dict(price=-1.0), dict(price=None), dict(price=math.nan),
                       dict(price=2.5)])
    assert [x.status for x in r] == ["dropped_price"] * 4 + ["clean"]


def test_quantity_rules(spark):
    r = _clean(spark, [dict(quantity=0), dict(quantity=None), dict(quantity=-3)])
    assert [x.status for x in r] == ["dropped_quantity", "quarantined", "clean"]


def test_is_return(spark):
    r = _clean(spark, [dict(invoice="C1"), dict(invoice="c1"), dict(invoice=" C1"), dict(invoice=None)])
    assert [x.is_return for x in r][:3] == [True, False, False]
    assert r[3].status == "quarantined"


def test_line_total_decimal(spark):
    r = _clean(spark, [dict(quantity=6, price=2.55), dict(quantity=-2, price=0.125)])
    assert r[0].line_total == Decimal("15.30")
    assert r[0].price == Decimal("2.55")
    assert r[1].price == Decimal("0.13") and r[1].line_total == Decimal("-0.26")


def test_quarantine_missing_date_and_country(spark):
    r = _clean(spark, [dict(invoice_date=None), dict(country=None)])
    assert [x.status for x in r] == ["quarantined", "quarantined"]


def test_report_reconciles(spark):
    rows = [dict(price=0.0), dict(quantity=0), dict(quantity=None), {}, {}]
    lines = C.clean_lines(raw_rows(spark, rows))
    rep = C.clean_report(lines).first()
    assert (rep.rows_in, rep.quarantined, rep.dropped_price, rep.dropped_quantity, rep.rows_out) == \
        (5, 1, 1, 1, 2)
    assert rep.rows_in == rep.quarantined + rep.dropped_price + rep.dropped_quantity + rep.rows_out
