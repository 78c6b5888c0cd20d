import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import raw_rows

from tillroll.sources import raw as RW


def test_route_sources(spark):
    rows = [dict(country="United Kingdom", invoice_date=dt.datetime(2010, 12, 31, 23)),
            dict(country="United Kingdom", invoice_date=dt.datetime(2011, 1, 1)),
            dict(country="France"), dict(country="Italy"), dict(country="Japan"),
            dict(country="USA"), dict(country=None)]
    df = RW.route_sources(raw_rows(spark, rows).drop("source_rank"), "2011-01-01")
    got = [(r.source, r.source_rank) for r in df.orderBy("line_id").collect()]
    assert got == [("uk_before_cutoff", 1), ("uk_from_cutoff", 2), ("europe_north", 3),
                   ("europe_south", 4), ("asia_pacific", 5), ("rest_of_world", 6),
                   ("rest_of_world", 6)]


def test_csv_round_trip(spark, tmp_path):
    rows = [dict(description="  spaced  ", stock_code=" x1 ", customer_id=None,
                 invoice_date=dt.datetime(2010, 1, 2, 3, 4, 5)),
            dict(description=None, price=1.25, country="Japan")]
    raw = RW.route_sources(raw_rows(spark, rows).drop("source_rank"), "2011-01-01")
    path = str(tmp_path / "extracts")
    RW.write_sources(raw, path)
    back = RW.read_sources(spark, path, sources=("uk_before_cutoff", "asia_pacific"))
    cols = ["invoice", "stock_code", "description", "quantity", "invoice_date", "price",
            "customer_id", "country", "source_rank"]
    a = sorted(tuple(r) for r in raw.select(*cols).collect())
    b = sorted(tuple(r) for r in back.select(*cols).collect())
    assert a == b


def test_missing_extract_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        RW.read_raw(spark, str(tmp_path / "nope")).count()


def test_header_strip_and_na_tokens(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text(" Invoice ,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
                 "1,A,NA,2,2010-01-01 10:00:00,NaN,,UK\n"
                 "2,B,ok,x,bad-date,1.5,12.0,UK\n")
    df = RW.read_raw(spark, str(p)).orderBy("invoice").collect()
    assert df[0].invoice == "1" and df[0].description is None and df[0].price is None
    assert df[0].customer_id is None and df[0].quantity == 2
    assert df[1].quantity is None and df[1].invoice_date is None and df[1].customer_id == 12.0


def test_union_by_name_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    out = RW.union_sources([a, b]).orderBy("a").collect()
    assert [(r.a, r.b) for r in out] == [(1, "x"), (2, None)]
    assert out[0].b == "x" and F is not None


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def test_files_with_other_column_order_fail_loudly(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,A,mug,2,2010-01-01 10:00:00,3.0,5.0,UK\n")
    (tmp_path / "b.csv").write_text("StockCode,Invoice,Description,Price,InvoiceDate,Quantity,Customer ID,Country\n"
                                    "B,2,cup,9.5,2010-01-01 10:00:00,3,5.0,UK\n")
    with pytest.raises(Exception, match="(?i)header"):
        RW.read_raw(spark, str(tmp_path)).collect()
    # read on its own, its columns go by name
    r = RW.read_raw(spark, str(tmp_path / "b.csv")).first()
    assert (r.invoice, r.stock_code, r.price, r.quantity) == ("2", "B", 9.5, 3)


def test_quoted_line_break(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text(HEADER + '1,A,"mug\nblue",2,2010-01-01 10:00:00,3.0,5.0,UK\n2,B,cup,1,2010-01-01 10:00:00,3.0,5.0,UK\n')
    rows = RW.read_raw(spark, str(p), multi_line=True).orderBy("invoice").collect()
    assert [(r.invoice, r.description, r.quantity) for r in rows] == [("1", "mug\nblue", 2), ("2", "cup", 1)]
    with pytest.raises(Exception, match="broken record"):
        RW.read_raw(spark, str(p)).collect()
    left = RW.read_raw(spark, str(p), on_broken="quarantine").collect()
    assert [r.invoice for r in left if r.invoice] == ["2"] and len(left) == 3


def test_date_layouts(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text(HEADER + "1,A,m,2,12/1/2009 8:26,3.0,5.0,UK\n2,A,m,2,2009-12-01 08:26:00,3.0,5.0,UK\n"
                          "3,A,m,2,01.12.2009 08:26,3.0,5.0,UK\n")
    when = dt.datetime(2009, 12, 1, 8, 26)
    got = {r.invoice: r.invoice_date for r in RW.read_raw(spark, str(p)).collect()}
    assert got == {"1": when, "2": when, "3": None}
    own = RW.read_raw(spark, str(p), date_formats=("dd.MM.yyyy HH:mm",)).collect()
    assert {r.invoice: r.invoice_date for r in own}["3"] == when


def test_line_ids_do_not_depend_on_the_splits(spark):
    rows = [dict(invoice=str(i % 40), stock_code=f"S{i % 7}") for i in range(300)]
    raw = raw_rows(spark, rows).drop("line_id")
    ids = [sorted((r.invoice, r.stock_code, r.line_id) for r in RW.with_line_id(raw.repartition(n)).collect()) for n in (1, 9)]
    assert ids[0] == ids[1] and len({i for *_, i in ids[0]}) == 300


def test_fixture_line_ids_do_not_depend_on_the_splits(spark):
    from helpers import SF001
    from tillroll.sources.fixtures import raw_from_driver_tables
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        sums = []
        for size in ("128k", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = raw_from_driver_tables(spark, SF001)
            sums.append(df.agg(F.count("line_id"), F.count_distinct("line_id"),
                               F.sum(F.xxhash64("line_id", "stock_code", "quantity").cast("decimal(38,0)"))).first())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sums[0] == sums[1] and sums[0][0] == sums[0][1]


def test_split_into_extracts(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(HEADER + "1,A,m,2,12/1/2009 8:26,3.0,5.0,United Kingdom\n2,A,m,2,1/5/2011 8:26,3.0,5.0,United Kingdom\n"
                          "3,A,m,2,1/5/2011 8:26,3.0,5.0,Japan\n")
    RW.split_extract(spark, str(p), str(tmp_path / "out"), "2011-01-01")
    got = RW.read_sources(spark, str(tmp_path / "out"), ("uk_before_cutoff", "uk_from_cutoff", "asia_pacific")).collect()
    assert {r.source: r.invoice for r in got} == {"uk_before_cutoff": "1", "uk_from_cutoff": "2", "asia_pacific": "3"}
