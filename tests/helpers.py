"""Micro-row builders for unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from tillroll.operators import clean as C
from tillroll.operators import dims as D
from tillroll.operators.fact import fact_sales
from tillroll.plans.warehouse import Star
from tillroll.schemas import RAW

SF001 = "/root/testdata/sf0.01"

_DEFAULT = dict(invoice="1000", stock_code="A1", description="Mug", quantity=1,
                invoice_date=dt.datetime(2010, 11, 15, 10, 0), price=1.0, customer_id=1.0,
                country="United Kingdom", source_rank=1)


def raw_rows(spark, rows):
    """rows: list of dicts overriding the defaults; returns a typed raw frame with line ids."""
    data = []
    for i, r in enumerate(rows):
        v = {**_DEFAULT, **r}
        data.append(tuple(v[f.name] for f in RAW.fields) + (i,))
    schema = T.StructType(list(RAW.fields) + [T.StructField("line_id", T.LongType())])
    return spark.createDataFrame(data, schema)


def star_from_raw(spark, rows) -> Star:
    lines = C.clean_lines(raw_rows(spark, rows))
    clean = C.clean_only(lines)
    branches = D.dim_branches(clean)
    return Star(base="", lines=lines, clean=clean, dim_date=D.dim_date(clean),
                dim_customers=D.dim_customers(clean), dim_products=D.dim_products(clean),
                dim_branches=branches, fact=fact_sales(clean, branches), sf_dir="")


def line(invoice="1000", when=(2010, 11, 15, 10), **kw):
    return dict(invoice=invoice, invoice_date=dt.datetime(*when), **kw)
