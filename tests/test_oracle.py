"""Every registered query equals its DuckDB oracle on the sf0.01 driver tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

from helpers import SF001

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF001}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    res = duck.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())


def test_every_query_has_an_oracle():
    """Of this library's own operators, but for the figures of a numeric search (``test_smoothing``
    holds that against brute force); what else is registered may be beyond SQL."""
    from tillroll.plans.registry import QUERIES
    searched = {"forecast_eval_optimised", "forecast_future_optimised"}
    assert set(QUERIES) - searched <= set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("key,figures", [("forecast_eval_optimised", 1), ("forecast_future_optimised", 13)])
def test_searched_forecasts_cover_the_series_of_the_grid(spark, key, figures):
    got = E.queries()[key](spark, SF001).collect()
    grid = E.queries()[key.removesuffix("_optimised")](spark, SF001).collect()
    assert sorted(r.series_key for r in got) == sorted(r.series_key for r in grid)
    value = "mae" if "mae" in got[0].asDict() else "yhat"
    assert {r.series_key for r in got if r[value] is not None} == {r.series_key for r in grid if r[value] is not None}
    assert all(r[value] >= 0 or value == "yhat" for r in got if r[value] is not None) and len([r for r in got if r.series_key == "ALL"]) == figures


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1 and "net_sales_gbp" in df.columns


def test_fixture_anchor_values(spark):
    """Values of the sf0.01 mapping (FIXTURES.md §3), found by a separate SQL statement over the five tables."""
    k = E.queries()["kpi_totals"](spark, SF001).first()
    assert (k.gross_sales_gbp, k.returns_gbp, k.net_sales_gbp, k.return_rate_pct) == \
        (1370157360.60, -69216177.70, 1300941182.90, 5.05)
    a = E.queries()["aov_basket"](spark, SF001).first()
    assert (a.total_orders, a.average_order_value_gbp) == (14646, 93551.64)
    rep = E.queries()["clean_report"](spark, SF001).first()
    assert rep.rows_out == 59314
    g = E.queries()["audit_guest"](spark, SF001).first()
    assert g.transaction_count == 14754
