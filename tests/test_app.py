"""End-to-end application flow from CSV extracts, SQL views and forecast export."""

from pyspark.sql import functions as F

from helpers import SF001

import __spark_entry__ as E
from tillroll.operators import business
from tillroll.plans.app import register_views, run_etl, run_forecast
from tillroll.plans.warehouse import open_extracts


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_etl_from_extracts_equals_fixture_star(spark, tmp_path):
    star = run_etl(spark, open_extracts(spark, SF001), str(tmp_path / "wh"))
    assert _rows(business.kpi_totals(star.fact)) == _rows(E.queries()["kpi_totals"](spark, SF001))
    assert _rows(star.dim_branches) == _rows(E.queries()["dim_branches"](spark, SF001))
    assert _rows(star.dim_products) == _rows(E.queries()["dim_products"](spark, SF001))

    register_views(spark, star, prefix="t_")
    sql = spark.sql("""
        SELECT CAST(SUM(CASE WHEN NOT is_return THEN line_total ELSE 0 END) AS DOUBLE) AS gross,
               COUNT(DISTINCT invoice_no) AS orders
        FROM t_fact_sales f JOIN t_dim_date d ON f.date_key = d.date_key""").first()
    k = E.queries()["kpi_totals"](spark, SF001).first()
    assert sql.gross == k.gross_sales_gbp
    assert sql.orders == star.fact.select("invoice_no").distinct().count()

    out = run_forecast(star, str(tmp_path / "reports"), per_country=False)
    proj = spark.read.option("header", "true").csv(out["projections"])
    assert proj.count() == 13 and proj.where(F.col("series_key") != "ALL").count() == 0
    grid = run_forecast(star, str(tmp_path / "grid"), fmt="parquet", per_country=False, method="grid")
    pair = [spark.read.parquet(grid["fits"]).first(), spark.read.option("header", "true").csv(out["fits"]).first()]
    assert [p.status for p in pair] == ["fitted"] * 2 and pair[0].n == int(pair[1].n)
    assert 0.1 <= pair[0].alpha <= 0.9 and 0 < float(pair[1].alpha) < 1
