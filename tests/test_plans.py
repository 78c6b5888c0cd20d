"""Plan checks: pushdown, pruning, broadcast of bounded dims, no Python in the hot path."""

from dataclasses import replace

from helpers import SF001

import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_slicer_date_filter_reaches_scan(spark):
    plan = _formatted(E.queries()["dash_sliced"](spark, SF001))
    assert "PushedFilters" in plan and "date_key" in plan.split("PushedFilters")[1].split("\n")[0]


def test_kpi_scan_prunes_columns(spark):
    plan = _formatted(E.queries()["kpi_totals"](spark, SF001))
    schema_lines = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert schema_lines and all("invoice_no" not in ln for ln in schema_lines)
    assert "line_total" in schema_lines[0] and "is_return" in schema_lines[0]


def test_star_view_broadcasts_bounded_dims(spark):
    plan = _formatted(E.queries()["star_view"](spark, SF001))
    assert "BroadcastHashJoin" in plan


def test_no_python_udf_outside_forecasting(spark):
    q = E.queries()
    for key in ("kpi_totals", "m_core", "clean_flat", "dim_products", "m_retention", "dash_price_qty"):
        plan = _formatted(q[key](spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key
        assert "FlatMapGroupsInPandas" not in plan, key


def test_top_products_uses_group_limit(spark):
    plan = _formatted(E.queries()["top_products"](spark, SF001))
    assert "WindowGroupLimit" in plan


def test_year_slicer_reaches_fact_scan(spark):
    from tillroll.operators.measures import evaluate
    from tillroll.plans.warehouse import open_star
    s = open_star(spark, SF001)
    for star, stored in ((s, "agg_invoice"), (replace(s, aggregates={}), "fact_sales")):
        df = evaluate(star, ("net_sales", "total_transactions"), by=("month",), where={"year": 1997})
        scan = [b for b in _formatted(df).split("\n\n") if stored in b and "PushedFilters" in b]
        assert scan and "19970101" in scan[0] and "19971231" in scan[0]
    # same numbers as slicing through the calendar alone
    from pyspark.sql import functions as F
    ref = (s.fact.join(s.dim_date, "date_key").where(F.col("year") == 1997).groupBy("month")
           .agg(F.sum("line_total").cast("double").alias("net")))
    assert sorted((r.month, r.net_sales) for r in df.collect()) == sorted(tuple(r) for r in ref.collect())


def test_forecast_fits_keep_explicit_series_partitioning(spark):
    from tillroll.operators import forecast as I
    from tillroll.operators import smoothing as S
    from tillroll.plans.warehouse import open_star
    plan = _formatted(I.fit(I.gap_fill(I.weekly_series(open_star(spark, SF001))), I.VALIDATION_SEASON))
    assert "REPARTITION_BY_NUM" in plan and "FlatMapGroupsInPandas" in plan
    plan = _formatted(S.fit(I.gap_fill(I.weekly_series(open_star(spark, SF001))), I.VALIDATION_SEASON))
    assert "REPARTITION_BY_NUM" in plan and "MapInArrow" in plan


def test_scores_and_projections_read_one_fit(spark):
    for key in ("hw_grid", "hw_annual", "forecast_eval", "forecast_future"):
        assert "FlatMapGroupsInPandas" not in _formatted(E.queries()[key](spark, SF001)), key


def test_month_slicer_reads_its_months_only(spark):
    from tillroll.operators.measures import evaluate
    from tillroll.plans.warehouse import open_star
    star = replace(open_star(spark, SF001), aggregates={})
    df = evaluate(star, ("net_sales",), where={"date_key": (19970301, 19970331)})
    scan = [b for b in _formatted(df).split("\n\n") if "fact_sales" in b and "PartitionFilters" in b]
    line = next(ln for ln in scan[0].splitlines() if ln.startswith("PartitionFilters"))
    assert "sales_month" in line and "199703" in line
    files = evaluate(star, ("net_sales",), by=("date_key",), where={"date_key": (19970301, 19970331)})
    assert {r.date_key // 100 for r in files.collect()} == {199703}


def test_distinct_counts_do_not_expand(spark):
    for key in ("m_core", "m_customers", "dash_cards"):
        assert "Expand" not in _formatted(E.queries()[key](spark, SF001)), key


def test_dimensions_do_not_sort_the_lines(spark):
    from tillroll.operators import dims as D
    from tillroll.plans.warehouse import open_star
    clean = open_star(spark, SF001).clean
    for df in (D.dim_customers(clean), D.dim_branches(clean)):
        tree = _formatted(df).split("\n\n")[0].splitlines()
        partial = tree[max(i for i, ln in enumerate(tree) if "Exchange" in ln) + 1:]     # below the first shuffle
        assert any("HashAggregate" in ln for ln in partial) and not any("SortAggregate" in ln for ln in partial), partial


def test_key_audit_shuffles_the_key_only(spark):
    plan = _formatted(E.queries()["audit_constraints"](spark, SF001))
    reads = [ln for b in plan.split("\n\n") if "fact_sales" in b for ln in b.splitlines() if ln.startswith("ReadSchema")]
    assert any(ln.startswith("ReadSchema: struct<sales_id:bigint>") for ln in reads), reads


def test_fact_build_from_clean_lines_is_narrow(spark):
    from tillroll.operators.fact import fact_sales
    from tillroll.plans.warehouse import open_star
    s = open_star(spark, SF001)
    plan = _formatted(fact_sales(s.clean, s.dim_branches).sortWithinPartitions("date_key"))
    tree = plan.split("\n\n")[0]
    shuffles = [ln for ln in tree.splitlines() if "Exchange" in ln and "BroadcastExchange" not in ln]
    assert not shuffles, shuffles


def test_retention_has_no_self_join(spark):
    plan = _formatted(E.queries()["m_retention"](spark, SF001))
    assert "SortMergeJoin" not in plan and "Window" in plan


def test_guest_rows_spread_before_the_customer_join(spark):
    """With the broadcast switched off, no task of the join gets the guest's quarter of the rows."""
    from pyspark.sql import functions as F
    from tillroll.operators.fact import with_customer_country
    from tillroll.plans.warehouse import open_star
    s = open_star(spark, SF001)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "false", "40")):
            spark.conf.set(k, v)
        df = with_customer_country(s.fact, s.dim_customers)
        sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert "SortMergeJoin" in _formatted(df)
        assert sizes[-1] < 0.1 * sum(sizes)
        plain = s.fact.join(s.dim_customers.select("customer_id", F.col("country").alias("customer_country")), "customer_id", "left")
        count = lambda d: sorted(map(tuple, d.groupBy("customer_country").count().collect()))
        assert count(df) == count(plain)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
