"""What a task holds, what is shuffled and what is built does not grow beyond what a query needs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll import session
from tillroll.operators import aggregates as A
from tillroll.plans import registry
from tillroll.plans.warehouse import _current, _key_dir
from tillroll.sources.fixtures import raw_from_driver_tables


@pytest.fixture
def tables(spark, tmp_path):
    """Forty orders of three lines each, as driver tables."""
    day = dt.datetime(1996, 1, 1)
    rows = {
        "lineitem": ([(o, o % 7 + 1, n, float(n + o % 5), "R" if o % 9 == 0 else "N") for o in range(1, 41) for n in (1, 2, 3)],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string"),
        "orders": ([(o, o % 6 + 1, day + dt.timedelta(days=3 * o)) for o in range(1, 41)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "part": ([(p, f"part {p % 3}", 900.0 + p) for p in range(1, 8)], "p_partkey long, p_name string, p_retailprice double"),
        "customer": ([(c, c % 3) for c in range(1, 7)], "c_custkey long, c_nationkey int"),
        "nation": ([(n, f"NATION_{n}") for n in range(3)], "n_nationkey int, n_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_tasks_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [session.tasks_for(spark, n) for n in (0, 1, session.ROWS_LEAST)] == [1, 1, 1]
    assert session.tasks_for(spark, 2 * session.ROWS_LEAST) == min(2, cores)
    assert session.tasks_for(spark, 1000 * session.ROWS_MOST + 1) == 1001


def test_lines_are_dealt_by_their_number(spark, tables, monkeypatch):
    want = {tuple(r) for r in raw_from_driver_tables(spark, tables).collect()}
    monkeypatch.setattr(session, "ROWS_MOST", 10)
    raw = raw_from_driver_tables(spark, tables)
    assert "hashpartitioning(l_orderkey" in _plan(raw) and ", 12), REPARTITION_BY_NUM" in _plan(raw)
    assert {tuple(r) for r in raw.collect()} == want and len(want) == 120
    # nor do they meet in fewer tasks where the parts are too big to broadcast
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = raw_from_driver_tables(spark, tables)
        shuffles = [ln for ln in _plan(raw).splitlines() if "hashpartitioning(l_orderkey" in ln or "hashpartitioning(l_partkey" in ln]
        assert shuffles and all(", 12)" in ln for ln in shuffles), shuffles
        assert {tuple(r) for r in raw.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_totals_are_shuffled_once(spark):
    fact = spark.range(3000).select(
        (F.lit(19960101) + F.col("id") % 28).cast("int").alias("date_key"), (F.col("id") % 3).cast("int").alias("branch_id"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 40).cast("string")).alias("invoice_no"), (F.col("id") % 17).cast("string").alias("product_code"),
        (F.col("id") % 5 == 0).alias("is_return"), F.lit("1.25").cast("decimal(12,2)").alias("line_total"), F.lit(2).alias("quantity"))
    for name in ("agg_invoice", "agg_day_product"):
        made, plain = A.aggregate_in_ranges(fact, name, 5), A.aggregate(fact, name)
        tree = _plan(made).split("\n\n")[0]
        assert tree.count("Exchange") == 1 and "rangepartitioning" in _plan(made), tree
        assert made.dtypes == plain.dtypes
        assert made.exceptAll(plain).count() == plain.exceptAll(made).count() == 0 < made.count()


def test_dimensions_and_loads_do_not_build_the_fact(spark, tables, monkeypatch):
    assert E.queries()["dim_products"](spark, tables).count() == 7
    key = _key_dir(spark, tables)
    assert _current(spark, key, "dims") and _current(spark, key, "lines") and _current(spark, key, "star") is None

    class Seen(Exception):
        pass

    def load(spark, path, lines, mode):
        assert lines.count() == 120
        raise Seen

    monkeypatch.setattr(registry, "SPLIT_YEAR", 2000)
    monkeypatch.setattr(registry.P, "load", load)
    for name in ("load_fact", "load_customers"):
        with pytest.raises(Seen):
            E.queries()[name](spark, tables)
    assert _current(spark, key, "star") is None
