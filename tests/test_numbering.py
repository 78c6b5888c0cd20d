"""Numbers and running sums by ranges against windows over the whole."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from helpers import line, star_from_raw
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.operators import audit, report
from tillroll.operators import numbering as N


def plain(rows):
    """Row number of each (key, key, id) within its keys, by id."""
    seen, out = defaultdict(int), []
    for a, b, i in sorted(rows, key=lambda r: r[2]):
        seen[a, b] += 1
        out.append((a, b, i, seen[a, b]))
    return Counter(out)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None])), max_size=60))
def test_numbers_within_keys(spark, keys):
    rows = [(a, b, i) for i, (a, b) in enumerate(keys)]
    df = spark.createDataFrame(rows, "a string, b int, id long").repartition(3)
    assert Counter(map(tuple, N.number_rows(df, ["a", "b"], [F.col("id")]).collect())) == plain(rows)


def test_a_hot_key_is_numbered_in_many_ranges(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 500}", None, i) for i in random.Random(1).sample(range(30_000), 12_000)]
    df = spark.createDataFrame(rows, "a string, b int, id long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")          # so few rows would be one range
    try:
        _hot_ranges(df, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _hot_ranges(df, rows):
    laid = N._in_ranges(df, [F.col("a"), F.col("b"), F.col("id")]).groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == "hot").alias("hot")).collect()
    mean = len(rows) / len(laid)
    assert len(laid) >= 4 and max(r.n for r in laid) <= 2 * mean and sum(r.hot > 0 for r in laid) >= 2
    assert Counter(map(tuple, N.number_rows(df, ["a", "b"], [F.col("id")]).collect())) == plain(rows)


def test_running_sums_and_ranks(spark):
    rnd = random.Random(2)
    rows = [(f"p{i}", rnd.choice([None, Decimal("1.50"), Decimal("-2.25"), Decimal(rnd.randrange(900))])) for i in range(700)]
    df = spark.createDataFrame(rows, "code string, net decimal(12,2)")
    got = {r.code: (r["rank"], r.running, r.total) for r in N.running(df, [F.col("net").desc_nulls_last(), F.col("code").asc()], "net").collect()}
    at, run = 0, Decimal(0)
    total = sum(v for _, v in rows if v is not None)
    for code, v in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])):
        at, run = at + 1, run + (v or 0)
        assert got[code] == (at, run, total)
    assert N.running(df.limit(0), [F.col("code")], "net").collect() == [] and N.number_rows(df.limit(0), ["code"], [F.col("net")]).collect() == []


def test_duplicate_rows_are_named(spark):
    same = dict(invoice="7", stock_code="A", quantity=2, price=1.0)
    star = star_from_raw(spark, [line(**same), line("8"), line(**same), line("7", stock_code="A", quantity=3), line(**same)])
    got = audit.audit_duplicate_rows(star.fact).collect()
    ids = sorted(r.sales_id for r in star.fact.where("invoice_no = '7' AND quantity = 2").collect())
    assert sorted((r.sales_id, r.row_num) for r in got) == [(ids[1], 2), (ids[2], 3)]
    left = star.fact.join(audit.audit_duplicate_rows(star.fact), "sales_id", "left_anti")
    assert audit.audit_duplicates(left).count() == 0 and left.count() == 3
    # the same numbers as the listing without ids
    pick = lambda df: sorted(tuple(r) for r in df.select("invoice_no", "product_code", "row_num").collect())
    assert pick(audit.audit_duplicate_rows(star.fact)) == pick(audit.audit_duplicates(star.fact))
    assert audit.audit_duplicate_rows(star.fact.limit(0)).collect() == []


@pytest.mark.parametrize("top", [1, 3, 20])
def test_curve_gives_the_concentration_at_its_rank(spark, top):
    rnd = random.Random(top)
    star = star_from_raw(spark, [line(str(i), stock_code=f"S{rnd.randrange(25)}", quantity=rnd.randrange(1, 9), price=float(rnd.randrange(1, 9))) for i in range(120)])
    curve = {r["rank"]: r.cumulative_pct for r in report.concentration_curve(star).collect()}
    assert sorted(curve) == list(range(1, len(curve) + 1)) and curve[len(curve)] == 100.0
    assert curve[min(top, len(curve))] == report.sku_concentration(star, top_n=top).first().share_pct
