"""Driver tables (TPC-H-like parquet) → raw retail transaction lines.

The mapping is fixed by FIXTURES.md §3: lineitem ⋈ orders ⋈ part ⋈ customer ⋈
nation, with deliberate defects (returns, blank/odd descriptions, zero prices,
missing customers) so the cleaning rules are exercised.  All joins are
equi-joins on the TPC-H keys; Catalyst plans the small sides as broadcasts when
their size estimate allows and prunes every scan to the columns used here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import tasks_for
from .raw import route_sources

# Country names assigned to nation keys 0..18 (FIXTURES.md §3),
# in key order.  Other nations keep their own name.
COUNTRY_BY_NATION_KEY = (
    "United Kingdom", "EIRE", "Germany", "Netherlands", "France", "Spain",
    "Portugal", "Switzerland", "Belgium", "Italy", "Australia", "Japan",
    "Singapore", "Hong Kong", "USA", "Canada", "Channel Islands", "Cyprus",
    "Israel",
)

# Fixed values of the injected faults (FIXTURES.md §3).
LATE_NATION, LATE_FROM = 18, "2001-05-01 00:00:00"     # a country whose series is too short to fit
LONG_NAME = 260                                        # characters added to a name beyond its column's length
LINES_PER_ORDER = 4096                                 # room for the line number in a line id

# The UK extract is split in two by this date (parameter of the routing rule).
FIXTURE_UK_CUTOFF = "1998-01-01"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _country(nation_key: F.Column, nation_name: F.Column) -> F.Column:
    expr = None
    for key, name in enumerate(COUNTRY_BY_NATION_KEY):
        expr = (F.when(nation_key == key, F.lit(name)) if expr is None
                else expr.when(nation_key == key, F.lit(name)))
    return expr.otherwise(nation_name)


def raw_from_driver_tables(spark: SparkSession, sf_dir: str,
                           uk_cutoff: str = FIXTURE_UK_CUTOFF) -> DataFrame:
    """Raw lines with the schema ``schemas.RAW`` (+ ``source`` label)."""
    # Lines meet their order's other lines first: the same partitioning serves the
    # line number inside the order and, when orders are too big to broadcast, the
    # join on the order key.  Some lines come twice (``copies``).  They are dealt to as
    # many tasks as the lines (counted in the file footers) ask for; a part table that
    # is too big to broadcast meets them in as many again.
    ln = F.col("l_linenumber")
    copies = F.when((F.col("l_orderkey") % 50 == 0) & (ln == 2), F.lit(2)).otherwise(F.lit(1))
    own = ["l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]
    lineitem = _table(spark, sf_dir, "lineitem")
    tasks = tasks_for(spark, lineitem.count())
    li = (lineitem.select("l_orderkey", *own)
          .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
          .repartition(tasks, "l_orderkey"))
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*own, "copy"))
    li = li.withColumn("line_id", F.col("l_orderkey") * LINES_PER_ORDER + number)
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice").repartition(tasks, "p_partkey")
    cu = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # Orders meet their customer and nation first (an orders-sized join), so
    # lineitem-sized data is shuffled at most twice — by order key, then by part
    # key — when orders and part are too big to broadcast.
    orders = (od.join(cu, od.o_custkey == cu.c_custkey)
                .join(na, cu.c_nationkey == na.n_nationkey)
                .select("o_orderkey", "o_custkey", "o_orderdate", "n_nationkey", "n_name"))
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                .join(pt, li.l_partkey == pt.p_partkey))

    is_credit = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    okey = F.col("l_orderkey")
    # some lines of a kind that cleaning and the audits must find
    no_invoice = (okey % 83 == 0) & (ln == 4)
    no_date = (okey % 89 == 0) & (ln == 5)
    unflagged = (okey % 61 == 0) & (ln == 3)          # negative, but not a credit note
    long_name = F.col("l_partkey") % 211 == 0
    late = (F.col("n_nationkey") == LATE_NATION) & (F.col("o_orderdate") < F.lit(LATE_FROM).cast("timestamp_ntz"))
    raw = joined.select(
        F.when(~no_invoice, F.concat(F.when(is_credit, F.lit("C")).otherwise(F.lit("")),
                                     okey.cast("string"))).alias("invoice"),
        F.concat(F.lit("  sku-"), F.col("l_partkey").cast("string"), F.lit(" ")).alias("stock_code"),
        F.when(long_name, F.concat(F.col("p_name"), F.lit("-" * LONG_NAME)))
         .when(ln == 7, F.lit(None).cast("string"))
         .when(ln % 3 == 0, F.concat(F.lit(" "), F.col("p_name"), F.lit(" alt ")))
         .otherwise(F.concat(F.col("p_name"), F.lit(" "))).alias("description"),
        (F.col("l_quantity").cast("int") * F.when(is_credit | unflagged, F.lit(-1)).otherwise(F.lit(1)))
        .alias("quantity"),
        F.when(~no_date, F.col("o_orderdate") + F.make_dt_interval(hours=ln * 3)).alias("invoice_date"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit(0.0))
         .otherwise(F.col("p_retailprice") + (ln % 3) * 10).cast("double").alias("price"),
        F.when(F.col("o_custkey") % 4 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_custkey").cast("double")).alias("customer_id"),
        _country(F.when(late, LATE_NATION - 1).otherwise(F.col("n_nationkey")), F.col("n_name")).alias("country"),
        "line_id",
    )
    return route_sources(raw, uk_cutoff)
