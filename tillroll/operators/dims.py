"""Dimension builders over the cleaned lines.

All of them aggregate first (partial aggregation absorbs hot keys such as the
guest customer) and only touch ordered windows on already-aggregated, tiny
results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bloom
from ..functions.dates import date_key, iso_weekday, month_key
from ..schemas import MONTH_PARTITION

# The region classes used in branch names.
REGION_UK = "UK"
REGION_EUROPE = "EUROPE"
REGION_ASIA_PAC = "ASIA_PAC"
REGION_REST = "REST_OF_WORLD"
EUROPE_COUNTRIES = ("EIRE", "Germany", "Netherlands", "France", "Belgium",
                    "Switzerland", "Spain", "Portugal", "Italy")
ASIA_PAC_COUNTRIES = ("Australia", "Japan", "Singapore", "Hong Kong")


def dim_customers(clean: DataFrame) -> DataFrame:
    """Country of each customer's latest line; ties on the timestamp are settled
    by invoice, then country (largest wins).  The guest id gets a row too.

    The lines are hash-aggregated to one timestamp per (customer, invoice,
    country); the ordered pick, which sorts, runs over those."""
    seen = clean.groupBy("customer_id", "invoice", "country").agg(F.max("invoice_date").alias("last"))
    latest = F.max_by(F.col("country"), F.struct("last", "invoice", "country"))
    return seen.groupBy("customer_id").agg(latest.alias("country"))


def dim_products(clean: DataFrame) -> DataFrame:
    """Most frequent description per stock code; ties → smallest description.

    Two-level aggregate: (code, description) counts, then one ``min_by`` per code
    — bounded state per key, no per-key list."""
    counts = clean.groupBy(F.col("stock_code").alias("product_code"),
                           F.col("description").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    pick = F.min_by(F.col("name"), F.struct((-F.col("n")).alias("neg_n"), F.col("name")))
    return counts.groupBy("product_code").agg(pick.alias("product_name"))


def region_of(country: F.Column) -> F.Column:
    return (F.when(country == "United Kingdom", F.lit(REGION_UK))
             .when(country.isin(*EUROPE_COUNTRIES), F.lit(REGION_EUROPE))
             .when(country.isin(*ASIA_PAC_COUNTRIES), F.lit(REGION_ASIA_PAC))
             .otherwise(F.lit(REGION_REST)))


def _branch_name(region: F.Column) -> F.Column:
    return F.concat(F.lit("Branch_"), region, F.lit("_"), F.replace(F.col("country"), F.lit(" "), F.lit("_")))


def dim_branches(clean: DataFrame) -> DataFrame:
    """One branch per country, numbered by first appearance: the earliest source
    extract holding the country, then the earliest line in it, then the name.
    The numbering window runs over the distinct countries only."""
    seen = clean.groupBy("country", "source_rank").agg(F.min("invoice_date").alias("first"))
    first = seen.groupBy("country").agg(F.min(F.struct("source_rank", "first")).alias("first_seen"))
    w = Window.orderBy(F.col("first_seen"), F.col("country"))
    region = region_of(F.col("country"))
    return first.select(
        F.row_number().over(w).cast("int").alias("branch_id"),
        _branch_name(region).alias("branch_name"),
        F.col("country"),
        region.alias("region"),
    )


def dim_date(clean: DataFrame) -> DataFrame:
    """Gap-free calendar from the first to the last sales date."""
    bounds = clean.agg(F.min(F.to_date("invoice_date")).alias("lo"),
                       F.max(F.to_date("invoice_date")).alias("hi"))
    d = F.col("date")
    return (bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
            .select(date_key(d).alias("date_key"), d,
                    F.year(d).alias("year"), F.quarter(d).alias("quarter"),
                    F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
                    iso_weekday(d).alias("day_of_week"),
                    (F.weekday(d) >= 5).cast("int").alias("is_weekend")))


def dedupe_dim(df: DataFrame, pk: str, order_by: list) -> DataFrame:
    """``INSERT IGNORE`` semantics: on a key conflict the first row (by a total
    order ``order_by``) is kept.  Aggregate with ``min_by`` so a hot key never
    buffers its rows in one task."""
    others = [c for c in df.columns if c != pk]
    picked = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*order_by))
    return df.groupBy(pk).agg(picked.alias("_row")).select(pk, *[F.col(f"_row.{c}").alias(c) for c in others])


def merge_dim(stored: DataFrame, batch: DataFrame, pk: str, order_by: list) -> DataFrame:
    """Rows that ``INSERT IGNORE`` of ``batch`` adds to the loaded dimension ``stored``.

    A key that is stored already keeps its stored row; of a new key the first row of the
    batch (by ``order_by``) comes in; a null key cannot be a primary key and is left out.
    The batch's keys make a Bloom filter that the stored dimension is scanned through, so
    only rows that very likely conflict are shuffled; the anti join with those survivors
    is exact.  A batch with too many keys for the filter's bound meets the stored keys
    in a plain anti join."""
    new = dedupe_dim(batch.where(F.col(pk).isNotNull()), pk, order_by)
    keys = stored.select(pk).where(F.col(pk).isNotNull())
    blocks = bloom.blocks_for(new.count())
    if blocks is not None:
        keys = bloom.may_hold(keys, [pk], bloom.build(new, [pk], blocks), blocks)
    return new.join(keys, pk, "left_anti")


# ------------------------------------------------------------------ mergeable states
# A state has a row per key and month of the lines it was made of.  States of different
# lines are merged by union; the dimension is read off the union, so it does not matter
# in how many loads the lines came.


def customer_state(clean: DataFrame) -> DataFrame:
    """(sales_month, customer_id, last): the latest line of each customer in each month."""
    seen = clean.groupBy(_month(), "customer_id", "invoice", "country").agg(F.max("invoice_date").alias("last"))
    return seen.groupBy(MONTH_PARTITION, "customer_id").agg(F.max(F.struct("last", "invoice", "country")).alias("last"))


def customers_of(state: DataFrame) -> DataFrame:
    return state.groupBy("customer_id").agg(F.max("last").alias("last")).select("customer_id", F.col("last.country").alias("country"))


def product_state(clean: DataFrame) -> DataFrame:
    """(sales_month, product_code, name, n): how often each description stood beside each code in each month."""
    return clean.groupBy(_month(), F.col("stock_code").alias("product_code"),
                         F.col("description").alias("name")).agg(F.count(F.lit(1)).alias("n"))


def products_of(state: DataFrame) -> DataFrame:
    counts = state.groupBy("product_code", "name").agg(F.sum("n").alias("n"))
    pick = F.min_by(F.col("name"), F.struct((-F.col("n")).alias("neg_n"), F.col("name")))
    return counts.groupBy("product_code").agg(pick.alias("product_name"))


def branch_state(clean: DataFrame) -> DataFrame:
    """(sales_month, country, source_rank, first, last): a country's first and last line in each extract and month."""
    return clean.groupBy(_month(), "country", "source_rank").agg(F.min("invoice_date").alias("first"), F.max("invoice_date").alias("last"))


def branches_of(state: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Branches by first appearance.  Stored branches keep their numbers, since facts of
    earlier loads refer to them; countries not stored are numbered after them."""
    new = state.groupBy("country").agg(F.min(F.struct("source_rank", "first")).alias("first_seen"))
    start = F.lit(0)
    if stored is not None:
        new = merge_dim(stored, new, "country", [F.col("first_seen")])
        start = F.coalesce(stored.agg(F.max("branch_id")).scalar(), F.lit(0))
    region = region_of(F.col("country"))
    number = F.row_number().over(Window.orderBy(F.col("first_seen"), F.col("country")))      # one row a country
    rows = new.select((start + number).cast("int").alias("branch_id"), _branch_name(region).alias("branch_name"), "country", region.alias("region"))
    return rows if stored is None else stored.select(*rows.columns).unionByName(rows)


def calendar_of(state: DataFrame) -> DataFrame:
    """Gap-free calendar over the days that the branch states span."""
    return dim_date(state.select(F.explode(F.array("first", "last")).alias("invoice_date")))


def _month() -> F.Column:
    return month_key("invoice_date").alias(MONTH_PARTITION)
