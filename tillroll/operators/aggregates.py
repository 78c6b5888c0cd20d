"""Stored totals, sketches and bitmaps that stand in for the fact where they cover a question.

Each aggregate keeps the fact's column names: ``line_total`` and ``quantity`` are summed
over the rows that agree in its keys, so whatever sums them reads an aggregate like a
(much shorter) fact and gives the same figures.  ``covering`` picks the shortest one
whose keys hold every column that a question groups by, filters on or counts.

Distinct customers do not add up, but sets of them unite.  ``sketch_customers`` has a
HyperLogLog sketch per day and branch, for approximate counts under any filter on days
and branches; ``bitmap_customers`` has exact sets per month and branch, a bit for each
customer number, cut into buckets, for retention.  Guests are in neither.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..schemas import GUEST_CUSTOMER_ID

#: Keys of the aggregates, shortest table first.
KEYS = {
    "agg_day_branch": ("date_key", "branch_id", "is_return"),
    "agg_day_product": ("date_key", "product_code", "is_return"),
    "agg_invoice": ("date_key", "branch_id", "invoice_no", "is_return"),
}

SKETCHES, BITMAPS = "sketch_customers", "bitmap_customers"
LG_K = 12                    # 4096 registers: a standard error of about 1.6 %
SPARSE = 256                 # numbers per customer beyond which a bitmap would be almost empty and is not kept

#: The fact column through which a dimension's attributes are reached.
KEY_OF_DIMENSION = {"branch": "branch_id", "date": "date_key", "product": "product_code", "customer": "customer_id"}


def aggregate(rows: DataFrame, name: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """The aggregate ``name`` of fact rows, or of a longer aggregate that holds its keys."""
    return rows.groupBy(*extra, *KEYS[name]).agg(F.sum("line_total").cast("decimal(38,2)").alias("line_total"),
                                                 F.sum("quantity").cast("long").alias("quantity"))


def aggregate_in_ranges(rows: DataFrame, name: str, tasks: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """The same, dealt to so many ranges of its keys, which begin with the day: the rows are shuffled once, and
    the result comes in the order in which it is stored."""
    keys = KEYS[name]
    needed = [*extra, *(k for k in keys if k not in extra), "line_total", "quantity"]
    return aggregate(rows.select(*needed).repartitionByRange(tasks, *keys), name, extra)


def customer_sketches(fact: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(date_key, branch_id, sketch) of the registered customers."""
    registered = fact.where(F.col("customer_id") != GUEST_CUSTOMER_ID)
    return registered.groupBy(*extra, "date_key", "branch_id").agg(F.hll_sketch_agg("customer_id", F.lit(LG_K)).alias("sketch"))


def customer_bitmaps(fact: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(branch_id, idx, bucket, bitmap): the registered customers of each branch and month, a bit each."""
    dk = F.col("date_key")
    idx = month_index(F.floor(dk / 10000), F.floor(dk / 100) % 100)
    registered = fact.where(F.col("customer_id") != GUEST_CUSTOMER_ID)
    return (registered.groupBy(*extra, "branch_id", idx.alias("idx"), F.bitmap_bucket_number("customer_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("bitmap")))


def dense_customers(fact: DataFrame) -> bool:
    """Whether customer numbers lie close enough together for bitmaps."""
    c = F.col("customer_id")
    r = fact.where(c != GUEST_CUSTOMER_ID).agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.approx_count_distinct(c).alias("n")).first()
    return not r["n"] or r["hi"] - r["lo"] + 1 <= SPARSE * max(r["n"], 8192)


def covering(star, columns, dimension_of: dict[str, str]):
    """``star`` with the shortest stored aggregate in the place of its fact that holds ``columns``; else as it is.

    ``dimension_of`` names the dimension that owns an attribute; other columns are the fact's."""
    needed = {KEY_OF_DIMENSION[dimension_of[c]] if c in dimension_of else c for c in columns}
    for name, keys in KEYS.items():
        if name in star.aggregates and needed <= set(keys):
            return replace(star, fact=star.aggregates[name])
    return star
