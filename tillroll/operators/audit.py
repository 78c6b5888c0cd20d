"""Data-quality audits of the star (run as data, since Spark does not enforce
keys): duplicates, guest share, referential integrity, sign and price anomalies,
and every declared PK / UNIQUE / NOT NULL / FK / length constraint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import round2, safe_div
from ..schemas import GUEST_CUSTOMER_ID, VARCHAR_LIMITS
from .numbering import number_rows

DUPLICATE_KEYS = ("invoice_no", "product_code", "date_key", "quantity", "unit_price")


# Row numbers of one duplicate group are generated in chunks of this size, and
# the chunks are spread over tasks, so a hot group does not emit all its rows
# from a single task.
DUPLICATE_CHUNK = 1_000_000


def audit_duplicates(fact: DataFrame, keys=DUPLICATE_KEYS, limit: int | None = None,
                     chunk: int = DUPLICATE_CHUNK) -> DataFrame:
    """Rows whose ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY sales_id)`` is
    > 1, listed as the keys plus ``row_num``: all of them, or the first ``limit``.

    A group of c identical keys yields row numbers 2..c whatever the order, so
    the listing is built from a count per key (partial aggregation; a hot key
    never lands in one window task) and ``sequence(2, c)``.  With a limit, the
    listing is ordered by keys and row number; a group can contribute at most
    ``limit`` rows to it, so the sequence is cut at ``limit + 1`` — exact, since
    later row numbers sort after the first ``limit`` of the same group.  Without
    a limit, the numbers are produced per chunk after a shuffle of the (small)
    chunk descriptors.
    """
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    n = F.col("_n").cast("long")
    if limit is not None:
        out = counts.select(*[F.col(k) for k in keys], F.explode(
            F.sequence(F.lit(2).cast("long"), F.least(n, F.lit(limit + 1).cast("long")))).alias("row_num"))
    else:
        chunks = counts.select(*keys, n.alias("_n"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.floor((n - 2) / chunk).cast("long"))).alias("_c"))
        chunks = chunks.repartition(*[F.col(k) for k in keys], F.col("_c"))
        lo = F.col("_c") * chunk + 2
        hi = F.least(F.col("_n"), lo + (chunk - 1))
        out = chunks.select(*keys, F.explode(F.sequence(lo, hi)).alias("row_num"))
    if "unit_price" in keys:
        out = out.withColumn("unit_price", F.col("unit_price").cast("double"))
    if limit is not None:
        out = out.orderBy(*keys, "row_num").limit(limit)
    return out


def audit_duplicate_rows(fact: DataFrame, keys=DUPLICATE_KEYS) -> DataFrame:
    """The rows themselves that ``audit_duplicates`` lists by number: ``sales_id`` of every
    row whose number among the rows of its keys, in order of ``sales_id``, is > 1, so that
    they can be removed.

    Only keys that occur more than once are numbered, and their rows by ranges of key and
    id: a key of a third of all rows is numbered in as many tasks as it fills ranges."""
    keys = list(keys)
    twice = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    twice = twice.select(*(F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(keys)])
    rows = fact.select("sales_id", *keys).join(twice, same, "left_semi")
    return number_rows(rows, keys, [F.col("sales_id")]).where(F.col("row_num") > 1)


def audit_guest(fact: DataFrame) -> DataFrame:
    """Guest-checkout rows: count, spend, and share of all fact rows — one scan
    (the denominator is computed in the same aggregate).  No guests → no row."""
    guest = F.col("customer_id") == GUEST_CUSTOMER_ID
    t = fact.agg(F.count_if(guest).alias("n"),
                 F.sum(F.when(guest, F.col("line_total"))).alias("spent"),
                 F.count(F.lit(1)).alias("total"))
    return t.where(F.col("n") > 0).select(
        F.lit(GUEST_CUSTOMER_ID).cast("int").alias("customer_id"),
        F.col("n").alias("transaction_count"),
        F.col("spent").cast("double").alias("total_spent"),
        round2(safe_div(F.col("n").cast("double") * 100.0, F.col("total"))).alias("pct_of_total_rows"),
    )


def _fk_specs(star):
    return (("customers", "customer_id", star.dim_customers),
            ("products", "product_code", star.dim_products),
            ("branches", "branch_id", star.dim_branches),
            ("dates", "date_key", star.dim_date))


def fk_match_counts(star) -> DataFrame:
    """Per foreign key: fact rows, rows matched in the dimension, rows with a NULL
    key.  The fact is first reduced to one row per distinct key value, so the
    join with the dimension never shuffles fact rows."""
    parts = []
    for name, key, dim in _fk_specs(star):
        per_key = star.fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        d = dim.select(key, F.lit(True).alias("_m"))
        j = per_key.join(d, key, "left")
        parts.append(j.agg(
            F.lit(name).alias("dimension"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_m"), F.col("rows"))), F.lit(0)).alias("matched"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("rows"))), F.lit(0)).alias("null_rows")))
    return reduce(DataFrame.unionByName, parts)


def audit_referential(star) -> DataFrame:
    """Total fact rows and rows matched in each dimension (left-join counts)."""
    m = fk_match_counts(star)
    d = F.col("dimension")
    return m.agg(
        F.max("rows").alias("total_fact_rows"),
        *[F.sum(F.when(d == name, F.col("matched"))).alias(f"matching_{name}")
          for name, _, _ in _fk_specs(star)])


def audit_orphans(star) -> DataFrame:
    """Fact rows without a dimension row, per dimension."""
    m = fk_match_counts(star)
    return m.select("dimension", (F.col("rows") - F.col("matched")).alias("orphan_rows"))


def audit_sign(fact: DataFrame) -> DataFrame:
    """Negative quantity on a line that is not flagged as a return."""
    return fact.where((F.col("quantity") < 0) & ~F.col("is_return")).select(
        "invoice_no", "quantity", "is_return")


def audit_price(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if(F.col("unit_price") < 0).alias("anomaly_count"))


def _rules(df: DataFrame, table: str, rules: dict) -> DataFrame:
    """One aggregate with a column per rule, unpivoted to (table, rule, violations)."""
    agg = df.agg(*[expr.cast("long").alias(name) for name, expr in rules.items()])
    return agg.unpivot([], list(rules), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations")


def _dup(col: str) -> F.Column:
    return F.count(F.lit(1)) - F.count_distinct(F.col(col))


def _nulls(*cols: str) -> dict:
    return {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in cols}


def _lengths(table: str) -> dict:
    return {f"max_length:{c}:{n}": F.count_if(F.length(F.col(c)) > n)
            for (t, c), n in VARCHAR_LIMITS.items() if t == table}


def audit_constraints(star) -> DataFrame:
    """Every declared key and column constraint, as violation counts."""
    parts = [
        _rules(star.dim_date, "dim_date", {
            "primary_key:date_key": _dup("date_key"), "unique:date": _dup("date"),
            **_nulls("date_key", "date", "year", "quarter", "month", "day", "day_of_week",
                     "is_weekend")}),
        _rules(star.dim_customers, "dim_customers", {
            "primary_key:customer_id": _dup("customer_id"), **_nulls("customer_id", "country"),
            **_lengths("dim_customers")}),
        _rules(star.dim_products, "dim_products", {
            "primary_key:product_code": _dup("product_code"),
            **_nulls("product_code", "product_name"), **_lengths("dim_products")}),
        _rules(star.dim_branches, "dim_branches", {
            "primary_key:branch_id": _dup("branch_id"), "unique:country": _dup("country"),
            **_nulls("branch_id", "branch_name", "country"), **_lengths("dim_branches")}),
        # the distinct count on its own: beside other rules it would carry their counters through its shuffle
        _rules(star.fact.select("sales_id"), "fact_sales", {"primary_key:sales_id": _dup("sales_id")}),
        _rules(star.fact, "fact_sales", {
            **_nulls("sales_id", "invoice_no", "transaction_time", "quantity", "unit_price",
                     "line_total", "is_return"),
            **_lengths("fact_sales")}),
    ]
    fk = fk_match_counts(star).select(
        F.lit("fact_sales").alias("table_name"),
        F.concat(F.lit("foreign_key:"), F.col("dimension")).alias("rule"),
        (F.col("rows") - F.col("matched") - F.col("null_rows")).alias("violations"))
    return reduce(DataFrame.unionByName, parts + [fk])
