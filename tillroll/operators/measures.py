"""The BI measure library: each measure is evaluated under any grouping
(``by``) and filter (``where``) — the filter context of the semantic model.

Additive measures are sums over fact lines.  Orders and purchase orders count the
rows of a first aggregate at (by, invoice) grain, which also carries the sums;
active customers count the rows of a second one at (by, customer) grain; the two
meet at ``by`` grain.  No distinct aggregate is left, so nothing is expanded, and
the guest rows collapse before the first shuffle.  Ratios follow DAX
``DIVIDE(a, b, 0)``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_key, month_key
from ..functions.ratios import dax_div
from ..schemas import GUEST_CUSTOMER_ID, MONTH_PARTITION
from .aggregates import LG_K, SKETCHES, covering
from .fact import with_customer_country

DEFAULT_MARGIN = 0.40
DEFAULT_GROWTH = 0.10

# Columns the filter context may group or slice by, and the dimension owning them.
_DIM_COLUMNS = {
    "country": "branch", "region": "branch", "branch_name": "branch",
    "year": "date", "quarter": "date", "month": "date", "date": "date",
    "day_of_week": "date", "is_weekend": "date",
    "product_name": "product",
    "customer_country": "customer",
}

_ORDER_MEASURES = {"total_transactions", "net_transactions", "aov", "items_per_basket"}
_CUSTOMER_MEASURES = {"active_customers", "avg_clv"}

MEASURES = (
    "net_sales", "gross_sales", "returns_value", "return_rate", "total_transactions",
    "net_transactions", "gross_profit", "gross_margin", "aov", "items_per_basket",
    "active_customers", "avg_clv", "target_sales",
)


#: Measures that shift or run over months, evaluated by ``timeintel.evaluate_monthly``.
TIME_MEASURES = ("net_sales_pm", "mom_growth", "sales_ytd", "sales_ly_ytd", "yoy_growth", "sales_ly", "sssg",
                 "customers_prev", "customers_retained", "retention_rate")


def _with_fact(star, fact: DataFrame):
    from dataclasses import replace
    return replace(star, fact=fact)


def context(star, columns=()) -> DataFrame:
    """Fact rows joined to exactly the dimensions that ``columns`` need."""
    f = star.fact
    need = {_DIM_COLUMNS[c] for c in columns if c in _DIM_COLUMNS}
    if "branch" in need:
        f = f.join(star.dim_branches.select("branch_id", "country", "region",
                                                        "branch_name"), "branch_id", "left")
    if "date" in need:
        f = f.join(star.dim_date.select("date_key", "year", "quarter", "month", "date",
                                                    "day_of_week", "is_weekend"),
                   "date_key", "left")
    if "product" in need:
        f = f.join(star.dim_products.select("product_code", "product_name"), "product_code", "left")
    if "customer" in need:
        f = with_customer_country(f, star.dim_customers)
    return f


def _where_columns(star, where) -> list:
    """Dimension columns that the filter names.  Those of a Column are the references that the
    analyzer resolves in a row of all columns, so a word in a literal is none."""
    if isinstance(where, dict):
        return list(where.keys())
    if not isinstance(where, Column):
        return []
    fact = star.fact
    known = fact.schema.fields + [f for dim in (star.dim_branches, star.dim_date, star.dim_products) for f in dim.schema.fields]
    fields = {f.name: f for f in [*known, T.StructField("customer_country", T.StringType())]}
    probe = fact.sparkSession.createDataFrame([], T.StructType(list(fields.values()))).where(where)
    condition = probe._jdf.queryExecution().analyzed().expressions().head()
    found = set(re.findall(r"(\w+)#\d+", condition.references().toString()))
    return [c for c in _DIM_COLUMNS if c in found]


def _date_key_range(col: str, v):
    """Calendar slicer → equivalent YYYYMMDD range on the fact's own key, so the
    predicate also reaches the fact scan.  Only exact translations: a key, a year or
    a date, alone or as a range; other calendar attributes stay dimension filters."""
    lo, hi = (v if isinstance(v, tuple) and len(v) == 2 else (v, v))
    if col == "date_key" and isinstance(lo, int) and isinstance(hi, int):
        return lo, hi
    if col == "year" and isinstance(lo, int) and isinstance(hi, int):
        return lo * 10000 + 101, hi * 10000 + 1231
    if col == "date" and hasattr(lo, "strftime") and hasattr(hi, "strftime"):
        return int(lo.strftime("%Y%m%d")), int(hi.strftime("%Y%m%d"))
    return None


RELATIVE_MONTHS = "last_months"


def _fact_side(star, where) -> list:
    """Fact-side predicates implied by the slicers (see ``_date_key_range``), on the
    key and, where the fact is stored by month, on its partition column,
    plus the relative date slider: the last n calendar months up to the last day
    of the calendar, as a scalar subquery (nothing is collected)."""
    if not isinstance(where, dict):
        return []
    out = []
    stored = MONTH_PARTITION in star.fact.columns
    for col, v in where.items():
        if col == RELATIVE_MONTHS:
            last = star.dim_date.agg(F.max("date")).scalar()
            first = F.date_add(F.add_months(last, -int(v)), 1)
            out.append(F.col("date_key") >= date_key(first))
            if stored:
                out.append(F.col(MONTH_PARTITION) >= month_key(first))
            continue
        rng = _date_key_range(col, v)
        if rng is not None:
            out.append(F.col("date_key").between(*rng))
            if stored:
                out.append(F.col(MONTH_PARTITION).between(rng[0] // 100, rng[1] // 100))
    return out


def apply_where(df: DataFrame, where) -> DataFrame:
    """``where`` is a Column, or a dict {column: value | list | (lo, hi)}
    (``evaluate`` also accepts ``last_months: n``, the relative date slider)."""
    if where is None:
        return df
    if isinstance(where, Column):
        return df.where(where)
    for col, v in where.items():
        if isinstance(v, tuple) and len(v) == 2:
            df = df.where(F.col(col).between(F.lit(v[0]), F.lit(v[1])))
        elif isinstance(v, (list, set, frozenset)):
            df = df.where(F.col(col).isin(*sorted(v)))
        else:
            df = df.where(F.col(col) == F.lit(v))
    return df


def _sums(prefix: str = "") -> list:
    ret, lt = F.col("is_return"), F.col("line_total")
    if prefix:
        return [F.sum(f"{prefix}{n}").alias(n) for n in ("net", "gross", "returns", "units")]
    return [F.sum(lt).alias("net"), F.sum(F.when(~ret, lt)).alias("gross"),
            F.sum(F.when(ret, lt)).alias("returns"), F.sum("quantity").alias("units")]


def _grain(by: list, key: str) -> list:
    return by + [c for c in (key,) if c not in by]


def _slicer_columns(where) -> list:
    """Columns of a slicer dictionary; the relative date slider is one on the day."""
    return ["date_key" if c == RELATIVE_MONTHS else c for c in where or ()]


def evaluate(star, measures=MEASURES, by=(), where=None, *, margin: float = DEFAULT_MARGIN,
             growth: float = DEFAULT_GROWTH) -> DataFrame:
    """One row per ``by`` group with the requested measures, after ``where``.

    Measures over time (``TIME_MEASURES``) give a row per group and
    calendar month; they cannot be mixed with the others in one call.

    ``by``/``where`` may name fact columns or dimension attributes (country,
    region, year, month, product_name, customer_country, …); only the needed
    dimensions are joined.  Where a stored aggregate holds the columns asked for, it
    is read instead of the fact (not under a Column filter)."""
    by = list(by)
    if set(measures) & set(TIME_MEASURES):
        from .timeintel import evaluate_monthly
        return evaluate_monthly(star, measures, by, where)
    if not isinstance(where, Column):
        counted = ["invoice_no"] * bool(set(measures) & _ORDER_MEASURES) + ["customer_id"] * bool(set(measures) & _CUSTOMER_MEASURES)
        star = covering(star, [*by, *_slicer_columns(where), *counted], _DIM_COLUMNS)
    for cond in _fact_side(star, where):
        star = _with_fact(star, star.fact.where(cond))
    if isinstance(where, dict):
        where = {k: v for k, v in where.items() if k != RELATIVE_MONTHS}
    base = apply_where(context(star, by + _where_columns(star, where)), where)
    names = ("net", "gross", "returns", "units")
    if set(measures) & _ORDER_MEASURES:
        lines = base.groupBy(*_grain(by, "invoice_no")).agg(
            *[c.alias(f"_{n}") for c, n in zip(_sums(), names)],
            F.bool_or(~F.col("is_return")).alias("_purchase"))
        named = F.col("invoice_no").isNotNull()
        agg = lines.groupBy(*by).agg(*_sums("_"), F.count_if(named).alias("orders"),
                                     F.count_if(named & F.col("_purchase")).alias("purchase_orders"))
    else:
        agg = base.groupBy(*by).agg(*_sums())
    if set(measures) & _CUSTOMER_MEASURES:
        # the same groups from the same rows: one line of each kind per group, added up
        buyers = base.groupBy(*_grain(by, "customer_id")).agg(F.lit(1).alias("_one")).groupBy(*by).agg(
            F.count_if(F.col("customer_id") != GUEST_CUSTOMER_ID).alias("customers"))
        sums = [c for c in agg.columns if c not in by]
        both = agg.unionByName(buyers, allowMissingColumns=True)
        agg = both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in (*sums, "customers")])

    net, gross, returns = (F.col(c).cast("double") for c in ("net", "gross", "returns"))
    profit = net * F.lit(margin)
    defs = {
        "net_sales": lambda: net,
        "gross_sales": lambda: gross,
        "returns_value": lambda: returns,
        "return_rate": lambda: dax_div(F.abs(returns), gross),
        "total_transactions": lambda: F.col("orders"),
        "net_transactions": lambda: F.col("purchase_orders"),
        "gross_profit": lambda: profit,
        "gross_margin": lambda: dax_div(profit, net),
        "aov": lambda: dax_div(gross, F.col("purchase_orders")),
        "items_per_basket": lambda: dax_div(F.col("units"), F.col("purchase_orders")),
        "active_customers": lambda: F.col("customers"),
        "avg_clv": lambda: dax_div(net, F.col("customers")),
        "target_sales": lambda: net * F.lit(1.0 + growth),
    }
    return agg.select(*by, *[defs[m]().alias(m) for m in measures])


def approx_customers(star, by=(), where=None) -> DataFrame:
    """Approximate active customers per group, (by…, active_customers): stored sketches of days and branches are united
    under the filter, without the fact; under columns that these do not cover the fact's customers are sketched.

    The standard error is about 1.6 % (``aggregates.LG_K``); ``evaluate`` counts exactly."""
    by = list(by)
    columns = [*by, *_slicer_columns(where)] if not isinstance(where, Column) else None
    covered = columns is not None and SKETCHES in star.aggregates and all(
        _DIM_COLUMNS.get(c, c) in ("branch", "date", "branch_id", "date_key") for c in columns)
    star = _with_fact(star, star.aggregates[SKETCHES] if covered else star.fact)
    for cond in _fact_side(star, where):
        star = _with_fact(star, star.fact.where(cond))
    if isinstance(where, dict):
        where = {k: v for k, v in where.items() if k != RELATIVE_MONTHS}
    rows = apply_where(context(star, by + _where_columns(star, where)), where)
    if covered:
        united = F.hll_union_agg("sketch")
    else:
        united = F.hll_sketch_agg(F.when(F.col("customer_id") != GUEST_CUSTOMER_ID, F.col("customer_id")), F.lit(LG_K))
    return rows.groupBy(*by).agg(F.coalesce(F.hll_sketch_estimate(united), F.lit(0)).alias("active_customers"))
