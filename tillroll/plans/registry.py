"""Query registry: key → callable(spark, sf_dir) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as D
from ..operators import clean as B
from ..operators import dashboard as G
from ..operators import dims as DM
from ..operators import fact as FT
from ..operators import business as E
from ..operators import forecast as I
from ..operators import measures as M
from ..operators import report as H
from ..operators import smoothing as S
from ..operators import timeintel as TI
from ..functions.dates import month_key
from ..schemas import FACT_COLUMNS
from ..session import checkpoint_base, join_path
from ..sources import fixtures as FX
from ..sources import raw as RW
from . import published as P
from .warehouse import _materialize, load_star, open_dim, open_extracts, open_fit, open_lines, open_star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


# ---------------------------------------------------------------- business (E)
@query("kpi_totals")
def _kpi_totals(spark, sf):
    return E.kpi_totals(open_star(spark, sf).fact)


@query("mom_growth")
def _mom(spark, sf):
    s = open_star(spark, sf)
    return E.mom_growth(s.fact, s.dim_date)


@query("aov_basket")
def _aov(spark, sf):
    return E.aov_basket(open_star(spark, sf).fact)


@query("top_products")
def _top(spark, sf):
    s = open_star(spark, sf)
    return E.top_products(s.fact, s.dim_products, 10)


@query("branch_share")
def _share(spark, sf):
    s = open_star(spark, sf)
    return E.branch_share(s.fact, s.dim_branches)


@query("customer_segments")
def _segments(spark, sf):
    return E.customer_segments(open_star(spark, sf).fact)


# ---------------------------------------------------------------- audits (D)


@query("audit_duplicates")
def _dups(spark, sf):
    return D.audit_duplicates(open_star(spark, sf).fact, limit=100)


@query("audit_duplicates_all")
def _dups_all(spark, sf):
    """The same five keys, the whole listing."""
    return D.audit_duplicates(open_star(spark, sf).fact)


@query("audit_duplicate_rows")
def _dup_rows(spark, sf):
    """The extra rows by id, numbered within their keys."""
    return _money_out(D.audit_duplicate_rows(open_star(spark, sf).fact))


@query("audit_guest")
def _guest(spark, sf):
    return D.audit_guest(open_star(spark, sf).fact)


@query("audit_referential")
def _ri(spark, sf):
    return D.audit_referential(open_star(spark, sf))


@query("audit_orphans")
def _orph(spark, sf):
    return D.audit_orphans(open_star(spark, sf))


@query("audit_sign")
def _sign(spark, sf):
    return D.audit_sign(open_star(spark, sf).fact)


@query("audit_price")
def _price(spark, sf):
    return D.audit_price(open_star(spark, sf).fact)


@query("audit_constraints")
def _constraints(spark, sf):
    return D.audit_constraints(open_star(spark, sf))


@query("audit_duplicates_line")
def _dups_line(spark, sf):
    """Whole duplicate listing on line-level keys (invoice, day, time of day)."""
    return D.audit_duplicates(open_star(spark, sf).fact,
                              keys=("invoice_no", "date_key", "transaction_time"))


# ---------------------------------------------------------------- measures (F)

_BY_COUNTRY = {
    "m_core": ("net_sales", "gross_sales", "returns_value", "return_rate", "total_transactions",
               "net_transactions"),
    "m_margin": ("gross_profit", "gross_margin"),
    "m_order": ("aov", "items_per_basket"),
    "m_customers": ("active_customers", "avg_clv"),
    "m_target": ("net_sales", "target_sales"),
}


def _by_country(measures):
    return lambda spark, sf: M.evaluate(open_star(spark, sf), measures, by=("country",))


for _k, _m in _BY_COUNTRY.items():
    QUERIES[_k] = _by_country(_m)


@query("m_customers_approx")
def _customers_approx(spark, sf):
    """Exact active customers by country and year, and whether the united sketches come within 5 % (or one) of them."""
    star, by = open_star(spark, sf), ["country", "year"]
    near = M.approx_customers(star, by).withColumnRenamed("active_customers", "near")
    both = M.evaluate(star, ("active_customers",), by).join(near, by, "left").fillna(0, ["near"])
    off = F.abs(F.col("near") - F.col("active_customers"))
    return both.select(*by, "active_customers", (off <= F.greatest(F.lit(1.0), F.col("active_customers") * 0.05)).alias("within"))


@query("m_prev_month")
def _pm(spark, sf):
    return TI.prev_month(open_star(spark, sf))


@query("m_sssg")
def _sssg(spark, sf):
    return TI.same_store(open_star(spark, sf), whole_months=True)


@query("m_sssg_aligned")
def _sssg_aligned(spark, sf):
    """Like for like: the open last month against the same days a year earlier."""
    return TI.same_store(open_star(spark, sf))


@query("m_ytd")
def _ytd(spark, sf):
    return TI.ytd(open_star(spark, sf), whole_months=True)


@query("m_retention")
def _ret(spark, sf):
    return TI.retention(open_star(spark, sf))


@query("m_prev_month_by_country")
def _pm_country(spark, sf):
    return M.evaluate(open_star(spark, sf), ("net_sales", "net_sales_pm", "mom_growth"), by=("country",))


@query("m_ytd_by_region")
def _ytd_region(spark, sf):
    return TI.ytd(open_star(spark, sf), by=("region",), whole_months=True)


@query("m_sssg_sliced")
def _sssg_sliced(spark, sf):
    return TI.same_store(open_star(spark, sf), where={"region": "EUROPE", "year": (1997, 1998)}, whole_months=True)


@query("m_retention_by_country")
def _ret_country(spark, sf):
    return M.evaluate(open_star(spark, sf), ("customers_prev", "customers_retained", "retention_rate"), by=("country",))


@query("m_core_monthly")
def _core_monthly(spark, sf):
    return M.evaluate(open_star(spark, sf), _BY_COUNTRY["m_core"], by=("year", "month"))


# ---------------------------------------------------------------- dashboard (G)

# The slicer state that dash_sliced shows.
PAGE_SLICERS = {"date_key": (19970101, 19981231), "country": ["United Kingdom", "Germany", "France"]}

for _k, _fn in {"dash_cards": G.cards, "dash_trend": G.trend, "dash_region_share": G.region_share,
                "dash_country": G.country_sales, "dash_sliced": lambda star: G.sliced_cards(star, PAGE_SLICERS),
                "dash_product_matrix": G.product_matrix, "dash_price_qty": G.price_quantity,
                "dash_guest_split": G.guest_split}.items():
    QUERIES[_k] = (lambda fn: lambda spark, sf: fn(open_star(spark, sf)))(_fn)


# ---------------------------------------------------------------- report (H)

for _k, _fn in {"rep_quarter_share": H.quarter_share, "rep_q1_dip": H.q1_dip,
                "rep_return_rate": H.return_rate_by_country,
                "rep_sku_concentration": H.sku_concentration, "rep_concentration_curve": H.concentration_curve}.items():
    QUERIES[_k] = (lambda fn: lambda spark, sf: fn(open_star(spark, sf)))(_fn)


# ---------------------------------------------------------------- sources, cleaning, star (A, B, C)


_RAW_COLS = ("invoice", "stock_code", "description", "quantity", "invoice_date", "price",
             "customer_id", "country", "source_rank")


def _money_out(df):
    for c in ("price", "unit_price", "line_total"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("double"))
    return df


@query("src_read")
def _src_read(spark, sf):
    """Extract stage: the whole extract folder in one scan (source from the path)."""
    df = RW.read_raw(spark, open_extracts(spark, sf))
    return df.withColumn("source_rank", RW.source_rank_of(F.col("source"))).select(*_RAW_COLS)


@query("src_union")
def _src_union(spark, sf):
    """Extract stage: six required extracts read one by one, UNION ALL by name."""
    return RW.read_sources(spark, open_extracts(spark, sf)).select(*_RAW_COLS)


@query("src_route")
def _src_route(spark, sf):
    raw = FX.raw_from_driver_tables(spark, sf)
    return raw.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))


@query("clean_nan")
def _clean_nan(spark, sf):
    return B.nan_to_null(FX.raw_from_driver_tables(spark, sf)).select(*_RAW_COLS)


@query("clean_flat")
def _clean_flat(spark, sf):
    """Cleaning as one lazy plan straight from the driver tables."""
    return _money_out(B.clean_flat_from_raw(FX.raw_from_driver_tables(spark, sf)))


@query("sink_clean")
def _sink_clean(spark, sf):
    """The cleaned flat file as written by the ETL, read back."""
    from ..sources.sinks import read_clean
    star = open_star(spark, sf)
    return _money_out(read_clean(spark, join_path(star.lines_base, "lines")).select(*B.CLEAN_COLUMNS))


@query("clean_report")
def _clean_report(spark, sf):
    return B.clean_report(open_star(spark, sf).lines)


@query("dim_customers")
def _dim_c(spark, sf):
    return open_dim(spark, sf, "dim_customers")


@query("dim_products")
def _dim_p(spark, sf):
    return open_dim(spark, sf, "dim_products")


@query("dim_branches")
def _dim_b(spark, sf):
    return open_dim(spark, sf, "dim_branches")


@query("dim_date")
def _dim_d(spark, sf):
    return open_dim(spark, sf, "dim_date")


@query("dim_dedupe")
def _dim_dedupe(spark, sf):
    """First-loaded description per code (INSERT IGNORE), first = earliest line."""
    clean = open_star(spark, sf).clean
    rows = clean.select(F.col("stock_code").alias("product_code"),
                        F.col("description").alias("product_name"), "invoice_date", "invoice")
    d = DM.dedupe_dim(rows, "product_code",
                      [F.col("invoice_date"), F.col("invoice"), F.col("product_name")])
    return d.select("product_code", "product_name")


@query("fact_build")
def _fact_build(spark, sf):
    """Fact builder over the cleaned lines, branches numbered from the same lines."""
    clean = open_star(spark, sf).clean
    return _money_out(FT.fact_sales(clean, DM.dim_branches(clean)).select(*FACT_COLUMNS))


@query("bi_projection")
def _bi(spark, sf):
    return _money_out(FT.bi_projection(open_star(spark, sf).fact))


@query("sink_star")
def _sink_star(spark, sf):
    """The star loaded into a warehouse folder of its own for each call, read back."""
    path = load_star(open_star(spark, sf), join_path(checkpoint_base(spark), "tillroll-warehouse"))
    return _money_out(spark.read.parquet(join_path(path, "fact_sales")).select(*FACT_COLUMNS))


# Loads in several steps: years before SPLIT_YEAR, then the others (CORRECTED months with part of their
# lines), then the corrected months again with all of theirs.
SPLIT_YEAR, CORRECTED = 1996, (199703, 199705)


def _loaded(spark, sf):
    """Star of a warehouse that was filled by three published loads."""
    def build(path):
        lines = open_lines(spark, sf)
        late = F.year("invoice_date") >= SPLIT_YEAR
        corrected = month_key("invoice_date").between(*CORRECTED)
        P.load(spark, path, lines.where(~late), "replace")
        P.load(spark, path, lines.where(late & ~(corrected & (F.col("quantity") % 2 == 0))), "append")
        P.load(spark, path, lines.where(corrected), "months")
    return P.open_published(spark, _materialize(spark, sf, "published", build))


@query("load_fact")
def _load_fact(spark, sf):
    """Fact of the published warehouse, each branch by its name (numbers depend on the order of loads)."""
    s = _loaded(spark, sf)
    names = s.dim_branches.select("branch_id", "branch_name")
    rows = s.fact.join(names, "branch_id", "left")
    return _money_out(rows.select("branch_name", *(c for c in FACT_COLUMNS if c != "branch_id")))


@query("load_customers")
def _load_customers(spark, sf):
    return _loaded(spark, sf).dim_customers


@query("load_products")
def _load_products(spark, sf):
    return _loaded(spark, sf).dim_products


@query("load_measures")
def _load_measures(spark, sf):
    """Measures over the published warehouse's stored totals."""
    return M.evaluate(_loaded(spark, sf), _BY_COUNTRY["m_core"], by=("country",))


@query("dim_merge")
def _dim_merge(spark, sf):
    """Two loads of the product dimension: what the first one stored stays, the second one adds its new codes."""
    clean = open_star(spark, sf).clean
    rows = clean.select(F.col("stock_code").alias("product_code"), F.col("description").alias("product_name"), "invoice_date", "invoice")
    order = [F.col("invoice_date"), F.col("invoice"), F.col("product_name")]
    late = F.year("invoice_date") >= SPLIT_YEAR

    def first(path):
        DM.dedupe_dim(rows.where(late), "product_code", order).select("product_code", "product_name").write.parquet(path)

    stored = spark.read.parquet(_materialize(spark, sf, "dim-first-load", first))
    return stored.unionByName(DM.merge_dim(stored, rows.where(~late), "product_code", order).select("product_code", "product_name"))


@query("star_view")
def _star_view(spark, sf):
    return _money_out(FT.star_view(open_star(spark, sf)))


# ---------------------------------------------------------------- forecasting (I)


def _filled(spark, sf):
    return I.gap_fill(I.weekly_series(open_star(spark, sf)))


@query("weekly_series")
def _weekly(spark, sf):
    return I.weekly_series(open_star(spark, sf))


@query("weekly_gapfill")
def _gapfill(spark, sf):
    return _filled(spark, sf)


@query("forecast_split")
def _split(spark, sf):
    return I.split_holdout(_filled(spark, sf))


@query("hw_fixed")
def _hw_fixed(spark, sf):
    """Fixed-parameter fit, folded JVM-side (no Python)."""
    return I.fit_fixed(_filled(spark, sf), I.VALIDATION_SEASON, I.FIXED_PARAMS)


def _validation_fit(spark, sf):
    return open_fit(spark, sf, "fit-validation",
                    lambda: I.fit(_filled(spark, sf), I.VALIDATION_SEASON, train_only=True))


def _annual_fit(spark, sf):
    return open_fit(spark, sf, "fit-annual", lambda: I.fit(_filled(spark, sf), I.ANNUAL_SEASON))


@query("hw_grid")
def _hw_grid(spark, sf):
    return _validation_fit(spark, sf).select(
        "series_key", "n", "status", "level", "trend", "sse", "alpha", "beta", "gamma")


@query("forecast_eval")
def _feval(spark, sf):
    return I.score(_validation_fit(spark, sf), _filled(spark, sf))


@query("hw_annual")
def _hw_annual(spark, sf):
    return _annual_fit(spark, sf).select(*I.FIT_FIGURES)


@query("forecast_future")
def _ffuture(spark, sf):
    """Projected weeks, and a row with its status for every series too short to fit."""
    return I.future_of(_annual_fit(spark, sf))


# Numeric search and solved first state (I5, I6, I10): the fits that projections should use.


def _bound(found, grid):
    """Squared errors of the full grid, and whether the search stays below them."""
    pair = found.select("series_key", "n", "status", "sse").join(grid.select("series_key", F.col("sse").alias("grid_sse")), "series_key")
    room = F.col("grid_sse") * (1 + 1e-9) + 1e-6
    return pair.select("series_key", "n", "status", "grid_sse", (F.col("sse") <= room).alias("not_above"))


@query("hw_optimised")
def _hw_optimised(spark, sf):
    fits = open_fit(spark, sf, "fit-validation-search",
                    lambda: S.fit(_filled(spark, sf), I.VALIDATION_SEASON, estimated=False, train_only=True))
    return _bound(fits, _validation_fit(spark, sf))


@query("hw_annual_optimised")
def _hw_annual_optimised(spark, sf):
    fits = open_fit(spark, sf, "fit-annual-search", lambda: S.fit(_filled(spark, sf), I.ANNUAL_SEASON, estimated=False))
    return _bound(fits, _annual_fit(spark, sf))


def _digits(c):
    """Six significant digits: the normal equations are solved in another order elsewhere."""
    return F.when(F.col(c).isNotNull(), F.format_string("%.5e", F.col(c)).cast("double")).alias(c)


@query("hw_estimated")
def _hw_estimated(spark, sf):
    """Solved first state at the fixed triple: it and the squared errors of all weeks."""
    fits = S.fit(_filled(spark, sf), I.VALIDATION_SEASON, params=I.FIXED_PARAMS)
    return fits.select("series_key", "n", "status", *(_digits(c) for c in ("level0", "trend0", "sse")))


@query("forecast_eval_optimised")
def _feval_optimised(spark, sf):
    """Holdout scores of the model as a numeric fit gives it: parameters searched, first state solved."""
    fits = open_fit(spark, sf, "fit-validation-solved", lambda: S.fit(_filled(spark, sf), I.VALIDATION_SEASON, train_only=True))
    return I.score(fits, _filled(spark, sf))


@query("forecast_future_optimised")
def _ffuture_optimised(spark, sf):
    return I.future_of(open_fit(spark, sf, "fit-annual-solved", lambda: S.fit(_filled(spark, sf), I.ANNUAL_SEASON)))
