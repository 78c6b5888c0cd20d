"""Time-intelligence measures at month grain, under any grouping and slicer.

Months come from the date dimension (never from the fact): every group that has
sales gets a row for every calendar month, blank (NULL) where it sold nothing.
Slicers on the calendar choose the months that are shown; they do not hide the
earlier months that a shifted measure needs.  All other slicers filter the sales.
Money is summed and shifted in DECIMAL (exact, order-independent) and cast to
DOUBLE at the edge; ratios follow DAX ``DIVIDE(a, b, 0)`` with blank treated as 0
in the subtraction.  Windows here run over the months of one group only.

The calendar's last month may still be open.  A comparison with the year before
then counts the same days only (like for like): a December that ends on the 9th
meets 1-9 December of the year before.  ``whole_months=True`` compares whole months.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..functions.ratios import dax_div
from ..schemas import GUEST_CUSTOMER_ID
from .aggregates import BITMAPS, covering
from .measures import _DIM_COLUMNS, RELATIVE_MONTHS, TIME_MEASURES, apply_where, context

_CALENDAR = {c for c, d in _DIM_COLUMNS.items() if d == "date"} | {"date_key"}
_MONTH = ("year", "month")


def _split(where) -> tuple[dict, dict]:
    """Slicers on the sales and slicers on the calendar."""
    where = dict(where or {})
    calendar = {c: v for c, v in where.items() if c in _CALENDAR or c == RELATIVE_MONTHS}
    return {c: v for c, v in where.items() if c not in calendar}, calendar


def month_spine(dim_date: DataFrame) -> DataFrame:
    return (dim_date.groupBy("year", "month").agg(F.min("date").alias("first_day"))
            .select("year", "month", month_index("year", "month").alias("idx")))


def _months(star, calendar: dict) -> DataFrame:
    """Months (year, month, idx) with a day that the calendar slicers let through."""
    days = star.dim_date
    if RELATIVE_MONTHS in calendar:
        last = days.agg(F.max("date")).scalar()
        days = days.where(F.col("date") > F.add_months(last, -int(calendar[RELATIVE_MONTHS])))
    return month_spine(apply_where(days, {c: v for c, v in calendar.items() if c != RELATIVE_MONTHS}))


def _sales(star, by, sliced: dict, counted: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows, or those of a covering aggregate, after the slicers on the sales, with the grouping columns."""
    unknown = set(by) & _CALENDAR
    if unknown:
        raise ValueError(f"measures over time are given by month; {sorted(unknown)} cannot group them")
    star = covering(star, [*by, *sliced, "date_key", *counted], _DIM_COLUMNS)
    return apply_where(context(star, [*by, *sliced]), sliced)


def monthly_sales(fact: DataFrame, dim_date: DataFrame, by=()) -> DataFrame:
    """DECIMAL net sales per (by…, year, month, idx); the fact is reduced per day
    before meeting the calendar.  ``net_cut`` counts only the days up to the last
    day of the calendar's last month, where that month is open."""
    daily = fact.groupBy(*by, "date_key").agg(F.sum("line_total").alias("net"))
    dd = dim_date.select("date_key", "year", "month", "day")
    end = dim_date.agg(F.max("date")).scalar()
    last_day = F.when(end < F.last_day(end), F.dayofmonth(end)).otherwise(F.lit(31))
    return (daily.join(dd, "date_key").groupBy(*by, "year", "month")
            .agg(F.sum("net").alias("net"), F.sum(F.when(F.col("day") <= last_day, F.col("net"))).alias("net_cut"))
            .withColumn("idx", month_index("year", "month")))


def _growth(cur: F.Column, base: F.Column) -> F.Column:
    return dax_div(F.coalesce(cur, F.lit(0)) - base, base)


def _on_spine(star, by, monthly: DataFrame) -> DataFrame:
    """``monthly`` with a row for every calendar month of each of its groups."""
    by = list(by)
    spine = month_spine(star.dim_date)
    if not by:
        return spine.join(monthly.drop(*_MONTH), "idx", "left")
    # the months of the calendar, one array, unfolded for each group: no join of groups and months
    months = spine.agg(F.sort_array(F.collect_list(F.struct("idx", "year", "month"))).alias("m")).scalar()
    rows = monthly.select(*by).distinct().select(*by, F.explode(months).alias("m")).select(*by, "m.*")
    values = [c for c in monthly.columns if c not in (*by, *_MONTH, "idx")]
    return (rows.unionByName(monthly.select(*by, "idx", *values), allowMissingColumns=True)
            .groupBy(*by, "idx").agg(F.max("year").alias("year"), F.max("month").alias("month"),
                                     *[F.max(c).alias(c) for c in values])
            .where(F.col("year").isNotNull()))


def spine_net(star, by=(), where=None) -> DataFrame:
    """Every calendar month (by…, year, month, idx) with its DECIMAL net sales, NULL
    for a month without sales."""
    sliced, _ = _split(where)
    return _on_spine(star, by, monthly_sales(_sales(star, by, sliced), star.dim_date, by))


def _over(by, *order) -> Window:
    return Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)


def shifted(star, by=(), where=None, whole_months: bool = False) -> DataFrame:
    """Net sales by group and month beside the previous month's, the year to date, and
    both of the year before: (by…, year, month, idx, net, pm, ytd, ly, ly_ytd), DECIMAL."""
    by = list(by)
    m = spine_net(star, by, where)
    line = _over(by, "idx")
    run = Window.partitionBy(*by, "year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    blank = F.lit(0)
    m = (m.withColumn("pm", F.lag("net", 1).over(line))
         .withColumn("ytd", F.sum(F.coalesce("net", blank)).over(run)))
    ly, ly_ytd = F.lag("net", 12).over(line), F.lag("ytd", 12).over(line)
    if not whole_months:
        open_ = F.lead("idx", 1).over(line).isNull()
        beyond = F.lag(F.coalesce("net", blank) - F.coalesce("net_cut", blank), 12).over(line)
        ly_ytd = F.when(open_, ly_ytd - beyond).otherwise(ly_ytd)
        ly = F.when(open_, F.lag("net_cut", 12).over(line)).otherwise(ly)
    m = m.withColumn("ly", ly).withColumn("ly_ytd", ly_ytd)
    _, calendar = _split(where)
    return m.join(_months(star, calendar).select("idx"), "idx", "left_semi") if calendar else m


def prev_month(star, by=(), where=None) -> DataFrame:
    """Net sales, previous *calendar* month, and MoM growth (first month → 0)."""
    m = shifted(star, by, where)
    return m.select(*by, "year", "month",
                    F.col("net").cast("double").alias("net_sales"),
                    F.col("pm").cast("double").alias("net_sales_pm"),
                    _growth(F.col("net"), F.col("pm")).alias("mom_growth"))


def ytd(star, by=(), where=None, whole_months: bool = False) -> DataFrame:
    """Year-to-date, prior-year YTD (same months a year earlier) and YoY growth."""
    m = shifted(star, by, where, whole_months)
    return m.select(*by, "year", "month",
                    F.col("net").cast("double").alias("net_sales"),
                    F.col("ytd").cast("double").alias("sales_ytd"),
                    F.col("ly_ytd").cast("double").alias("sales_ly_ytd"),
                    _growth(F.col("ytd"), F.col("ly_ytd")).alias("yoy_growth"))


def same_store(star, by=("branch_id",), where=None, whole_months: bool = False) -> DataFrame:
    """Same-store growth per group (branch) and month: sales vs the same month one
    year earlier.  Rows exist where the group has sales this month or twelve months
    before (within the calendar) — the rows a visual would show."""
    m = shifted(star, by, where, whole_months).where("net IS NOT NULL OR ly IS NOT NULL")
    return m.select("year", "month", *by,
                    F.col("net").cast("double").alias("net_sales"),
                    F.col("ly").cast("double").alias("sales_ly"),
                    _growth(F.col("net"), F.col("ly")).alias("sssg"))


def _kept_by_rows(star, by: list, sliced: dict) -> DataFrame:
    """(by…, idx, n, r): customers of a month, and those of them that bought in the month before.

    One fact scan reduced to distinct (group, customer, month) — the month index
    comes from the YYYYMMDD key, so no per-day intermediate is shuffled — then
    ``lag`` per customer flags a month whose predecessor month is present.  A
    customer's window holds at most one row per calendar month and group."""
    dk = F.col("date_key")
    idx = month_index(F.floor(dk / 10000), F.floor(dk / 100) % 100)
    cm = (_sales(star, by, sliced, ("customer_id",)).where(F.col("customer_id") != GUEST_CUSTOMER_ID)
          .select(*by, "customer_id", idx.alias("idx")).distinct())
    w = Window.partitionBy(*by, "customer_id").orderBy("idx")
    flagged = cm.withColumn("_back", F.lag("idx", 1).over(w) == F.col("idx") - 1)
    return flagged.groupBy(*by, "idx").agg(F.count(F.lit(1)).alias("n"), F.count_if("_back").alias("r"))


def _kept_by_bitmaps(star, by: list, sliced: dict) -> DataFrame:
    """The same from the stored bitmaps: those of a group's branches are united, and each month's is intersected with
    the one before, bucket by bucket.  What is shuffled is bits, a bucket of them at a time, not customers."""
    rows = apply_where(context(replace(star, fact=star.aggregates[BITMAPS]), [*by, *sliced]), sliced)
    month = rows.groupBy(*by, "idx", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    # a month's bitmap also goes to the month after; where two meet, their common bits are the customers who came back
    sent = month.select(*by, "bucket", "bitmap", F.explode(F.array(
        F.struct(F.col("idx").alias("idx"), F.lit(True).alias("own")), F.struct((F.col("idx") + 1).alias("idx"), F.lit(False).alias("own")))).alias("x"))
    met = sent.groupBy(*by, "bucket", "x.idx").agg(
        F.max(F.when(F.col("x.own"), F.bitmap_count("bitmap"))).alias("n"),
        F.when(F.count(F.lit(1)) == 2, F.bitmap_count(F.bitmap_and_agg("bitmap"))).alias("r"))
    return met.where("n IS NOT NULL").groupBy(*by, "idx").agg(F.sum("n").alias("n"), F.sum(F.coalesce("r", F.lit(0))).alias("r"))


def retention(star, by=(), where=None) -> DataFrame:
    """Monthly retention by group: registered customers of the previous month who
    bought again this month, over the previous month's customers (guests excluded).

    Groups and slicers on branches are answered from stored bitmaps where the star has
    them, others from the fact."""
    by = list(by)
    sliced, calendar = _split(where)
    if BITMAPS in star.aggregates and all(_DIM_COLUMNS.get(c, c) in ("branch", "branch_id") for c in (*by, *sliced)):
        per_month = _kept_by_bitmaps(star, by, sliced)
    else:
        per_month = _kept_by_rows(star, by, sliced)
    m = _on_spine(star, by, per_month)
    m = m.withColumn("p", F.lag("n", 1).over(_over(by, "idx")))
    if calendar:
        m = m.join(_months(star, calendar).select("idx"), "idx", "left_semi")
    p = F.coalesce(F.col("p"), F.lit(0)).cast("long")
    r = F.coalesce(F.col("r"), F.lit(0)).cast("long")
    return m.select(*by, "year", "month", p.alias("customers_prev"), r.alias("customers_retained"),
                    dax_div(r, p).alias("retention_rate"))


_RETENTION = ("customers_prev", "customers_retained", "retention_rate")


def evaluate_monthly(star, measures, by=(), where=None, whole_months: bool = False) -> DataFrame:
    """Measures over time: (by…, year, month) and one column per measure."""
    other = set(measures) - set(TIME_MEASURES) - {"net_sales"}
    if other:
        raise ValueError(f"{sorted(other)} have no monthly form; evaluate them by year and month")
    by = list(by)
    m = shifted(star, by, where, whole_months)
    shown = {"net_sales": F.col("net").cast("double"), "net_sales_pm": F.col("pm").cast("double"),
             "mom_growth": _growth(F.col("net"), F.col("pm")), "sales_ytd": F.col("ytd").cast("double"),
             "sales_ly_ytd": F.col("ly_ytd").cast("double"), "yoy_growth": _growth(F.col("ytd"), F.col("ly_ytd")),
             "sales_ly": F.col("ly").cast("double"), "sssg": _growth(F.col("net"), F.col("ly"))}
    money = [x for x in measures if x in shown]
    keys = [*by, *_MONTH]
    out = m.select(*keys, *[shown[x].alias(x) for x in money])
    people = [x for x in measures if x in _RETENTION]
    if people:
        r = retention(star, by, where).select(*keys, *people)
        out = out.unionByName(r, allowMissingColumns=True).groupBy(*keys).agg(
            *[F.max(x).alias(x) for x in (*money, *people)])
        out = out.fillna(0, subset=people)
    return out.select(*keys, *measures)
