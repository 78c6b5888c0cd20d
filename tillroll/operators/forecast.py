"""Weekly demand series and additive Holt-Winters forecasting for many series
in one Spark job.

* Weekly buckets follow pandas ``resample('W-MON')``: Tuesday..Monday, labelled
  by the closing Monday, empty weeks are 0 (per-series gap-free spine).
* Holt-Winters (additive trend and season) runs per series inside
  ``groupBy(series).applyInPandas``: a series is one group whose length is
  bounded by the calendar span in weeks (not by data volume), and the
  smoothing recursion is inherently sequential.  Inside the group the whole
  parameter grid is evaluated at once with numpy vectors, so one pass over the
  weeks scores every (alpha, beta, gamma).  ``smoothing`` searches the parameters
  and solves the first state instead.
* Initial state: level = mean of season 1, trend = (mean of season 2 − mean of
  season 1) / m, seasonals = season-1 values − level; the recursion starts at
  t = m and its one-step errors give SSE / in-sample MAE.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import week_ending_monday
from .aggregates import covering

ALL_SERIES = "ALL"
HOLDOUT_WEEKS = 13
VALIDATION_SEASON = 13
ANNUAL_SEASON = 52
MAPE_MIN_ACTUAL = 5000.0
FIXED_PARAMS = (0.3, 0.1, 0.2)
GRID_STEPS = tuple(round(0.1 * i, 1) for i in range(1, 10))


# ------------------------------------------------------------------ series
def weekly_series(star, per_country: bool = True) -> DataFrame:
    """Purchase sales (returns excluded) per (series, week).  Series are the
    whole business (``ALL``) and, optionally, each branch country."""
    daily = (covering(star, ("branch_id", "date_key", "is_return"), {}).fact.where(~F.col("is_return"))
             .groupBy("branch_id", "date_key").agg(F.sum("line_total").alias("y")))
    dd = star.dim_date.select("date_key", "date")
    db = star.dim_branches.select("branch_id", "country")
    d = (daily.join(dd, "date_key").join(db, "branch_id", "left")
         .select(F.coalesce(F.col("country"), F.lit("UNKNOWN")).alias("country"),
                 week_ending_monday("date").alias("week"), "y"))
    per = d.groupBy("country", "week").agg(F.sum("y").alias("y"))
    total = per.groupBy("week").agg(F.sum("y").alias("y")).select(
        F.lit(ALL_SERIES).alias("series_key"), "week", "y")
    out = total
    if per_country:
        out = total.unionByName(per.select(F.col("country").alias("series_key"), "week", "y"))
    return out.select("series_key", "week", F.col("y").cast("double").alias("y"))


def gap_fill(weekly: DataFrame) -> DataFrame:
    """Every week between a series' first and last week; missing weeks → 0.

    One pass over the weekly table: per series, the points become a week → y
    map (at most one entry per calendar week, so bounded by the time span, not
    by data volume), and the gap-free spine is generated and looked up."""
    per = weekly.groupBy("series_key").agg(
        F.min("week").alias("lo"), F.max("week").alias("hi"),
        F.map_from_entries(F.collect_list(F.struct("week", "y"))).alias("pts"))
    spine = per.select("series_key", "pts",
                       F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    return spine.select("series_key", "week",
                        F.coalesce(F.element_at("pts", F.col("week")), F.lit(0.0)).alias("y"))


def split_holdout(weekly: DataFrame, n: int = HOLDOUT_WEEKS) -> DataFrame:
    """Flag the last ``n`` weeks of every series as the test part."""
    w = Window.partitionBy("series_key").orderBy(F.col("week").desc())
    return weekly.withColumn("is_test", F.row_number().over(w) <= n)


# ------------------------------------------------------------------ model (numpy)
def _grid(fixed=None, steps=GRID_STEPS):
    if fixed is not None:
        a, b, g = (np.array([v]) for v in fixed)
        return a, b, g
    mesh = np.array(np.meshgrid(steps, steps, steps, indexing="ij")).reshape(3, -1)
    return mesh[0], mesh[1], mesh[2]


def hw_run(y: np.ndarray, m: int, alpha, beta, gamma):
    """Additive Holt-Winters over ``y`` for every parameter triple at once.

    Returns (level, trend, seasonals (G, m), sse, sae, fitted (G, n-m)); season
    slot j = t mod m holds the latest seasonal of that slot."""
    y = np.asarray(y, dtype=float)
    n = len(y)
    g_count = len(alpha)
    first = sum(y[:m]) / m
    second = sum(y[m:2 * m]) / m
    level = np.full(g_count, first)
    trend = np.full(g_count, (second - first) / m)
    season = np.tile(y[:m] - first, (g_count, 1))
    sse = np.zeros(g_count)
    sae = np.zeros(g_count)
    fitted = np.empty((g_count, n - m))
    for t in range(m, n):
        j = t % m
        s_j = season[:, j]
        f = level + trend + s_j
        e = y[t] - f
        fitted[:, t - m] = f
        sse += e * e
        sae += np.abs(e)
        new_level = alpha * (y[t] - s_j) + (1.0 - alpha) * (level + trend)
        trend = beta * (new_level - level) + (1.0 - beta) * trend
        season[:, j] = gamma * (y[t] - new_level) + (1.0 - gamma) * s_j
        level = new_level
    return level, trend, season, sse, sae, fitted


def hw_forecast(level, trend, season, n: int, m: int, h: int) -> np.ndarray:
    """h-step forecasts from the state after the last point (time n-1)."""
    steps = np.arange(1, h + 1)
    return level + steps * trend + season[(n - 1 + steps) % m]


def _fit_best(y, m, fixed=None, steps=GRID_STEPS):
    a, b, g = _grid(fixed, steps)
    level, trend, season, sse, sae, _ = hw_run(y, m, a, b, g)
    k = int(np.argmin(sse))  # first minimum in (alpha, beta, gamma) order
    return dict(alpha=float(a[k]), beta=float(b[k]), gamma=float(g[k]), level=float(level[k]),
                trend=float(trend[k]), season=season[k], sse=float(sse[k]),
                mae_in_sample=float(sae[k] / (len(y) - m)))


def spread(series: DataFrame) -> DataFrame:
    """Spread series over all cores before the per-series fits.

    The weekly data is tiny, so AQE would coalesce every series into one
    partition and run all the (compute-heavy) fits in one task; an explicit
    partition count is kept as is, and a following groupBy reuses it.  The count is
    the larger of the cores seen now and the session's shuffle partitions, since a
    cluster's executors may not have registered yet.  It is never the session's own
    number: an aggregate before it would serve then, and be coalesced."""
    spark = series.sparkSession
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(spark.sparkContext.defaultParallelism, own)
    return series.repartition(n + 1 if n == own else n, "series_key")


FIT_SCHEMA = ("series_key string, n int, status string, level double, trend double, sse double, "
              "alpha double, beta double, gamma double, mae_in_sample double, last_week date, season array<double>")
#: A fit's figures without its state.
FIT_FIGURES = ("series_key", "n", "status", "sse", "mae_in_sample", "alpha", "beta", "gamma")


def _fit_group(m: int, fixed=None, train_only: bool = False, steps=GRID_STEPS):
    def fn(key, pdf):
        pdf = pdf.sort_values("week")
        if train_only:
            pdf = pdf.iloc[:-HOLDOUT_WEEKS] if len(pdf) > HOLDOUT_WEEKS else pdf.iloc[:0]
        y = pdf["y"].to_numpy(dtype=float)
        row = dict(series_key=key[0], n=len(y), status="fitted", level=None, trend=None, sse=None,
                   alpha=None, beta=None, gamma=None, mae_in_sample=None,
                   last_week=pdf["week"].iloc[-1] if len(pdf) else None, season=None)
        if len(y) < 2 * m:
            row["status"] = f"skipped: fewer than {2 * m} weeks"
        else:
            best = _fit_best(y, m, fixed, steps)
            best["season"] = best["season"].tolist()
            row.update(best)
        return pd.DataFrame([row])
    return fn


def fit(series: DataFrame, m: int, fixed=None, train_only: bool = False, steps=GRID_STEPS) -> DataFrame:
    """One row per series: the state after the last point (level, trend, one value per
    season slot), SSE, chosen parameters.  ``steps`` are the values tried for each of
    the three parameters.  Scores and projections are computed from this output, so
    a grid is searched once."""
    return spread(series).groupBy("series_key").applyInPandas(
        _fit_group(m, fixed, train_only, tuple(steps)), FIT_SCHEMA)


def _ahead(h: F.Column, m: int) -> F.Column:
    """h steps after a fit's last point."""
    slot = (F.col("n") - 1 + h) % m
    return F.col("level") + h * F.col("trend") + F.element_at("season", (slot + 1).cast("int"))


def fit_fixed(series: DataFrame, m: int, params=FIXED_PARAMS) -> DataFrame:
    """Holt-Winters with one fixed (alpha, beta, gamma), entirely JVM-side.

    Per series, the weeks are folded with the ``aggregate`` higher-order
    function over the week-sorted array (bounded by the calendar span); the
    state is (level, trend, seasonals, sse, t) and the arithmetic is the same,
    in the same order, as ``hw_run``.  Series shorter than two seasons are
    listed as skipped."""
    a, b, g = (float(v) for v in params)
    a1, b1, g1 = 1.0 - a, 1.0 - b, 1.0 - g
    pts = series.groupBy("series_key").agg(
        F.sort_array(F.collect_list(F.struct("week", "y"))).alias("pts"))
    ys = F.transform("pts", lambda p: p["y"])
    n = F.size(ys)
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    first = total(F.slice(ys, 1, m)) / F.lit(float(m))
    second = total(F.slice(ys, m + 1, m)) / F.lit(float(m))
    init = F.struct(first.alias("l"), ((second - first) / F.lit(float(m))).alias("b"),
                    F.transform(F.slice(ys, 1, m), lambda v: v - first).alias("s"),
                    F.lit(0.0).alias("sse"), F.lit(m).alias("t"))

    def step(acc, y):
        j = acc["t"] % m
        sj = F.element_at(acc["s"], j + 1)
        lb = acc["l"] + acc["b"]
        e = y - (lb + sj)
        nl = F.lit(a) * (y - sj) + F.lit(a1) * lb
        return F.struct(
            nl.alias("l"),
            (F.lit(b) * (nl - acc["l"]) + F.lit(b1) * acc["b"]).alias("b"),
            F.transform(acc["s"], lambda v, i: F.when(i == j, F.lit(g) * (y - nl) + F.lit(g1) * sj)
                        .otherwise(v)).alias("s"),
            (acc["sse"] + e * e).alias("sse"),
            (acc["t"] + 1).alias("t"))

    state = F.aggregate(F.slice(ys, m + 1, F.greatest(n - m, F.lit(1))), init, step)
    ok = n >= 2 * m
    return pts.select(
        "series_key", n.cast("int").alias("n"),
        F.when(ok, F.lit("fitted")).otherwise(F.lit(f"skipped: fewer than {2 * m} weeks")).alias("status"),
        F.when(ok, state["l"]).alias("level"), F.when(ok, state["b"]).alias("trend"),
        F.when(ok, state["sse"]).alias("sse"))


def score(fits: DataFrame, series: DataFrame, m: int = VALIDATION_SEASON, min_actual: float = MAPE_MIN_ACTUAL) -> DataFrame:
    """MAE / RMSE / MAPE (actual > ``min_actual``) / accuracy of fits over the training
    weeks on the weeks held out; a skipped series keeps a row without figures.  Sums
    run in week order, so any engine that adds in that order gets the same bits."""
    test = split_holdout(series).where("is_test").groupBy("series_key").agg(
        F.sort_array(F.collect_list(F.struct("week", "y"))).alias("pts"))
    rows = fits.join(test, "series_key")
    h = F.sequence(F.lit(1), F.size("pts"))
    errors = F.zip_with("pts", h, lambda p, i: F.struct(p["y"].alias("y"), (p["y"] - _ahead(i, m)).alias("e")))
    rows = rows.withColumn("errors", F.when(F.col("status") == "fitted", errors))
    n = F.size("pts").cast("int")
    mean = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / F.size(arr)
    large = F.filter("errors", lambda p: p["y"] > min_actual)
    mape = F.when(F.size(large) > 0, mean(F.transform(large, lambda p: F.abs(p["e"] / p["y"]) * 100.0)))
    out = rows.select("series_key", n.alias("n_test"), mean(F.transform("errors", lambda p: F.abs(p["e"]))).alias("mae"),
                      F.sqrt(mean(F.transform("errors", lambda p: p["e"] * p["e"]))).alias("rmse"), mape.alias("mape"))
    return out.withColumn("accuracy", F.lit(100.0) - F.col("mape"))


def evaluate_holdout(series: DataFrame, steps=GRID_STEPS) -> DataFrame:
    """Validation fit (m=13, grid) on all but the last 13 weeks, scored on those."""
    return score(fit(series, VALIDATION_SEASON, train_only=True, steps=steps), series)


def future_of(fits: DataFrame, h: int = HOLDOUT_WEEKS, m: int = ANNUAL_SEASON) -> DataFrame:
    """The next ``h`` Mondays of every fitted series, and one row with its status, and
    neither week nor value, for every skipped one."""
    fitted = F.col("status") == "fitted"
    steps = F.when(fitted, F.sequence(F.lit(1), F.lit(h))).otherwise(F.array(F.lit(None).cast("int")))
    rows = fits.withColumn("h", F.explode(steps))
    return rows.select("series_key", "h", F.date_add("last_week", 7 * F.col("h")).alias("week"),
                       F.when(fitted, _ahead(F.col("h"), m)).alias("yhat"), "status")


def forecast_future(series: DataFrame, h: int = HOLDOUT_WEEKS, m: int = ANNUAL_SEASON, steps=GRID_STEPS) -> DataFrame:
    """Annual-season model on the full series, projected."""
    return future_of(fit(series, m, steps=steps), h, m)
