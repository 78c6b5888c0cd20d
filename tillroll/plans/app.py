"""Application flows: what a user of the original pipeline runs end to end.

* ``etl``      – six regional CSV extracts → cleaned lines → star, written to a
                 warehouse folder (the load step).
* ``load``     – the same into a warehouse whose loads are published in one step,
                 and can replace single months or add to them.
* ``views``    – register the warehouse tables as SQL views, so audit and
                 business queries can be written as plain Spark SQL.
* ``forecast`` – weekly series → annual Holt-Winters → next 13 weeks, written
                 as a CSV/parquet table; plus the holdout scores.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import forecast as I
from ..operators import smoothing as S
from ..operators.clean import clean_lines
from ..session import join_path
from ..sources.raw import read_sources, with_line_id
from ..sources.sinks import write_clean, write_forecast
from . import published
from .warehouse import Star, _read_star, build_star

STAR_TABLES = {"dim_date": "dim_date", "dim_customers": "dim_customers",
               "dim_products": "dim_products", "dim_branches": "dim_branches",
               "fact_sales": "fact"}


def raw_from_extracts(spark: SparkSession, extracts: str, **read) -> DataFrame:
    """All six extracts (each must exist), with a line id that depends on the lines alone."""
    return with_line_id(read_sources(spark, extracts, **read))


def run_etl(spark: SparkSession, extracts: str, warehouse: str, **read) -> Star:
    """Extract → clean → dimensions and fact, written under ``warehouse``.  ``read``
    are the options of ``read_sources``."""
    build_star(spark, raw_from_extracts(spark, extracts, **read), warehouse)
    return open_warehouse(spark, warehouse)


def rejected(star: Star) -> DataFrame:
    """Lines that cleaning turned away, by source and reason: a date layout that no
    format fits shows as a whole source without a date."""
    reason = (F.when(F.col("status") != "quarantined", F.col("status"))
               .when(F.col("invoice").isNull(), "no invoice").when(F.col("invoice_date").isNull(), "no date")
               .when(F.col("quantity").isNull(), "no quantity").when(F.col("country").isNull(), "no country")
               .otherwise("amount out of range"))
    return (star.lines.where("status <> 'clean'")
            .groupBy("source_rank", reason.alias("reason")).agg(F.count(F.lit(1)).alias("rows")))


def run_load(spark: SparkSession, extracts: str, warehouse: str, mode: str = "months", **read) -> Star:
    """Extract → clean → one published load of ``warehouse`` (``published.load``): the cleaned
    lines are staged once, since several tables are made of them, and the stage is removed."""
    stage = join_path(warehouse, f"_stage-{uuid.uuid4().hex[:12]}")
    try:
        write_clean(clean_lines(raw_from_extracts(spark, extracts, **read)), stage)
        published.load(spark, warehouse, spark.read.parquet(stage), mode)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(stage)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return open_warehouse(spark, warehouse)


def open_warehouse(spark: SparkSession, warehouse: str, version: int | None = None) -> Star:
    """A warehouse folder of ``run_etl``, or the last (or given) published version of one of ``run_load``."""
    if version is not None or published.versions(spark, warehouse):
        return published.open_published(spark, warehouse, version)
    return _read_star(spark, warehouse, sf_dir="")


def register_views(spark: SparkSession, star: Star, prefix: str = "") -> list[str]:
    """Temp views ``dim_date``, ``dim_customers``, ``dim_products``,
    ``dim_branches`` and ``fact_sales`` (optionally prefixed)."""
    names = []
    for view, attr in STAR_TABLES.items():
        getattr(star, attr).createOrReplaceTempView(prefix + view)
        names.append(prefix + view)
    return names


def run_forecast(star: Star, out: str, fmt: str = "csv", per_country: bool = True, method: str = "search",
                 steps=I.GRID_STEPS) -> dict:
    """Write the 13-week projection, the holdout scores and the fits: in-sample figures,
    chosen parameters, and a status for every series, also the skipped ones.

    ``method`` "search" finds the parameters numerically and solves the first state;
    "grid" tries the triples of ``steps`` from the heuristic state."""
    if method not in ("search", "grid"):
        raise ValueError("method is search or grid")
    series = I.gap_fill(I.weekly_series(star, per_country=per_country))
    if method == "search":
        annual, validation = S.fit(series, I.ANNUAL_SEASON), S.fit(series, I.VALIDATION_SEASON, train_only=True)
    else:
        annual = I.fit(series, I.ANNUAL_SEASON, steps=steps)
        validation = I.fit(series, I.VALIDATION_SEASON, train_only=True, steps=steps)
    spark = series.sparkSession
    state = join_path(out, "forecast_state")
    annual.write.mode("overwrite").parquet(state)
    fits = spark.read.parquet(state)
    write_forecast(I.future_of(fits), join_path(out, "forecast_projections"), fmt)
    write_forecast(I.score(validation, series), join_path(out, "forecast_scores"), fmt)
    write_forecast(fits.select(*I.FIT_FIGURES), join_path(out, "forecast_fits"), fmt)
    return {name: join_path(out, f"forecast_{name}") for name in ("projections", "scores", "fits")}
