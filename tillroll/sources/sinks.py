"""Sinks: cleaned flat file, star tables, forecast table, optional JDBC load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import FACT_COLUMNS


def write_clean(df: DataFrame, path: str) -> None:
    """Cleaned flat lines, one parquet dataset; ``status`` is a partition column so
    rejected rows stay auditable and clean reads prune to ``status=clean``."""
    df.write.mode("overwrite").partitionBy("status").parquet(path)


def read_clean(spark: SparkSession, path: str, status: str = "clean") -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(df.status == status) if status else df


def write_forecast(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)


def write_star_jdbc(star, url: str, properties: dict | None = None,
                    batchsize: int = 50_000) -> None:
    """Load the star into a relational warehouse with Spark's JDBC writer:
    dimensions first, fact last; each table truncated then appended in batches.
    Credentials come only from ``properties`` (never from code)."""
    props = dict(properties or {})
    tables = [("dim_date", star.dim_date), ("dim_customers", star.dim_customers),
              ("dim_products", star.dim_products),
              ("dim_branches", star.dim_branches.select("branch_id", "branch_name", "country")),
              ("fact_sales", star.fact.select(*FACT_COLUMNS))]
    for name, df in tables:
        (df.write.format("jdbc").mode("overwrite")
           .option("url", url).option("dbtable", name)
           .option("truncate", "true").option("batchsize", str(batchsize))
           .options(**props).save())
