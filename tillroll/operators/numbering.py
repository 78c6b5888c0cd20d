"""Order-dependent figures without a window over a whole key or table.

Rows are dealt by ranges of the order itself, so rows of one hot key, or of a table
without any key, are spread over as many tasks as there are ranges.  What a range needs
from those before it is a count or a sum per range, which is small: it grows with the
number of partitions, not with the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted in ranges of ``order`` and written to the checkpoint folder, with ``_part`` and ``_at`` (place in it).

    The copy fixes which range a row is in, whatever is recomputed later."""
    from ..session import checkpoint_base
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_base(spark))
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    return laid.checkpoint().select(*df.columns, F.shiftright("_id", 33).alias("_part"), place.alias("_at"))


def number_rows(df: DataFrame, keys: list[str], order: list[Column], name: str = "row_num") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` for every row; null keys are alike.

    A key's rows stand in one range, or in neighbouring ones if there are many.  Inside a
    range a row's number is its distance from the key's first row there; a key that goes
    on from earlier ranges adds its rows in those, and there are at most as many such
    keys as ranges."""
    laid = _in_ranges(df, [*(F.col(k) for k in keys), *order])
    per = laid.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # a key over several ranges has one short row for each of them
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = per.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"),
                        (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return laid.join(starts, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def running(df: DataFrame, order: list[Column], value: str, rank: str = "rank", total: str = "running", whole: str = "total") -> DataFrame:
    """Every row with its rank in ``order``, the sum of ``value`` up to it, and the sum over all rows.

    The window inside runs over one range; the offsets are a row per range."""
    laid = _in_ranges(df, order)
    parts = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                           F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"), F.sum("_s").over(Window.partitionBy()).alias(whole))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    local = laid.withColumn("_run", F.sum(value).over(inside))
    return local.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_n0") + F.col("_at") + 1).alias(rank), (F.col("_s0") + F.coalesce("_run", F.lit(0))).alias(total), whole)
