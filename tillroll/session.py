"""Session helpers: one place for the configs the library relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app_name: str = "tillroll",
                shuffle_partitions: int | None = None,
                local_memory: str = "8g") -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    On a cluster the master and most sizing come from spark-submit; only the
    semantic settings (UTC session zone, AQE) are forced here.  A local master
    runs every task inside the driver JVM, whose default heap (1g) starves
    concurrent parquet writers, so local sessions get ``local_memory``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", local_memory)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """Shared folder for materialised tables: ``spark.checkpoint.dir`` of the session
    or the context's checkpoint folder.

    Only a session that runs in one process (a local master, as in tests) may do
    without: it gets a private temp folder.  On a cluster every executor would
    write such a folder on its own disk, so there the missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master or ""):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Rows that a task sorts or aggregates at most, and those below which another task is not worth its start.
ROWS_MOST, ROWS_LEAST = 500_000, 20_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks among which so many rows are dealt: as many as the rows ask for, whatever the
    session's number of shuffle partitions, so that a task's memory does not grow with the input."""
    return max(1, -(-rows // ROWS_MOST), min(spark.sparkContext.defaultParallelism, -(-rows // ROWS_LEAST)))


def join_path(base: str, *parts: str) -> str:
    if "://" in base or base.startswith("file:"):
        return "/".join([base.rstrip("/"), *parts])
    return os.path.join(base, *parts)
