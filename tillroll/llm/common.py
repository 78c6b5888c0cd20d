"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import tasks_for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col) -> F.Column:
    """A text column with null read as the empty text."""
    return F.coalesce(col, F.lit(""))


def slices(batch: pa.RecordBatch, text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows whose texts hold about ``limit`` bytes.

    A row is never cut: one very long text is a run of its own.  Whole rows of
    every size are passed on, so only the size of the temporary arrays changes.
    """
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    at = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield batch.slice(at)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, ``spark.checkpoint.dir`` of the session.

    Where it is unset and everything runs in one process (tests) a temporary folder
    is used; on a cluster without the setting this fails instead of writing to one
    machine's disk.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master or ""):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="tillroll-checkpoint-")
        sc.setCheckpointDir(shared)
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the shared folder; the copy has a file a partition."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` in as many partitions as its about ``rows`` rows ask for, as it is where they are not known.

    For each file that a task writes Hadoop's local file system starts processes on the
    executor, so a small table's copy must not have as many as the session has shuffle partitions.
    """
    return df if rows is None else df.coalesce(tasks_for(df.sparkSession, rows))


_STORED: list[str] = []          # tables written by this process and not yet removed


def stored(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """``df`` written as Parquet, with ``options``, to a new place in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid4().hex}.parquet"
    df.write.options(**(options or {})).parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the tables that ``stored`` has written inside, at its end, but for the last one if nothing failed.

    Yields the list of paths that are kept, to be removed by ``remove`` when they have been read.
    """
    since, kept = len(_STORED), []
    try:
        yield kept
        kept += _STORED[-1:] if len(_STORED) > since else []
    finally:
        remove(spark, [p for p in _STORED[since:] if p not in kept])


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables."""
    for p in list(paths):
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if p in _STORED:
            _STORED.remove(p)
