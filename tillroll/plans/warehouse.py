"""The warehouse build: raw lines → cleaned lines → dimensions → fact.

The star is written once per application into the shared checkpoint folder
(``spark.checkpoint.dir``) and every query reads those tables back.  That
cuts the lineage (a lost executor recomputes from parquet, not from the raw
joins), lets later queries use parquet pushdown/pruning, and mirrors the
reference's ETL-then-warehouse flow.

Physical layout of the fact: partitioned by month (``sales_month``, YYYYMM), sorted
by ``date_key`` inside.  Rows are dealt by month before the write, and Spark splits a
large month and joins small ones (a rebalance), so a month is a few files of a useful
size.  Date slicers become filters on the partition column and read their months only.

A build is kept per inputs and code version; ``prune_builds`` removes those that newer
ones replaced.  It comes in three parts, each in a folder of its own: the classified lines,
the dimensions made of them, and the fact with its totals.  A query builds the parts that it
reads; the star's folder names the other two in ``_parts``.
"""

from __future__ import annotations

import hashlib
import importlib
import inspect
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import dims as D
from ..operators.fact import fact_sales
from ..schemas import MONTH_PARTITION
from ..session import checkpoint_base, join_path, tasks_for
from ..sources.sinks import write_clean
from ..sources.fixtures import raw_from_driver_tables


@dataclass
class Star:
    base: str
    lines: DataFrame          # every classified raw line (status column)
    clean: DataFrame          # status = clean
    dim_date: DataFrame
    dim_customers: DataFrame
    dim_products: DataFrame
    dim_branches: DataFrame
    fact: DataFrame
    sf_dir: str
    aggregates: dict[str, DataFrame] = field(default_factory=dict)      # stored totals, see operators.aggregates
    lines_base: str = ""      # folder of the lines, where it is not ``base``


REPORT_FIELDS = ("rows_in", "quarantined", "dropped_price", "dropped_quantity", "rows_out")
_LOCK = threading.RLock()      # a fit that is being built opens the star


def _code_fingerprint() -> str:
    """Version of the code that decides a build's content, also when the package is a zip."""
    h = hashlib.sha1()
    for name in ("sources.raw", "sources.fixtures", "operators.clean", "operators.dims", "operators.fact",
                 "operators.forecast", "operators.smoothing", "operators.aggregates", "plans.warehouse", "functions.text", "functions.dates", "schemas"):
        h.update(inspect.getsource(importlib.import_module(f"tillroll.{name}")).encode())
    return h.hexdigest()[:12]


def _input_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Qualified path plus name, size and modification time of every input file at any
    depth, read through the Hadoop FileSystem of the path (local, HDFS, object stores)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = []
    if fs.exists(path):
        files = fs.listFiles(path, True)
        while files.hasNext():
            st = files.next()
            parts.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return "|".join([str(fs.makeQualified(path)), *sorted(parts)])


def _key_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder of all builds for these inputs and this code version.  The inputs are
    listed on every call, so a changed part file is seen at once."""
    key = hashlib.sha1(f"{_input_fingerprint(spark, sf_dir)}|{_code_fingerprint()}".encode())
    return join_path(checkpoint_base(spark), "tillroll-star", key.hexdigest()[:16])


def prune_builds(spark: SparkSession, older_than_days: float) -> list[str]:
    """Remove builds that a newer one of the same name and inputs replaced, and folders of
    inputs or code versions without a build since, when they are older than the given
    age (no running application should still read them).  Returns the removed paths."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(join_path(checkpoint_base(spark), "tillroll-star"))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = (time.time() - older_than_days * 86400) * 1000
    removed = []
    if not fs.exists(root):
        return removed
    for key in fs.listStatus(root):
        inside = list(fs.listStatus(key.getPath()))
        current = {_current(spark, str(key.getPath()), st.getPath().getName().removeprefix("_current_"))
                   for st in inside if st.getPath().getName().startswith("_current_")}
        current |= {part for p in current if p for part in _parts(spark, p)}
        kept = {p.rstrip("/").rsplit("/", 1)[-1] for p in current if p}
        for st in inside:
            name = st.getPath().getName()
            if name.startswith("_current_") or name in kept or st.getModificationTime() > limit:
                continue
            fs.delete(st.getPath(), True)
            removed.append(str(st.getPath()))
    return removed


def _exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (any scheme)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def _current(spark: SparkSession, key_dir: str, name: str) -> str | None:
    """Path of the last completed build ``name`` under ``key_dir``, if any.

    The pointer is written only after a build finished, so a build that died
    half-way is never picked up; a pointer being replaced just means "build
    again"."""
    pointer = join_path(key_dir, f"_current_{name}")
    if not _exists(spark, pointer):
        return None
    try:
        row = spark.read.parquet(pointer).first()
    except Exception:  # noqa: BLE001 - replaced between the check and the read
        return None
    return row.path if row else None


def _publish(spark: SparkSession, key_dir: str, name: str, path: str) -> None:
    spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").parquet(
        join_path(key_dir, f"_current_{name}"))


def _materialize(spark: SparkSession, sf_dir: str, name: str, build, rebuild: bool = False) -> str:
    """Build once per (inputs, code version); later calls — also from other
    applications sharing the checkpoint folder — reuse the completed build.
    Each build writes to its own folder, so concurrent builders never mix."""
    key_dir = _key_dir(spark, sf_dir)
    with _LOCK:
        path = None if rebuild else _current(spark, key_dir, name)
        if path is None:
            path = join_path(key_dir, f"{name}-{uuid.uuid4().hex[:12]}")
            build(path)
            _publish(spark, key_dir, name, path)
        return path


def write_fact(fact: DataFrame, path: str) -> None:
    """The fact partitioned by month, sorted by day inside its files."""
    by_month = fact.withColumn(MONTH_PARTITION, F.floor(F.col("date_key") / 100).cast("int"))
    (by_month.hint("rebalance", MONTH_PARTITION)
     .sortWithinPartitions(MONTH_PARTITION, "date_key", "sales_id")
     .write.mode("overwrite").partitionBy(MONTH_PARTITION).parquet(path))


def write_aggregates(spark: SparkSession, base: str) -> None:
    """The stored totals of the written fact, each in ranges of days so that a date slicer skips files.

    The invoice and product totals are dealt by their keys' ranges and summed there; the
    day and branch totals are read off the invoice totals.  The customers' sketches and
    bitmaps are kept likewise, by day and by month."""
    fact = spark.read.parquet(join_path(base, "fact_sales"))
    sets = [(A.SKETCHES, A.customer_sketches(fact), "date_key")]
    if A.dense_customers(fact):
        sets.append((A.BITMAPS, A.customer_bitmaps(fact), "idx"))
    for name, rows, order in sets:
        rows.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").parquet(join_path(base, name))
    tasks = tasks_for(spark, fact.count())
    for name in ("agg_invoice", "agg_day_product"):
        (A.aggregate_in_ranges(fact, name, tasks).sortWithinPartitions("date_key")
         .write.mode("overwrite").parquet(join_path(base, name)))
    invoices = spark.read.parquet(join_path(base, "agg_invoice"))
    (A.aggregate(invoices, "agg_day_branch").repartitionByRange("date_key").sortWithinPartitions("date_key")
     .write.mode("overwrite").parquet(join_path(base, "agg_day_branch")))


def build_lines(spark: SparkSession, raw: DataFrame, base: str) -> None:
    """Clean and classify raw lines and write them under ``base``, with their reconciliation."""
    # The reconciliation counts are observed while the lines are written (no
    # second pass) and kept with the completion marker.
    observed = Observation("clean_report")
    lines = C.clean_lines(raw).observe(observed, *C.report_columns())
    write_clean(lines, join_path(base, "lines"))
    report = observed.get
    spark.createDataFrame(
        [(base, *[int(report[k]) for k in REPORT_FIELDS])],
        "star string, " + ", ".join(f"{k} long" for k in REPORT_FIELDS),
    ).write.mode("overwrite").parquet(join_path(base, "_complete"))


def _clean_of(spark: SparkSession, lines_base: str) -> DataFrame:
    return C.clean_only(spark.read.parquet(join_path(lines_base, "lines")))


def build_dims(spark: SparkSession, lines_base: str, base: str) -> None:
    """The dimensions of written lines, as concurrent Spark jobs, so that a small one does not leave the cluster idle."""
    clean = _clean_of(spark, lines_base)

    def write(df: DataFrame, name: str, single_file: bool = False) -> None:
        (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(join_path(base, name))

    jobs = [lambda: write(D.dim_branches(clean), "dim_branches", single_file=True),
            lambda: write(D.dim_date(clean), "dim_date", single_file=True),
            lambda: write(D.dim_customers(clean), "dim_customers"),
            lambda: write(D.dim_products(clean), "dim_products")]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def build_fact(spark: SparkSession, lines_base: str, dims_base: str, base: str) -> None:
    """The fact of written lines and branches, and its stored totals."""
    branches = spark.read.parquet(join_path(dims_base, "dim_branches"))
    write_fact(fact_sales(_clean_of(spark, lines_base), branches), join_path(base, "fact_sales"))
    write_aggregates(spark, base)
    if lines_base != base:
        spark.createDataFrame([(lines_base, dims_base)], "lines string, dims string").coalesce(1).write.mode("overwrite").parquet(
            join_path(base, "_parts"))


def build_star(spark: SparkSession, raw: DataFrame, base: str) -> None:
    """Run the ETL and write every table under ``base``."""
    build_lines(spark, raw, base)
    build_dims(spark, base, base)
    build_fact(spark, base, base, base)


def _parts(spark: SparkSession, base: str) -> tuple[str, str]:
    """Folders of the lines and the dimensions of the star in ``base``."""
    where = join_path(base, "_parts")
    return tuple(spark.read.parquet(where).first()) if _exists(spark, where) else (base, base)


def etl_report(spark: SparkSession, star: "Star") -> dict:
    """Counts observed during the ETL write (rows_in … rows_out)."""
    row = spark.read.parquet(join_path(star.lines_base or star.base, "_complete")).first()
    return {k: row[k] for k in REPORT_FIELDS}


def _read_star(spark: SparkSession, base: str, sf_dir: str) -> Star:
    lines_base, dims_base = _parts(spark, base)
    r = lambda name, where=base: spark.read.parquet(join_path(where, name))
    lines = r("lines", lines_base)
    return Star(base=base, lines=lines, clean=C.clean_only(lines),
                dim_date=r("dim_date", dims_base), dim_customers=r("dim_customers", dims_base),
                dim_products=r("dim_products", dims_base), dim_branches=r("dim_branches", dims_base),
                fact=r("fact_sales"), sf_dir=sf_dir, lines_base=lines_base,
                aggregates={name: r(name) for name in (*A.KEYS, A.SKETCHES, A.BITMAPS) if _exists(spark, join_path(base, name))})


_OPEN: dict = {}


def _lines_base(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    return _materialize(spark, sf_dir, "lines", lambda path: build_lines(spark, raw_from_driver_tables(spark, sf_dir), path), rebuild)


def _dims_base(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    return _materialize(spark, sf_dir, "dims", lambda path: build_dims(spark, _lines_base(spark, sf_dir), path), rebuild)


def open_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified lines of the driver tables in ``sf_dir`` (written on first use), without the star made of them."""
    return spark.read.parquet(join_path(_lines_base(spark, sf_dir), "lines"))


def open_dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One dimension of the driver tables; lines and dimensions are written on first use, not the fact."""
    return spark.read.parquet(join_path(_dims_base(spark, sf_dir), name))


def open_star(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Star:
    """Star for the driver tables in ``sf_dir`` (built on first use; the table
    readers are created once per build and session)."""
    def build(path: str) -> None:
        lines_base = _lines_base(spark, sf_dir, rebuild)
        build_fact(spark, lines_base, _dims_base(spark, sf_dir, rebuild), path)

    base = _materialize(spark, sf_dir, "star", build, rebuild)
    key = (spark.sparkContext.applicationId, id(spark), base)
    with _LOCK:
        star = _OPEN.get(key)
        if star is None:
            star = _OPEN[key] = _read_star(spark, base, sf_dir)
    return star


def open_extracts(spark: SparkSession, sf_dir: str) -> str:
    """The six regional CSV extracts derived from the driver tables (written once),
    as the regional systems would deliver them."""
    from ..sources.raw import write_sources
    return _materialize(spark, sf_dir, "extracts",
                        lambda path: write_sources(raw_from_driver_tables(spark, sf_dir), path))


def load_star(star: Star, folder: str) -> str:
    """Warehouse load into a new place under ``folder``: dimensions first, the fact last.
    Returns the path; earlier loads stay as they are."""
    path = join_path(folder, f"load-{uuid.uuid4().hex[:12]}")
    for name in ("dim_date", "dim_customers", "dim_products", "dim_branches"):
        getattr(star, name).write.parquet(join_path(path, name))
    write_fact(star.fact, join_path(path, "fact_sales"))
    return path


def open_fit(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A fit that several queries read, searched once per inputs and code version."""
    path = _materialize(spark, sf_dir, name, lambda p: build().write.parquet(p))
    return spark.read.parquet(path)
