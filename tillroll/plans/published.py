"""A warehouse folder whose loads become visible in one step.

A load writes every table to folders of its own and then publishes a manifest: a small
JSON file that names, for each table and month, the folders that hold its rows.  The
manifest's version number is its file name and the file is put in place by one rename
that fails where the name is taken, so of two loads that started from the same version
one is refused.  Until the rename, and after a load that died half-way, readers see the
version before; a reader keeps the manifest it opened, whatever is loaded meanwhile.

The fact, its aggregates and the dimensions' mergeable states are kept by month:

* ``replace``  the warehouse holds this load's lines only (truncate and insert);
* ``months``   the months that occur in the load are replaced, the others stay as they
               are, file for file, so a load can be repeated;
* ``append``   the load's lines are added to their months.

The dimensions are read off the states of all months that the new manifest names, so
they equal those of one build over the lines that are loaded.  Branches that are stored
keep their numbers, because facts of other months refer to them.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import dims as D
from ..operators.fact import fact_sales
from ..schemas import MONTH_PARTITION
from ..session import join_path
from .warehouse import Star

STATES = {"customer_state": D.customer_state, "product_state": D.product_state, "branch_state": D.branch_state}
SETS = (A.SKETCHES, A.BITMAPS)
BY_MONTH = ("fact_sales", *A.KEYS, *SETS, *STATES)
WHOLE = ("dim_date", "dim_customers", "dim_products", "dim_branches", "lines")
MODES = ("replace", "months", "append")
MANIFESTS = "_manifests"


class Conflict(RuntimeError):
    """Another load was published since this one started."""


@dataclass(frozen=True)
class Manifest:
    """One published state: for each table its schema and the folders of each month ("" for a table kept whole)."""

    version: int
    schemas: dict[str, dict]
    folders: dict[str, dict[str, list[str]]]

    def text(self) -> str:
        return json.dumps({"version": self.version, "schemas": self.schemas, "folders": self.folders}, sort_keys=True)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    fs, path = _fs(spark, join_path(root, MANIFESTS))
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def _manifest_path(root: str, version: int) -> str:
    return join_path(root, MANIFESTS, f"v{version:09d}.json")


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    """The published version asked for, or the last one; None where nothing has been published."""
    known = versions(spark, root)
    if not known:
        return None
    if version is not None and version not in known:
        raise ValueError(f"version {version} of {root} was not published, or has been removed")
    text = spark.read.text(_manifest_path(root, known[-1] if version is None else version), wholetext=True).first()[0]
    return Manifest(**json.loads(text))


def _publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    fs, draft = _fs(spark, join_path(root, MANIFESTS, f".draft-{uuid.uuid4().hex}"))
    out = fs.create(draft)
    try:
        out.write(bytearray(manifest.text().encode()))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    target = jvm.org.apache.hadoop.fs.Path(_manifest_path(root, manifest.version))
    never_over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never_over[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(draft, target, never_over)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(target):
            raise Conflict(f"version {manifest.version} of {root} was published by another load") from e
        raise


def _read(spark: SparkSession, root: str, manifest: Manifest, table: str) -> DataFrame:
    """A table as the manifest has it: its files are named one by one, nothing is inferred."""
    schema = T.StructType.fromJson(manifest.schemas[table])
    folders = manifest.folders[table]
    if table in WHOLE:
        paths = [join_path(root, table, f) for f in folders.get("", [])]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    paths = [join_path(root, table, f, f"{MONTH_PARTITION}={m}") for m, fs in sorted(folders.items()) for f in fs]
    if not paths:
        return spark.createDataFrame([], schema)
    columns = [f.name for f in schema.fields]
    with_load = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(with_load).option("basePath", join_path(root, table)).parquet(*paths).select(*columns)


def open_published(spark: SparkSession, root: str, version: int | None = None) -> Star:
    """The star of one published version.  ``lines`` and ``clean`` are the last load's only."""
    manifest = read_manifest(spark, root, version)
    if manifest is None:
        raise FileNotFoundError(f"nothing has been published in {root}")
    return _star(spark, root, manifest)


def _star(spark: SparkSession, root: str, manifest: Manifest) -> Star:
    stored = [t for t in (*A.KEYS, *SETS) if t in manifest.schemas]
    read = {t: _read(spark, root, manifest, t) for t in (*WHOLE, "fact_sales", *stored)}
    return Star(base=root, lines=read["lines"], clean=C.clean_only(read["lines"]), dim_date=read["dim_date"],
                dim_customers=read["dim_customers"], dim_products=read["dim_products"], dim_branches=read["dim_branches"],
                fact=read["fact_sales"], sf_dir="", aggregates={n: read[n] for n in stored})


def _months_in(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    prefix = f"{MONTH_PARTITION}="
    return sorted(n[len(prefix):] for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(prefix))


class _Load:
    """The tables that a load has written so far, over the manifest it started from."""

    def __init__(self, spark: SparkSession, root: str, mode: str):
        self.spark, self.root, self.mode = spark, root, mode
        base = read_manifest(spark, root)
        self.manifest = Manifest(base.version + 1 if base else 1, dict(base.schemas) if base else {}, dict(base.folders) if base else {})
        self.first = base is None
        self.name = f"load=v{self.manifest.version:09d}-{uuid.uuid4().hex[:12]}"

    def read(self, table: str) -> DataFrame:
        return _read(self.spark, self.root, self.manifest, table)

    def written(self, table: str) -> DataFrame:
        """This load's own rows of a month table."""
        folders = {m: [f for f in fs if f == self.name] for m, fs in self.manifest.folders[table].items()}
        own = replace(self.manifest, folders={**self.manifest.folders, table: {m: fs for m, fs in folders.items() if fs}})
        return _read(self.spark, self.root, own, table)

    def write_whole(self, table: str, df: DataFrame, partition: str | None = None) -> None:
        writer = df.write.partitionBy(partition) if partition else df.write
        writer.parquet(join_path(self.root, table, self.name))
        self._note(table, df, {"": [self.name]})

    def write_months(self, table: str, df: DataFrame, sort: tuple[str, ...], keep_others: bool) -> None:
        """Write by month, then name the new folders beside or instead of those that the base manifest has."""
        path = join_path(self.root, table, self.name)
        (df.hint("rebalance", MONTH_PARTITION).sortWithinPartitions(MONTH_PARTITION, *sort)
         .write.partitionBy(MONTH_PARTITION).parquet(path))
        old = self.manifest.folders.get(table, {}) if keep_others else {}
        new = {m: [*(old.get(m, []) if self.mode == "append" else []), self.name] for m in _months_in(self.spark, path)}
        self._note(table, df, {**old, **new})

    def drop(self, table: str) -> None:
        """Leave a table out of the new version."""
        self.manifest.schemas.pop(table, None)
        self.manifest.folders.pop(table, None)

    def _note(self, table: str, df: DataFrame, folders: dict[str, list[str]]) -> None:
        self.manifest.schemas[table] = _nullable(df.schema).jsonValue()
        self.manifest.folders[table] = folders


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _together(*jobs) -> None:
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def load(spark: SparkSession, root: str, lines: DataFrame, mode: str = "months") -> int:
    """Load classified lines (``clean_lines``, best a stored table) and publish the new version, whose number is returned.

    A load without a clean line changes no month (``replace`` then empties the
    warehouse).  If it fails anywhere, or meets a ``Conflict``, nothing has changed.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    job = _Load(spark, root, mode)
    keep = mode != "replace"
    clean = C.clean_only(lines)
    _together(lambda: job.write_whole("lines", lines, "status"),
              *(lambda n=n, state=state: job.write_months(n, state(clean), (), keep) for n, state in STATES.items()))

    stored = job.read("dim_branches") if keep and not job.first else None
    job.write_whole("dim_branches", D.branches_of(job.read("branch_state"), stored).coalesce(1))

    def fact_then_totals() -> None:
        fact = fact_sales(clean, job.read("dim_branches"))
        job.write_months("fact_sales", fact.withColumn(MONTH_PARTITION, F.floor(F.col("date_key") / 100).cast("int")), ("date_key", "sales_id"), keep)
        month = (MONTH_PARTITION,)
        own = job.written("fact_sales")
        # bitmaps are kept while every load's customer numbers are dense
        dense = (not keep or job.first or A.BITMAPS in job.manifest.schemas) and A.dense_customers(own)
        if not dense:
            job.drop(A.BITMAPS)
        sets = [lambda: job.write_months(A.BITMAPS, A.customer_bitmaps(own, month), ("idx",), keep)] if dense else []
        _together(*sets, lambda: job.write_months(A.SKETCHES, A.customer_sketches(own, month), ("date_key",), keep),
                  lambda: job.write_months("agg_invoice", A.aggregate(own, "agg_invoice", month), ("date_key",), keep),
                  lambda: job.write_months("agg_day_product", A.aggregate(own, "agg_day_product", month), ("date_key",), keep))
        job.write_months("agg_day_branch", A.aggregate(job.written("agg_invoice"), "agg_day_branch", month), ("date_key",), keep)

    _together(fact_then_totals,
              lambda: job.write_whole("dim_customers", D.customers_of(job.read("customer_state"))),
              lambda: job.write_whole("dim_products", D.products_of(job.read("product_state"))),
              lambda: job.write_whole("dim_date", D.calendar_of(job.read("branch_state")).coalesce(1)))
    _publish(spark, root, job.manifest)
    return job.manifest.version


def compact(spark: SparkSession, root: str, at_least: int = 2) -> int | None:
    """Rewrite the months that ``at_least`` loads were appended to, one folder each, and publish; None if there are none."""
    job = _Load(spark, root, "months")
    many = {t: [m for m, fs in job.manifest.folders.get(t, {}).items() if len(fs) >= at_least] for t in BY_MONTH}
    many = {t: ms for t, ms in many.items() if ms}
    for table, months in many.items():
        rows = job.read(table).where(F.col(MONTH_PARTITION).isin([int(m) for m in months]))
        if table in A.KEYS:
            rows = A.aggregate(rows, table, (MONTH_PARTITION,))
        job.write_months(table, rows, ("date_key",) if "date_key" in rows.columns else (), True)
    if many:
        _publish(spark, root, job.manifest)
    return job.manifest.version if many else None


def expire(spark: SparkSession, root: str, keep: int = 2, older_than_days: float = 7.0) -> list[str]:
    """Remove all but the last ``keep`` versions, and folders of the given age that no kept version names: those of
    removed versions and of loads that died.  Returns the removed paths."""
    known = versions(spark, root)
    kept = [read_manifest(spark, root, v) for v in known[-max(1, keep):]]
    removed = []
    for v in known[:-max(1, keep)]:
        fs, path = _fs(spark, _manifest_path(root, v))
        fs.delete(path, False)
        removed.append(_manifest_path(root, v))
    limit = (time.time() - older_than_days * 86400) * 1000
    for table in (*BY_MONTH, *WHOLE):
        used = {f for m in kept for fs in m.folders.get(table, {}).values() for f in fs}
        fs, path = _fs(spark, join_path(root, table))
        for status in fs.listStatus(path) if fs.exists(path) else ():
            name = status.getPath().getName()
            if name not in used and status.getModificationTime() <= limit:
                fs.delete(status.getPath(), True)
                removed.append(join_path(root, table, name))
    return removed
