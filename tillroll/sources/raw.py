"""Regional raw extracts: routing, CSV read/write, typing and union.

A raw extract is a headered CSV with the eight text columns of
``schemas.RAW_HEADER``.  Six regional extracts exist; their fixed order
(``source_rank``) stands in for the file order of the original load, which the
branch dimension uses for "first appearance".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import na_to_null
from ..schemas import RAW_HEADER

# The six regional extracts in load order and the country lists
# that route rows to them (UK is additionally split by a date cut-off).
SOURCES = (
    "uk_before_cutoff",
    "uk_from_cutoff",
    "europe_north",
    "europe_south",
    "asia_pacific",
    "rest_of_world",
)
UK = "United Kingdom"
EUROPE_NORTH = ("EIRE", "Germany", "Netherlands", "France")
EUROPE_SOUTH = ("Spain", "Portugal", "Switzerland", "Belgium", "Italy")
ASIA_PACIFIC = ("Australia", "Japan", "Singapore", "Hong Kong")

_SNAKE = dict(zip(RAW_HEADER, ("invoice", "stock_code", "description", "quantity",
                               "invoice_date", "price", "customer_id", "country")))
_CSV_OPTS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "escape": '"',
}


def source_rank_of(source: Column) -> Column:
    expr = None
    for rank, name in enumerate(SOURCES, 1):
        expr = (F.when(source == name, F.lit(rank)) if expr is None
                else expr.when(source == name, F.lit(rank)))
    return expr.cast("int")


def route_sources(df: DataFrame, uk_cutoff: str) -> DataFrame:
    """Label every raw row with the extract it belongs to.

    Anything not matched — including a NULL country, for which ``IN`` is NULL —
    falls to rest-of-world.  A UK row without a date goes to the first UK
    extract (the original split loses it; rows are never dropped here).
    """
    country = F.col("country")
    cutoff = F.lit(uk_cutoff).cast("timestamp_ntz")
    source = (F.when((country == UK) & (F.col("invoice_date") >= cutoff), F.lit(SOURCES[1]))
               .when(country == UK, F.lit(SOURCES[0]))
               .when(country.isin(*EUROPE_NORTH), F.lit(SOURCES[2]))
               .when(country.isin(*EUROPE_SOUTH), F.lit(SOURCES[3]))
               .when(country.isin(*ASIA_PACIFIC), F.lit(SOURCES[4]))
               .otherwise(F.lit(SOURCES[5])))
    return df.withColumn("source", source).withColumn("source_rank", source_rank_of(F.col("source")))


def split_extract(spark: SparkSession, raw_path: str, out: str, uk_cutoff: str, **read) -> None:
    """Split one raw data set into the six regional extracts under ``out``."""
    write_sources(route_sources(read_raw(spark, raw_path, **read), uk_cutoff), out)


def write_sources(df: DataFrame, path: str) -> None:
    """Write one headered CSV extract per source (``source=<name>/`` folders)."""
    out = df.select(*[F.col(snake).alias(hdr) for hdr, snake in _SNAKE.items()], "source")
    (out.write.mode("overwrite").partitionBy("source").options(**_CSV_OPTS).csv(path))


#: Date layouts tried in order where a source names none: ISO, then month-first as pandas reads it.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
                "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy")
_BROKEN = "_broken_record"


def parse_date(text: Column, formats=DATE_FORMATS) -> Column:
    """The first layout that fits; NULL (later quarantined) if none does."""
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(text.try_cast("timestamp_ntz"), *tries)


def type_raw(df: DataFrame, date_formats=DATE_FORMATS) -> DataFrame:
    """Text extract → typed raw line.  Header names are stripped (B1), pandas NA
    tokens become NULL, numbers and dates are parsed so that a bad value is NULL
    (and later quarantined) instead of failing the job.  Columns go by name."""
    df = df.toDF(*[c.strip() for c in df.columns])
    cols = []
    for hdr, snake in _SNAKE.items():
        if hdr in df.columns:
            cols.append(na_to_null(F.col(f"`{hdr}`")).alias(snake))
        else:
            cols.append(F.lit(None).cast("string").alias(snake))
    extra = [c for c in df.columns if c not in _SNAKE]
    t = df.select(*cols, *extra)
    return (t.withColumn("quantity", F.col("quantity").try_cast("double").try_cast("int"))
             .withColumn("invoice_date", parse_date(F.col("invoice_date"), date_formats))
             .withColumn("price", F.col("price").try_cast("double"))
             .withColumn("customer_id", F.col("customer_id").try_cast("double")))


def read_raw(spark: SparkSession, path: str, multi_line: bool = False, date_formats=DATE_FORMATS,
             on_broken: str = "fail") -> DataFrame:
    """Read one extract (file or folder).  A missing path raises
    ``AnalysisException`` (PATH_NOT_FOUND): the load must not silently skip a region.

    Files of one folder must agree on their header: a file with other columns, or
    the same in another order, fails the read instead of swapping values.  A record
    with too many or too few fields — as a quoted line break gives when the file is
    read line by line — fails the read too, or with ``on_broken="quarantine"``
    loses its invoice, so that cleaning quarantines it.  ``multi_line`` reads quoted
    line breaks as part of the field, at the price of one task per file."""
    options = {**_CSV_OPTS, "enforceSchema": "false", "multiLine": str(multi_line).lower()}
    header = spark.read.options(**options).csv(path)
    data = [f for f in header.schema.fields if f.name not in _partition_columns(header)]
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in data] + [T.StructField(_BROKEN, T.StringType())])
    df = spark.read.schema(schema).options(**options, columnNameOfCorruptRecord=_BROKEN, mode="PERMISSIVE").csv(path)
    broken = F.col(_BROKEN)
    first = next((c for c in df.columns if c.strip() == RAW_HEADER[0]), None)
    if first is not None:
        bad = (F.raise_error(F.concat(F.lit(f"broken record under {path}: "), broken)).cast("string") if on_broken == "fail"
               else F.lit(None).cast("string"))
        df = df.withColumn(first, F.when(broken.isNotNull(), bad).otherwise(F.col(f"`{first}`")))
    return type_raw(df.drop(_BROKEN), date_formats)


def _partition_columns(df: DataFrame) -> set[str]:
    """Columns that come from the folder names (``source=...``)."""
    return {"source"} & set(df.columns)


def with_line_id(df: DataFrame) -> DataFrame:
    """``line_id``: 40 bits of a hash of the whole line, then 23 bits numbering the lines that share it.

    It depends on the lines alone, not on how the files were split, and it is unique
    up to eight million equal lines."""
    cols = sorted(df.columns)
    keyed = df.withColumn("_hash", F.xxhash64(*cols).bitwiseAND((1 << 40) - 1))
    number = F.row_number().over(Window.partitionBy("_hash").orderBy(*cols))
    return keyed.withColumn("line_id", F.shiftleft("_hash", 23) + number).drop("_hash")


def union_sources(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL aligned by column name; columns missing in one input are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_sources(spark: SparkSession, path: str, sources=SOURCES, date_formats: dict | None = None,
                 multi_line: tuple = (), on_broken: str = "fail") -> DataFrame:
    """Read the regional extracts one by one (each must exist) and union them by
    column name, with their fixed load rank.  ``date_formats`` gives a source its own
    layouts, ``multi_line`` names the sources with quoted line breaks."""
    parts = []
    for pos, name in enumerate(sources, 1):
        rank = SOURCES.index(name) + 1 if name in SOURCES else pos
        formats = (date_formats or {}).get(name, DATE_FORMATS)
        parts.append(read_raw(spark, f"{path.rstrip('/')}/source={name}", name in multi_line, formats, on_broken)
                     .withColumn("source", F.lit(name))
                     .withColumn("source_rank", F.lit(rank)))
    return union_sources(parts)
