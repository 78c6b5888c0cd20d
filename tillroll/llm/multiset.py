"""Homomorphic multiset hash of a text's paragraphs (operator 9), in DataFrame functions only.

A text is the multiset of its paragraphs (lines, cut further at sentence ends).
Each paragraph is hashed to a wide vector of bits, and the vectors are added lane by
lane modulo 2^20.  The sum does not depend on the order, equal texts have equal
sums, and a paragraph is inserted or deleted by adding or subtracting its vector.
Lanes are kept three to a 64-bit integer with a guard bit between them, so one
addition serves three lanes.  A lane that counts c ones among n paragraphs stands
for the random-sign sum 2c - n; the cosine of two such vectors estimates the
likeness of the two multisets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of
from .hilbert import string_slots

LANE_BITS, STRIDE, PER_WORD = 20, 21, 3
ONES = sum(1 << (STRIDE * i) for i in range(PER_WORD))                          # the lowest bit of each lane
MASK = sum(((1 << LANE_BITS) - 1) << (STRIDE * i) for i in range(PER_WORD))     # all bits of the lanes
SALTS = ("", "\u0001")                                                          # one hash each; 63 lanes a hash
PARAGRAPH = r"(?<=[.!?|])\s+|\n+"


def paragraphs(text: Column) -> Column:
    """The text's paragraphs; none for an empty text."""
    return F.filter(F.split(text, PARAGRAPH, -1), lambda p: F.length(p) > 0)


def fingerprint(parts: Column) -> Column:
    """Array of integers: the number of paragraphs, then the lanes, three in each.

    One fold over the paragraphs' hashes adds all lanes at once; the paragraphs are
    found and hashed once.
    """
    hashes = F.transform(parts, lambda p: F.struct(
        *(F.xxhash64(F.concat(F.lit(s), p) if s else p).alias(f"h{i}") for i, s in enumerate(SALTS))))
    lanes = [(i, j) for i in range(len(SALTS)) for j in range(STRIDE)]
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("n"), *(zero.alias(f"l{i}_{j}") for i, j in lanes))

    def add(acc, x):
        one = lambda i, j: F.shiftrightunsigned(x[f"h{i}"], j).bitwiseAND(F.lit(ONES))
        return F.struct((acc["n"] + 1).alias("n"), *(
            (acc[f"l{i}_{j}"] + one(i, j)).bitwiseAND(F.lit(MASK)).alias(f"l{i}_{j}") for i, j in lanes))

    return F.aggregate(hashes, start, add, lambda acc: F.array(acc["n"], *(acc[f"l{i}_{j}"] for i, j in lanes)))


def insert(one: Column, other: Column) -> Column:
    """Fingerprint of the two multisets together.  Both arguments are columns that hold fingerprints already."""
    return _merge(one, other, lambda a, b: (a + b).bitwiseAND(MASK), 1)


def delete(whole: Column, part: Column) -> Column:
    """Fingerprint of ``whole`` without the paragraphs of ``part``, which it must hold."""
    guard = ONES << LANE_BITS
    return _merge(whole, part, lambda a, b: (a.bitwiseOR(F.lit(guard)) - b).bitwiseAND(MASK), -1)


def _merge(a: Column, b: Column, lanes, sign: int) -> Column:
    n = F.element_at(a, 1) + sign * F.element_at(b, 1)
    rest = F.zip_with(F.slice(a, 2, len(SALTS) * STRIDE), F.slice(b, 2, len(SALTS) * STRIDE), lanes)
    return F.concat(F.array(n), rest)


def as_text(fp: Column) -> Column:
    """Sixteen lower-case hex digits for each integer."""
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _signs(fp: Column) -> Column:
    n = F.element_at(fp, 1)
    low = (1 << LANE_BITS) - 1
    lanes = F.flatten(F.transform(F.slice(fp, 2, len(SALTS) * STRIDE), lambda x: F.array(
        *(F.shiftright(x, STRIDE * i).bitwiseAND(low) for i in range(PER_WORD)))))
    return F.transform(lanes, lambda c: (2 * c - n).cast("double"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def likeness(a: Column, b: Column, sa: Column, sb: Column) -> Column:
    """Estimated likeness, 0 to 1: 1 for equal fingerprints, 0 where only one text is empty."""
    dot = _sum(F.zip_with(sa, sb, lambda x, y: x * y))
    size = F.sqrt(_sum(F.transform(sa, lambda x: x * x)) * _sum(F.transform(sb, lambda x: x * x)))
    return F.when(a == b, 1.0).when(size == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot / size)))


RANGES = 4               # ranges of ids for each shuffle partition, so that those that share a task even out


def _with_range(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with ``__range``, the number of cuts below the row's id; -1 for null ids.

    Cuts are approximate quantiles.  A row finds those near its id by an equal-width
    bucket, in a table of as many rows as there are cuts, so neither the plan nor a
    row's work grows with their number.  Strings are cut by the number that their first
    differing bytes make, which keeps their order.
    """
    n = RANGES * max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema[id_col].dataType.typeName()
    if kind in ("byte", "short", "integer", "long", "float", "double"):
        key = F.col(id_col)
    else:
        docs = docs.withColumn("__text_id", F.col(id_col).cast("string"))
        key = string_slots(docs.select("__text_id"), ["__text_id"])["__text_id"][0]
    keyed = docs.withColumn("__key", F.when(F.col(id_col).isNotNull(), key))
    found = keyed.agg(F.percentile_approx("__key", [i / n for i in range(1, n)] or [0.5], 10_000).alias("cuts"),
                      F.min("__key").alias("lo"), F.max("__key").alias("hi")).first()
    cuts = sorted(set(found["cuts"] or ()))
    lo, buckets = float(found["lo"] or 0), len(cuts) + 1
    width = (float(found["hi"] or 0) - lo) / buckets or 1.0
    place = lambda x: min(max(math.floor((float(x) - lo) / width), 0), buckets - 1)
    near: list[list] = [[] for _ in range(buckets)]
    for c in cuts:
        near[place(c)].append(c)
    rows, before = [], 0
    for i, own in enumerate(near):
        rows.append((i, own, before))
        before += len(own)
    table = docs.sparkSession.createDataFrame(rows, f"__bucket int, __cuts array<{keyed.schema['__key'].dataType.simpleString()}>, __before int")
    bucket = F.least(F.greatest(F.floor((F.col("__key").cast("double") - lo) / width), F.lit(0)), F.lit(buckets - 1)).cast("int")
    keyed = keyed.withColumn("__bucket", F.coalesce(bucket, F.lit(0))).join(F.broadcast(table), "__bucket")
    below = F.col("__before") + F.size(F.filter("__cuts", lambda c: c < F.col("__key")))
    return keyed.withColumn("__range", F.when(F.col("__key").isNull(), -1).otherwise(below)).drop("__key", "__bucket", "__cuts", "__before", "__text_id")


def with_next(docs: DataFrame, id_col: str, carried: list[str], derive=lambda df: df) -> DataFrame:
    """Each row with ``next``, a struct of the carried columns of the row after it by id (after the last: the first).

    ``derive`` adds columns that may be carried; they are made after the first rows of
    the ranges have been picked, so of those and of all rows once.

    Null ids come first, equal ids go by the carried columns.  Ids are cut into ranges,
    so the order is found range by range; the first row of each range is also sent, as a
    guest, to the range before it.  What reaches the driver is a few ids a range.
    """
    spark = docs.sparkSession
    ranged = _with_range(docs, id_col)
    firsts = sorted(((r["__range"], r["first"]) for r in
                     ranged.groupBy("__range").agg(F.min(id_col).alias("first")).collect()), key=lambda x: x[0])
    payload = F.struct(*carried)
    rows = derive(ranged).withColumn("__guest", F.lit(0))
    if firsts:
        moves = [(r, first, firsts[i - 1][0]) for i, (r, first) in enumerate(firsts)]        # a row a range
        moves = spark.createDataFrame(moves, f"__range int, __first {docs.schema[id_col].dataType.simpleString()}, __to int")
        heads = ranged.join(F.broadcast(moves), "__range").where(F.col(id_col).eqNullSafe(F.col("__first")))
        heads = derive(heads).groupBy("__to", id_col).agg(F.min(payload).alias("__head"))
        guests = heads.select(id_col, "__head.*", F.col("__to").alias("__range"), F.lit(1).alias("__guest"))
        rows = rows.unionByName(guests, allowMissingColumns=True)
    order = Window.partitionBy("__range").orderBy("__guest", F.col(id_col).asc_nulls_first(), *carried)
    return (rows.withColumn("next", F.lead(payload).over(order)).where("__guest = 0").drop("__guest", "__range"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text replaces the last quarter of the code points by the first as
    many (or all) of the next document, by ascending id (after the last: the first).
    Null text is read as empty, whose fingerprint is all zeros; null ids come first,
    equal ids are ordered by text; repeated rows give a row each; a lone document is
    its own next one; an empty table gives no rows.
    """
    base = docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col].cast("string")).alias("text"))
    df = with_next(base, "doc_id", ["text", "fp"], lambda df: df.withColumn("fp", fingerprint(paragraphs(F.col("text")))))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    df = df.select("doc_id", n.cast("long").alias("n_chars"), "fp", F.col("next.fp").alias("next_fp"),
                   F.concat(F.substring(F.col("text"), F.lit(1), n - cut),
                            F.substring(F.col("next.text"), F.lit(1), cut)).alias("edited"))
    df = df.withColumn("edited_sha256", F.sha2("edited", 256)).withColumn("edited_fp", fingerprint(paragraphs(F.col("edited"))))
    df = df.drop("edited")
    for c in ("fp", "edited_fp", "next_fp"):
        df = df.withColumn("s_" + c, _signs(F.col(c)))
    return df.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
                     as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                     likeness(F.col("fp"), F.col("edited_fp"), F.col("s_fp"), F.col("s_edited_fp")).alias("near_edited"),
                     likeness(F.col("fp"), F.col("next_fp"), F.col("s_fp"), F.col("s_next_fp")).alias("near_next"))
