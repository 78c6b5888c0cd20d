"""Sharding along a Hilbert curve (operator 13), in DataFrame functions only.

Several metadata dimensions of a document (language, source, size) are quantised to
cells of about equal numbers of rows, the cells are turned into the index of a Hilbert
curve through their grid, and the documents are sorted by that index.  Runs of the
order become shards, so every shard covers a small box in each dimension and a reader
that asks for one language, source or size skips most files by their statistics.

Only narrow rows (id, size, checksum, cells) are shuffled.  The rank of a row is its
place in its range partition plus the rows of the partitions before it: no window
runs over a cell, so a source that holds a third of all rows is split like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, text_of

BITS = 8                 # cells of a dimension: 2^8
FINE = 4096              # slots of a dimension's histogram, before they are merged to cells
IMAGE_BYTES = 6          # bytes of a string that its slot is read from, after the common prefix
MANTISSA = 6             # bits of a number kept below its highest one
DIMENSIONS = ("lang", "source", "size")


def _div(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def number_slot(x: Column) -> Column:
    """Slot of a whole number: its highest bit and the six below it, so in order of size; 0 for null, zero and less."""
    top = F.length(F.bin(x)) - 1
    bits = F.when(top >= MANTISSA, F.call_function("shiftright", x, top - MANTISSA)).otherwise(
        F.call_function("shiftleft", x, MANTISSA - top))
    return F.when(x > 0, top * (1 << MANTISSA) + bits.bitwiseAND((1 << MANTISSA) - 1) + 1).otherwise(0).cast("int")


def string_slots(df: DataFrame, names: list[str]) -> dict[str, tuple[Column, Column]]:
    """Image and slot of each string column; 0 and 0 for null.

    The image is the number that the first bytes make which not all values share, and
    the slot its place between the images of the least and the greatest value.  Two
    values a column reach the driver.
    """
    if not names:
        return {}
    ends = df.agg(*(f(n).alias(f"{w}_{n}") for n in names for w, f in (("lo", F.min), ("hi", F.max)))).first()
    out = {}
    for n in names:
        lo, hi = ((ends[f"{w}_{n}"] or "").encode("utf-8", "surrogatepass") for w in ("lo", "hi"))
        skip = next((i for i, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
        first, last = (int.from_bytes(v[skip:skip + IMAGE_BYTES].ljust(IMAGE_BYTES, b"\0"), "big") for v in (lo, hi))
        digits = F.substring(F.hex(F.encode(F.col(n), "UTF-8")), 2 * skip + 1, 2 * IMAGE_BYTES)
        image = F.conv(F.rpad(digits, 2 * IMAGE_BYTES, "0"), 16, 10).cast("long")
        slot = _div((image - F.lit(first)) * (FINE - 1), last - first + 1) + 1
        out[n] = tuple(F.when(F.col(n).isNull(), 0).otherwise(c).cast(t) for c, t in ((image + 1, "long"), (slot, "int")))
    return out


def cells_of(rows: DataFrame, slots: list[str], bits: int = BITS) -> DataFrame:
    """(dim, slot, cell): the cell, 0 to 2^bits - 1, of every slot, so that cells hold about equal numbers of rows.

    A slot's cell is the share of the rows in smaller slots.  The histogram has at most
    ``FINE`` + 1 rows a dimension, whatever the number of rows, so it is small enough to
    be sent to every task.
    """
    hist = (rows.select(F.explode(F.array(*(F.struct(F.lit(s).alias("dim"), F.col(s).alias("slot")) for s in slots))).alias("x"))
            .groupBy("x.dim", "x.slot").agg(F.count(F.lit(1)).alias("n")))
    below = Window.partitionBy("dim").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("dim")
    return checkpointed(hist.select("dim", "slot", _div(F.coalesce(F.sum("n").over(below), F.lit(0)) * (1 << bits),
                                                        F.sum("n").over(whole)).cast("int").alias("cell")))


def with_cells(df: DataFrame, slots: list[str], cells: DataFrame) -> DataFrame:
    """``df`` with a column ``<slot>_cell`` for each of its slot columns."""
    for s in slots:
        one = cells.where(F.col("dim") == s).select(F.col("slot").alias(s), F.col("cell").alias(f"{s}_cell"))
        df = df.join(F.broadcast(one), s)
    return df


def curve_index(df: DataFrame, cells: list[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """``df`` with the Hilbert index of the cells: the axes are turned back level by level, Gray coded and interleaved.

    Every level is a projection, so the whole stays in generated code.
    """
    x = [f"__x{i}" for i in range(len(cells))]
    df = df.withColumns({a: F.col(c).cast("long") for a, c in zip(x, cells)})
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        first, turned = F.col(x[0]), {}
        for i, a in enumerate(x):
            own = first if i == 0 else F.col(a)
            inverted = own.bitwiseAND(1 << level) != 0
            swap = first.bitwiseXOR(own).bitwiseAND(low)
            if i:
                turned[a] = F.when(inverted, own).otherwise(own.bitwiseXOR(swap))
            first = F.when(inverted, first.bitwiseXOR(F.lit(low))).otherwise(first.bitwiseXOR(swap) if i else first)
        df = df.withColumns(turned | {x[0]: first})
    for a, b in zip(x, x[1:]):
        df = df.withColumn(b, F.col(b).bitwiseXOR(F.col(a)))
    df = df.withColumn("__t", F.shiftright(x[-1], 1))
    step = 1
    while step < bits:                      # each bit becomes the parity of the bits from it upwards
        df = df.withColumn("__t", F.col("__t").bitwiseXOR(F.shiftright("__t", step)))
        step *= 2
    df = df.withColumns({a: F.col(a).bitwiseXOR(F.col("__t")) for a in x})
    index = F.lit(0).cast("long")
    for level in range(bits):
        for i, a in enumerate(reversed(x)):
            index = index.bitwiseOR(F.shiftleft(F.shiftright(a, level).bitwiseAND(1), level * len(x) + i))
    return df.withColumn(name, index).drop("__t", *x)


def _columns(docs: DataFrame, id_col: str, text_col: str, dimensions: tuple[str, ...]) -> dict[str, Column]:
    """Columns of ``docs`` that sharding works on: __id, __size, __crc and for each dimension its
    image ``__k_<i>`` and slot ``__s_<i>``."""
    missing = [d for d in dimensions if d != "size" and d not in docs.columns]
    if not dimensions or missing:
        raise ValueError(f"no such dimension: {missing}" if missing else "give at least one dimension")
    text = F.encode(text_of(docs[text_col].cast("string")), "UTF-8")
    out: dict[str, Column] = {"__id": docs[id_col], "__size": (F.octet_length(text) + 1).cast("long"), "__crc": F.crc32(text)}
    whole = ("byte", "short", "integer", "long")
    strings = [d for d in dimensions if d != "size" and docs.schema[d].dataType.typeName() not in whole]
    slots = string_slots(docs.select(*(docs[d].cast("string").alias(d) for d in strings)), strings)
    for i, d in enumerate(dimensions):
        number = F.coalesce(out["__size"] if d == "size" else docs[d].cast("long") if d not in slots else F.lit(0), F.lit(0))
        out[f"__k_{i}"], out[f"__s_{i}"] = slots[d] if d in slots else (number, number_slot(number))
    return out


def _order(dimensions: tuple[str, ...]) -> list[Column]:
    """Order along the curve; within a cell by the dimensions, then by checksum, so that equal texts stand side by side."""
    inside = [F.col(f"__k_{i}").asc() for i in range(len(dimensions))]
    return [F.col("__curve").asc(), *inside, F.col("__crc").asc(), F.col("__size").asc(), F.col("__id").asc_nulls_first()]


def shard(docs: DataFrame, shards: int = 16, law: str = "rows", dimensions: tuple[str, ...] = DIMENSIONS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.

    ``law`` "rows" cuts the curve into runs whose counts are at most one apart; "bytes"
    cuts it where the sizes before a row's middle byte pass a share of all bytes.
    ``dimensions`` are columns of ``docs`` (strings, or whole numbers from 0 on) or
    "size", the text's UTF-8 bytes plus 1.

    Null text is empty (size 1); a null dimension has the lowest cell; null ids come
    first among rows of one place, and repeated rows follow one another with a slot
    each.  Very long texts are read whole, only their size and checksum move on.  An
    empty table gives no rows, and columns not named here are ignored, whatever they
    are called.  ``grown_shard`` is null: runs of an order move when a shard is added.
    """
    return _ranked(docs, shards, law, dimensions, id_col, text_col).select(
        F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit(law).alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("__curve").alias("curve"))


def _ranked(docs: DataFrame, shards: int, law: str, dimensions: tuple[str, ...], id_col: str, text_col: str) -> DataFrame:
    """The keys of ``_order``, shard and slot of every row."""
    if law not in ("rows", "bytes"):
        raise ValueError("law is rows or bytes")
    columns = _columns(docs, id_col, text_col, dimensions)
    slots = [c for c in columns if c.startswith("__s_")]
    rows = checkpointed(docs.select(*(c.alias(n) for n, c in columns.items())))
    rows = curve_index(with_cells(rows, slots, cells_of(rows, slots)), [f"{s}_cell" for s in slots], name="__curve")
    order = _order(dimensions)
    laid = rows.drop(*slots, *(f"{s}_cell" for s in slots)).repartitionByRange(*order).sortWithinPartitions(*order)
    laid = checkpointed(laid.withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    # one row a partition: as many as there are shuffle partitions, not more with more documents
    totals = laid.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"), F.sum("__size").alias("__b"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = checkpointed(totals.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"), F.sum("__n").over(whole).alias("__rows"),
        F.coalesce(F.sum("__b").over(before), F.lit(0)).alias("__b0"), F.sum("__b").over(whole).alias("__bytes")))
    ranked = laid.withColumn("__part", part).join(F.broadcast(totals), "__part").withColumn("__rank", F.col("__n0") + place)
    if law == "rows":
        ranked = ranked.withColumn("shard", _div(F.col("__rank") * shards, F.col("__rows")).cast("int"))
        slot = F.col("__rank") - _div(F.col("shard") * F.col("__rows") + (shards - 1), shards)
    else:
        inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        middle = (F.col("__b0") + F.coalesce(F.sum("__size").over(inside), F.lit(0))) * 2 + F.col("__size")
        ranked = ranked.withColumn("shard", _div(middle * shards, F.col("__bytes") * 2).cast("int"))
        firsts = checkpointed(ranked.groupBy("shard").agg(F.min("__rank").alias("__first")))      # a row a shard
        ranked = ranked.join(F.broadcast(firsts), "shard")
        slot = F.col("__rank") - F.col("__first")
    return ranked.withColumn("slot", slot.cast("long"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, dimensions: tuple[str, ...] = DIMENSIONS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Whole rows of ``docs`` as Parquet under ``path``: a folder ``shard=<n>`` each, files cut from runs of the curve.

    The counts are those of the law "rows", but rows that cannot be told apart by place,
    checksum, size and id stay together.  The rows are dealt by their place, so a file
    covers a short run: its statistics of the dimensions let readers skip it.
    """
    keys = ["__curve", *(f"__k_{i}" for i in range(len(dimensions))), "__crc", "__size", "__id"]     # as in _order
    firsts = _ranked(docs, shards, "rows", dimensions, id_col, text_col).where("slot = 0").select("shard", *keys)
    starts = [F.struct(*(F.lit(r[k]).cast(firsts.schema[k].dataType) for k in keys)) for r in firsts.collect()]     # one a shard
    columns = _columns(docs, id_col, text_col, dimensions)
    slots = [c for c in columns if c.startswith("__s_")]
    order = _order(dimensions)
    rows = docs.withColumns(columns)
    rows = curve_index(with_cells(rows, slots, cells_of(rows.select(*slots), slots)), [f"{s}_cell" for s in slots], name="__curve")
    number = F.size(F.filter(F.array(*starts), lambda s: s <= F.struct(*keys))) - 1 if starts else F.lit(0)
    kept = [c for c in docs.columns if c != "shard"]
    (rows.withColumn("shard", number).repartitionByRange(F.col("shard"), *order).sortWithinPartitions(F.col("shard"), *order)
     .select(*kept, "shard").write.partitionBy("shard").parquet(path))
