"""Chat formatting with typed content parts (operator 4), in DataFrame functions only.

A turn holds parts of the types text, image, audio and document.  A visitor turns
the parts, in order, into text: texts are escaped, attachments become placeholders,
and each attachment's reference and expanded token count is recorded.  A
conversation is its turns in order, each marked by control strings; the spans under
the loss mask are the text parts of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: What one expanded token stands for, by attachment type: pixels, milliseconds, characters.
UNITS_PER_TOKEN = {"image": 784, "audio": 40, "document": 4}
PARTS = "array<struct<type:string,text:string,ref:string,size:bigint>>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """No control string of this or a bracket template can stand in an escaped text; ``unescape`` undoes it.

    The backslash, < and [ become a backslash and a letter, so every backslash
    starts a pair and the pairs are undone independently, the backslash's own last.
    """
    for raw, to in (("\\", "\\e"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(raw), F.lit(to))
    return text


def unescape(text: Column) -> Column:
    for raw, to in (("<", "\\l"), ("[", "\\b"), ("\\", "\\e")):
        text = F.replace(text, F.lit(to), F.lit(raw))
    return text


def _visit(part: Column) -> Column:
    """A part as (its string in the formatted text, is it text, its attachment record)."""
    kinds = list(UNITS_PER_TOKEN)
    attached = part["type"].isin(kinds)
    tokens = F.lit(0).cast("long")
    for kind, per in UNITS_PER_TOKEN.items():
        tokens = F.when(part["type"] == kind, F.ceil(F.coalesce(part["size"], F.lit(0)) / per)).otherwise(tokens)
    record = F.struct(part["type"].alias("type"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"))
    return F.struct(
        F.when(attached, F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(escape(text_of(part["text"]))).alias("s"),
        F.coalesce(~attached, F.lit(True)).alias("is_text"),
        F.when(attached, record).alias("attachment"))


def text_parts(text: Column) -> Column:
    """A plain text as the only part of its turn."""
    return F.array(F.struct(F.lit("text").alias("type"), text_of(text).alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("long").alias("size"))).cast(PARTS)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens, n_turns.

    ``loss_spans`` are (start, end) in code points of ``formatted``, end exclusive;
    ``attachments`` (type, ref, tokens) come in the order of their placeholders.
    Turns go by number, nulls first, then role and parts; repeated rows are turns of
    their own.  A null role is empty, null parts are none, a part of null or unknown
    type is text, null text is empty; rows with a null conversation id form one
    conversation.  An empty table gives no rows; other columns are ignored.
    """
    df = turns.select(turns[conv].alias("conv_id"), turns[turn].alias("turn"), text_of(turns[role].cast("string")).alias("role"),
                      F.coalesce(turns[parts].cast(PARTS), F.array().cast(PARTS)).alias("parts"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "parts")
    df = df.withColumn("pieces", F.transform("parts", _visit))
    df = df.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)))
    df = df.withColumn("lengths", F.transform("pieces", lambda p: F.length(p["s"])))
    df = df.withColumn("body", F.array_join(F.transform("pieces", lambda p: p["s"]), ""))
    df = df.withColumn("n", F.length("head") + F.length("body") + F.lit(len(END)))
    df = df.withColumn("number", F.row_number().over(order)).withColumn(
        "begin", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    start = F.col("begin") + F.length("head")
    spans = F.transform(F.sequence(F.lit(1), F.size("pieces")), lambda i: F.struct(
        (start + _total(F.slice("lengths", F.lit(1), i - 1))).alias("start"),
        (start + _total(F.slice("lengths", F.lit(1), i))).alias("end"),
        F.element_at(F.col("pieces"), i)["is_text"].alias("is_text")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,is_text:boolean>>")
    spans = F.when((F.col("role") == ASSISTANT) & (F.size("pieces") > 0), F.filter(spans, lambda s: s["is_text"])).otherwise(none)
    df = df.select("conv_id", F.struct(
        "number", F.concat("head", "body", F.lit(END)).alias("s"), spans.alias("spans"),
        F.transform(F.filter("pieces", lambda p: p["attachment"].isNotNull()), lambda p: p["attachment"]).alias("attachments")).alias("t"))
    df = df.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    attachments = F.flatten(F.transform("ts", lambda t: t["attachments"]))
    return df.select("conv_id", F.array_join(F.transform("ts", lambda t: t["s"]), "").alias("formatted"),
                     F.transform(F.flatten(F.transform("ts", lambda t: t["spans"])),
                                 lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"),
                     attachments.alias("attachments"),
                     F.aggregate(attachments, F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]).alias("expanded_tokens"),
                     F.size("ts").cast("long").alias("n_turns"))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda acc, x: acc + x)


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, (role, text) each, attachments left out."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda p: F.length(p) > 0)
    places = "<\\|(" + "|".join(UNITS_PER_TOKEN) + ")\\|>"
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, SAYS, 1), len(TURN) + 1, 1 << 30)).alias("role"),
        unescape(F.regexp_replace(F.substring_index(p, SAYS, -1), places, "")).alias("text")))


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them."""
    df = chats.withColumn("turns", read_back(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    df = df.withColumn("said", said).withColumn("loss", loss)
    return df.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
                     F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                     F.length("formatted").cast("long").alias("formatted_chars"))
