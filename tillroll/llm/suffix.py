"""Exact removal of repeated 200-byte strings with suffix arrays by linear grouping (operator 5).

Every 200-byte string holds exactly one anchor of its own: the 64-byte piece with the
smallest hash in it, the leftmost of equals.  Equal strings have equal anchors at equal
offsets, so Spark deals the strings out by anchor, and what shares no anchor with
anything else is unique and goes no further.  The context of an anchor, the bytes that
its strings cover, is shipped once for each distinct content; repeated contexts are
wholly repeated text.

Where an anchor has different contexts, its strings are cut into blocks of eight
neighbouring ones.  They share a core of 193 bytes, so a block is the sequence of seven
bytes, the core as one symbol, and seven bytes, and a string of 200 bytes is a run of
eight symbols.  The blocks' suffix array is built by grouping suffixes by their Lyndon
prefix in descending order over previous-smaller pointers, then placing each group's
suffixes in order; suffixes whose first eight symbols agree with a neighbour's in the
array are repeated strings.

An anchor with very many different contexts, such as the edge of a passage that stands
in a third of all documents, is not gathered: its strings are dealt out one by one, by
a 128-bit hash of all their bytes, and compared with their neighbours in sorted order.
Memory is therefore bounded whatever stands around a passage.  Equality of whole
contexts and of those strings is equality of hashes, of 64 bits beside a 64-bit anchor,
and of twice 64.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, sized, slices, text_of

LENGTH = 200                 # bytes of a repeated string
PIECE = 64                   # bytes of an anchor
WIDE = LENGTH - PIECE + 1    # anchor positions in a string
BLOCK = 8                    # neighbouring strings that are looked at together
SEGMENT = 1 << 20            # bytes of a document that are hashed at once
SYMBOLS = 1 << 16            # symbols of one suffix array
HASH = "__text_hash"
CROWD = 4096                 # contexts of an anchor beyond which its strings are dealt out one by one
TOGETHER = 500_000           # anchors whose contexts meet inside a task
ANCHOR_COLUMNS = ["anchor", "context", "doc_id", "text_hash", "lo", "left", "span"]


# ------------------------------------------------------------------ suffix array


def suffix_array(t: list[int]) -> list[int]:
    """Starts of the suffixes of ``t`` in ascending order; a shorter suffix comes before its extensions.

    Phase 1: suffixes are grouped by first symbol.  Groups are taken in descending
    order.  Each member's previous-smaller pointer is the nearest position on its left
    that has not been taken yet; that position's prefix is followed by the group's, so
    it moves to a new group right above its own, by how many members point at it.
    Phase 2: the suffix placed last and the chain of previous-smaller pointers before
    it give the next suffixes of their groups.
    """
    n = len(t)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(t):
        by_symbol.setdefault(c, []).append(i)
    members: list[list[int]] = []
    group = [0] * n
    for g, c in enumerate(sorted(by_symbol)):
        members.append(by_symbol[c])
        for i in by_symbol[c]:
            group[i] = g
    lower = list(range(-1, len(members) - 1))
    upper = [*range(1, len(members)), -1]
    smaller = [-1] * n
    left = list(range(n + 1))            # left[i + 1]: itself if i is open, else a step to the left; 0 is none
    taken: list[list[int]] = []
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        taken.append(own)
        for i in own:
            left[i + 1] = i
        hits: dict[int, int] = {}
        for i in own:
            j = i
            while left[j] != j:
                left[j] = left[left[j]]
                j = left[j]
            if j:
                smaller[i] = j - 1
                hits[j - 1] = hits.get(j - 1, 0) + 1
        if hits:
            split: dict[tuple[int, int], list[int]] = {}
            for j, k in hits.items():
                split.setdefault((k, group[j]), []).append(j)
            for k, h in sorted(split, reverse=True):         # more repeats stand higher
                new = len(members)
                up = upper[h]
                members.append(split[k, h])
                lower.append(h)
                upper.append(up)
                upper[h] = new
                if up >= 0:
                    lower[up] = new
                for j in split[k, h]:
                    group[j] = new
        g = lower[g]
    place = [0] * len(members)
    at = 0
    for own in reversed(taken):
        if own:
            place[group[own[0]]] = at
            at += len(own)
    order = [-1] * n
    open_ = [True] * n
    s, i = n, 0
    while True:
        j = s - 1
        while j >= 0 and open_[j]:
            g = group[j]
            order[place[g]] = j
            place[g] += 1
            open_[j] = False
            j = smaller[j]
        if i == n:
            return order
        s = order[i]
        i += 1


def repeated_runs(strings: list[tuple[bytes, int, bytes]], length: int = BLOCK) -> list[set[int]]:
    """For (left, core, right): by how many left bytes a run of ``length`` symbols over the core starts before it,
    for the runs that another string also has.  Runs lie within a string and hold its core."""
    out: list[set[int]] = [set() for _ in strings]
    t: list[int] = []
    wanted: dict[int, tuple[int, int]] = {}
    for k, (a, core, b) in enumerate(strings):
        base = len(t)
        t += a
        t.append(256 + core)
        t += b
        t.append(-1)
        for used in range(max(0, length - 1 - len(b)), min(len(a), length - 1) + 1):
            wanted[base + len(a) - used] = (k, used)
    before = None
    for i in suffix_array(t):
        if i in wanted:
            if before is not None and t[before:before + length] == t[i:i + length]:
                for j in (before, i):
                    k, used = wanted[j]
                    out[k].add(used)
            before = i
    return out


# ------------------------------------------------------------------ anchors


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20_240).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _piece_hashes(b: np.ndarray) -> np.ndarray:
    """Mixed polynomial hash of the PIECE bytes from each position on, by doubling the width."""
    h = _byte_values()[b]
    width, factor = 1, 0x9E3779B97F4A7C15
    while width < PIECE:
        h = h[:-width] * np.uint64(pow(factor, width, 1 << 64)) + h[width:]
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[:len(x) - (width - n)], x[width - n:]) if n < width else x


def anchors(raw: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each segment of a document: anchor hashes, their positions, and the first and last string that each is the anchor of."""
    out = []
    low = np.uint64(SEGMENT - 1)
    for at in range(0, max(0, len(raw) - LENGTH + 1), SEGMENT - LENGTH + 1):
        h = _piece_hashes(np.frombuffer(raw, np.uint8)[at:at + SEGMENT])
        of = (_lowest((h & ~low) | np.arange(len(h), dtype=np.uint64), WIDE) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        last = np.concatenate([first[1:], [len(of)]]) - 1
        p = of[first]
        out.append((h[p], p + at, first + at, last + at))
    return out


def anchor_rows(rows: DataFrame) -> DataFrame:
    """Every anchor of every whole text: (sure, many, deal, anchor, context, doc_id, text_hash, lo, left, span).

    The anchor's strings start at lo .. lo + span; the anchor itself ``left`` bytes
    after lo.  ``context`` is a hash of the bytes that the strings cover.  Equal
    contexts within a task meet before the shuffle: one row stands for them (``many``),
    and each is also a ``sure`` row, known to be repeated.  Rows that stand for a
    context are dealt by anchor, sure ones evenly, so however many copies a passage
    has, its anchor gets a row or two from each task.
    """
    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                found = []
                for row, raw in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    if raw is None or len(raw) < LENGTH:
                        continue
                    for h, p, lo, hi in anchors(raw):
                        context = [digest(raw[a:b], c) for a, b, c in zip(lo.tolist(), (hi + LENGTH).tolist(), (p - lo).tolist())]
                        found.append((h.view(np.int64), np.array(context, np.uint64).view(np.int64), np.full(len(h), row), lo, p - lo, hi - lo))
                if found:
                    h, context, row, lo, left, span = (np.concatenate(c) for c in zip(*found))
                    held.append(pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(context), part.column("doc_id").take(pa.array(row)), part.column("text_hash").take(pa.array(row)),
                         pa.array(lo), pa.array(left.astype(np.int16)), pa.array(span.astype(np.int16))], names=ANCHOR_COLUMNS))
                if sum(b.num_rows for b in held) >= TOGETHER:
                    yield from _met(held)
                    held = []
        if held:
            yield from _met(held)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", F.col(HASH).alias("text_hash"), "text").mapInArrow(
        run, DEALT.format(kind))


def _met(held: list[pa.RecordBatch]):
    """One row for each distinct context, and a sure row for each member of a repeated one."""
    table = pa.Table.from_batches(held).combine_chunks()
    anchor, context = table.column("anchor").to_numpy(), table.column("context").to_numpy()
    order = np.lexsort((context, anchor))
    anchor, context = anchor[order], context[order]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])]))
    size = np.diff(np.concatenate([first, [len(order)]]))
    for sure, at, many in ((False, order[first], size > 1), (True, order[np.repeat(size > 1, size)], None)):
        rows = table.take(pa.array(at))
        many = np.ones(len(at), bool) if many is None else many
        columns, deal = list(rows.columns), rows.column("anchor")
        if sure:                                             # neither anchor nor context is asked for any more
            columns[:2] = [pa.array(np.zeros(len(at), np.int64))] * 2
            deal = pa.array((np.arange(len(at), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
        out = pa.Table.from_arrays([pa.array(np.full(len(at), sure)), pa.array(many), deal, *columns],
                                   names=["sure", "many", "deal", *ANCHOR_COLUMNS])
        yield from out.combine_chunks().to_batches(max_chunksize=100_000)


def _compare(batches):
    """Over rows sorted by anchor and context: rows of repeated contexts (ask false), and one row for each distinct
    context of an anchor that has several (ask true; ``many`` if it is repeated).  Sure rows pass.  Holds a batch and a row."""
    names = ["ask", "many", "anchor", "doc_id", "text_hash", "lo", "left", "span"]
    carry, before, first = None, None, None      # the last row, the key before it, an anchor's first distinct context

    def give(rows, ask, many):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(rows.num_rows, ask)), pa.array(many), *(rows.column(c) for c in names[2:])], names=names)

    for batch in chain(batches, [None]):
        if batch is None:
            if carry is None:
                break
            rows, n = carry, 1
        else:
            sure = batch.filter(batch.column("sure"))
            if sure.num_rows:
                yield give(sure, False, np.ones(sure.num_rows, bool))
                batch = batch.filter(pc.invert(batch.column("sure")))
            if not batch.num_rows:
                continue
            rows = batch if carry is None else pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
            n = rows.num_rows - 1
        anchor, context = rows.column("anchor").to_numpy(), rows.column("context").to_numpy()
        same = (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])
        as_next = np.concatenate([same, [False]])[:n]
        as_prev = np.concatenate([[before is not None and before == (anchor[0], context[0])], same])[:n]
        if n:
            cover = np.flatnonzero(as_next | as_prev)
            if len(cover):
                yield give(rows.take(pa.array(cover)), False, np.ones(len(cover), bool))
            fresh = np.flatnonzero(~as_prev)
            if len(fresh):
                many = (as_next | rows.column("many").to_numpy(zero_copy_only=False)[:n])[fresh]
                opens = np.concatenate([[before is None or before[0] != anchor[0]], anchor[1:] != anchor[:-1]])[fresh]
                if first is not None and not opens[0]:
                    yield give(first[0], True, np.array([first[1]]))
                    first = None
                joined = np.concatenate([~opens[1:], [False]])
                ask = ~opens | joined
                if ask.any():
                    yield give(rows.take(pa.array(fresh[ask])), True, many[ask])
                first = (rows.slice(int(fresh[-1]), 1), bool(many[-1])) if opens[-1] else None
            before = (anchor[n - 1], context[n - 1])
        carry = rows.slice(n, 1) if n < rows.num_rows else None


def _contexts(batches):
    """The bytes of each asked-for context, from the texts and the rows asked for."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            cols = {c: [] for c in ("anchor", "many", "lo", "left", "span", "bytes")}
            source = []
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for i, (raw, asks) in enumerate(zip(texts, part.column("__asks").to_pylist())):
                for a in asks:
                    source.append(i)
                    for c in ("anchor", "many", "lo", "left", "span"):
                        cols[c].append(a[c])
                    cols["bytes"].append(raw[a["lo"]:a["lo"] + a["span"] + LENGTH])
            if source:
                at = pa.array(source)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols["anchor"], pa.int64()), part.column("doc_id").take(at), part.column(HASH).take(at),
                     pa.array(cols["many"], pa.bool_()), pa.array(cols["lo"], pa.int64()), pa.array(cols["left"], pa.int16()),
                     pa.array(cols["span"], pa.int16()), pa.array(cols["bytes"], pa.binary())],
                    names=["anchor", "doc_id", "text_hash", "many", "lo", "left", "span", "bytes"])


def _strings(batches):
    """Every string of the crowded contexts as an anchor of its own, hashed twice over all its bytes; equal ones meet in
    the task as contexts do."""
    one, other = xxhash.xxh3_64_intdigest, xxhash.xxh64_intdigest
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            source, at, h, g = [], [], [], []
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for i, (raw, asks) in enumerate(zip(texts, part.column("__asks").to_pylist())):
                for a in asks:
                    for lo in range(a["lo"], a["lo"] + a["span"] + 1):
                        string = raw[lo:lo + LENGTH]
                        source.append(i)
                        at.append(lo)
                        h.append(one(string))
                        g.append(other(string))
            if source:
                rows = pa.array(source)
                zero = pa.array(np.zeros(len(source), np.int16))
                held.append(pa.RecordBatch.from_arrays(
                    [pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(np.array(g, np.uint64).view(np.int64)), part.column("doc_id").take(rows),
                     part.column(HASH).take(rows), pa.array(at, pa.int64()), zero, zero], names=ANCHOR_COLUMNS))
                if sum(b.num_rows for b in held) >= TOGETHER:
                    yield from _met(held)
                    held = []
    if held:
        yield from _met(held)


def _judge(batches):
    """Repeated strings among the different contexts of each anchor, as covered ranges of bytes.

    Rows come sorted by anchor; blocks gather until a suffix array is full, so memory
    is bounded by SYMBOLS and CROWD contexts of one anchor.
    """
    group: list[dict] = []
    strings: list[tuple[bytes, int, bytes]] = []
    owners: list[tuple[list[dict], int]] = []        # contexts with the string, the block's first distance
    found: dict[int, tuple[dict, set[int]]] = {}

    def add(c, starts):
        found.setdefault(id(c), (c, set()))[1].update(starts)

    def close_group():
        if len(group) < 2:
            return
        cores: dict[tuple[int, bytes], dict[tuple[bytes, bytes], list[dict]]] = {}
        for c in group:
            raw, left, span = c["bytes"], c["left"], c["span"]
            for b in range((left - span) // BLOCK, left // BLOCK + 1):
                near = b * BLOCK
                core = left - near
                end = core + LENGTH - BLOCK + 1
                cores.setdefault((b, raw[core:end]), {}).setdefault(
                    (raw[max(0, core - BLOCK + 1):core], raw[end:end + BLOCK - 1]), []).append(c)
        for (b, _), alike in cores.items():
            several = len(alike) > 1
            number = len(strings)
            for (before, after), cs in alike.items():
                need = [c for c in cs if not c["many"]]
                if need and (len(cs) > 1 or len(need) < len(cs)):
                    for c in need:                    # the same bytes around the same core: all its strings are repeated
                        add(c, range(max(b * BLOCK, c["left"] - c["span"]), min(b * BLOCK + BLOCK - 1, c["left"]) + 1))
                    need = []
                if several:
                    strings.append((before, number, after))
                    owners.append((need, b * BLOCK))
            if several and not any(need for need, _ in owners[number:]):
                del strings[number:], owners[number:]
    size = 0

    def close_array():
        for (need, near), used in zip(owners, repeated_runs(strings)):
            for c in need:
                add(c, (near + u for u in used if c["left"] - c["span"] <= near + u <= c["left"]))
        strings.clear()
        owners.clear()
        rows = []
        for c, far in found.values():
            starts = sorted(c["lo"] + c["left"] - f for f in far)
            lo = None
            for s in starts:
                if lo is None or s > hi:
                    if lo is not None:
                        rows.append((c["doc_id"], c["text_hash"], lo, hi))
                    lo = s
                hi = s + LENGTH
            if lo is not None:
                rows.append((c["doc_id"], c["text_hash"], lo, hi))
        found.clear()
        if rows:
            d, h, lo, hi = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(d, kind), pa.array(h, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                                              names=["doc_id", "text_hash", "lo", "hi"])
        return None

    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for c in batch.to_pylist():
            if group and group[-1]["anchor"] != c["anchor"]:
                close_group()
                size += len(group)
                group = []
                if len(strings) * 2 * BLOCK >= SYMBOLS or size > 50_000:
                    size = 0
                    got = close_array()
                    if got is not None:
                        yield got
            group.append(c)
    close_group()
    got = close_array()
    if got is not None:
        yield got


# ------------------------------------------------------------------ operator


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the hash of the text (null as empty), which tells equal ids apart."""
    return docs.withColumn(HASH, F.xxhash64(text_of(F.col("text"))))


DEALT = "sure boolean, many boolean, deal long, anchor long, context long, doc_id {0}, text_hash long, lo long, left short, span short"


def _meeting(dealt: DataFrame, kind: str) -> DataFrame:
    """``_compare`` over rows dealt by anchor."""
    return dealt.repartition("deal").sortWithinPartitions("sure", "anchor", "context").mapInArrow(
        _compare, f"ask boolean, many boolean, anchor long, doc_id {kind}, text_hash long, lo long, left short, span short")


def compared(rows: DataFrame) -> DataFrame:
    """By document: the strings that surely repeat (sure), and the contexts to be looked at byte by byte (asks)."""
    judged = _meeting(anchor_rows(rows), rows.schema["doc_id"].dataType.simpleString())
    by_doc = judged.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.when(~F.col("ask"), F.struct("lo", (F.col("lo") + F.col("span") + LENGTH).alias("hi")))).alias("sure"),
        F.collect_list(F.when(F.col("ask"), F.struct("anchor", "many", "lo", "left", "span"))).alias("asks"))
    return checkpointed(by_doc)


def crowded(by_doc: DataFrame) -> DataFrame:
    """Anchors with more than ``CROWD`` contexts to be looked at."""
    asks = by_doc.select(F.explode("asks").alias("a")).select("a.anchor")
    many = asks.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("anchor")
    return checkpointed(sized(many, by_doc.count()))


def _same(rows: DataFrame, other: DataFrame):
    return rows["doc_id"].eqNullSafe(other["doc_id"]) & (rows[HASH] == other["text_hash"])


def repeats(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans): ranges (lo, hi) of bytes covered by repeated strings; only rows that have any.

    The texts are fetched with all columns of ``rows``, so that the caller's join of
    the same rows with the result reads the same shuffle.
    """
    by_doc = compared(rows)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def with_asks(asked: DataFrame) -> DataFrame:
        return rows.join(asked, _same(rows, asked)).select(*(rows[c] for c in rows.columns), asked["__asks"])

    asked = by_doc.where("size(asks) > 0").select("doc_id", "text_hash", F.col("asks").alias("__asks"))
    crowd, more = crowded(by_doc), []
    if not crowd.isEmpty():
        one = asked.select("doc_id", "text_hash", F.explode("__asks").alias("a"))
        one = one.join(crowd.withColumnRenamed("anchor", "__crowd"), F.col("a.anchor") == F.col("__crowd"), "left")
        split = checkpointed(one.groupBy("doc_id", "text_hash").agg(
            *(F.collect_list(F.when(c, F.col("a"))).alias(n) for n, c in (("few", F.col("__crowd").isNull()), ("many", F.col("__crowd").isNotNull())))))
        asked = split.where("size(few) > 0").select("doc_id", "text_hash", F.col("few").alias("__asks"))
        strings = with_asks(split.where("size(many) > 0").select("doc_id", "text_hash", F.col("many").alias("__asks"))).mapInArrow(_strings, DEALT.format(kind))
        more.append(_meeting(strings, kind).where("NOT ask").select("doc_id", "text_hash", "lo", (F.col("lo") + LENGTH).alias("hi")))
    contexts = with_asks(asked).mapInArrow(
        _contexts, f"anchor long, doc_id {kind}, text_hash long, many boolean, lo long, left short, span short, bytes binary")
    more.append(contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _judge, f"doc_id {kind}, text_hash long, lo long, hi long"))
    sure = by_doc.where("size(sure) > 0").select("doc_id", "text_hash", F.col("sure").alias("spans"))
    found = reduce(DataFrame.unionByName, more).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return sure.unionByName(found).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _with_spans(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__spans``, null where nothing repeats."""
    spans = repeats(rows).withColumnRenamed("spans", "__spans")
    return rows.join(spans, _same(rows, spans), "left").select(*(rows[c] for c in rows.columns), spans["__spans"])


def merged(spans, n: int) -> list[tuple[int, int]]:
    """Ranges joined where they overlap or touch, in order."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], min(s["hi"], n)) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def cut(raw: bytes, gone: list[tuple[int, int]]) -> bytes:
    """``raw`` without the ranges."""
    at, kept = 0, []
    for lo, hi in gone:
        kept.append(raw[at:lo])
        at = hi
    return b"".join([*kept, raw[at:]])


def dedup_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte that a repeated 200-byte string covers; one row per input row.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and
    kept_sha256 (of the bytes left, joined).  Texts are UTF-8 bytes, null as empty;
    strings never cross documents; a text of fewer than 200 bytes keeps all.  Fully
    repeated rows repeat each other; null and equal ids give a row each; an empty
    table gives none; other columns are ignored.
    """
    rows = keyed(docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                got = []
                for raw, s in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("__spans").to_pylist()):
                    raw = raw or b""
                    gone = merged(s, len(raw))
                    kept = cut(raw, gone)
                    got.append((len(raw), len(raw) - len(kept), len(gone), sha256(kept).hexdigest()))
                n, removed, runs, digest = zip(*got)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                     pa.array(digest, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(rows).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; a character that is cut through goes whole.

    Null texts, the rows themselves and all other columns stay as they are.
    """
    names = docs.columns
    both = _with_spans(keyed(docs))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = []
                for raw, s in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("__spans").to_pylist()):
                    texts.append(raw if not s else cut(raw, merged(s, len(raw))))
                text = pa.array([t if t is None else t.decode("utf-8", "ignore") for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([text if c == "text" else part.column(c) for c in names], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return both.mapInArrow(run, kinds)
