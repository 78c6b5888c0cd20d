"""Ranked lexical search by range maxima (operator 12).

The index is a table of blocks of documents: each block has its documents in order of
id and a posting list per term, kept as two compressed binary values that only Python
opens.  To search, a task turns the lists that the items ask for into impacts (the whole numbers that a term adds to a score) and lays a sparse
table of range maxima over every list.  An interval of documents is bounded by the sum
of its lists' maxima.  Best first, the interval with the highest bound is split at the
document of its strongest maximum: that document is scored, the two intervals beside
it get their own bounds, and what cannot beat the last kept document is let go.  A task
carries the kept documents on from block to block, so later blocks are mostly let go
whole; Spark merges the tasks' lists by rank.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, slices, stored

BLOCK_DOCS = 4096            # documents of a block, at most
BLOCK_BYTES = 8 << 20        # a block is closed once its texts pass this; a longer text is a block of its own
BATCH_BYTES = 4 << 20        # item texts of one pass over the index: what every task is sent
SPLITS = 64                  # intervals split in one step of an item's search
GROUP_ROWS = 4               # blocks that the JVM writes and reads in one go
WORDS, POSTINGS = ("terms", "dfs"), ("sizes", "docs", "tfs")

#: ASCII letters in lower case and digits stay, other ASCII becomes a blank, other bytes stay.
_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """The text's terms in UTF-8, repeats included: runs of ASCII letters, digits and all non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def _block(ids: list, texts: list[str | None], kind: pa.DataType) -> pa.RecordBatch:
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    vocabulary: dict[bytes, int] = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    sizes, terms, tfs, held = [], [], [], []
    for i in order:
        words = terms_of(texts[i])
        counts = Counter(words)
        sizes.append(len(words))
        held.append(len(counts))
        terms.extend(map(vocabulary.__getitem__, counts))
        tfs.extend(counts.values())
    names = sorted(vocabulary)
    rank = np.empty(len(names), np.int64)
    rank[[vocabulary[t] for t in names]] = np.arange(len(names))
    place = rank[np.array(terms, np.int64)] if terms else np.zeros(0, np.int64)
    by_term = np.argsort(place, kind="stable")
    docs = np.repeat(np.arange(len(order), dtype=np.int32), held)[by_term]
    dfs = np.bincount(place, minlength=len(names)).astype(np.int32)
    columns = {"ids": pa.array([[ids[i] for i in order]], pa.list_(kind)), "sizes": pa.array([sizes], pa.list_(pa.int32())),
               "terms": pa.array([[t.decode("utf-8", "replace") for t in names]], pa.list_(pa.string())),
               "dfs": pa.array([dfs], pa.list_(pa.int32())), "docs": pa.array([docs], pa.list_(pa.int32())),
               "tfs": pa.array([np.array(tfs, np.int32)[by_term]], pa.list_(pa.int32())),
               "n_docs": pa.array([sum(n > 0 for n in sizes)], pa.int64()), "n_terms": pa.array([sum(sizes)], pa.int64())}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _packed(block: pa.RecordBatch) -> pa.RecordBatch:
    """A block as it is stored: arrays of a million numbers cost the JVM some times their size, a compressed value once."""
    def blob(names: tuple[str, ...]) -> pa.Array:
        part, sink = block.select(list(names)), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(part)
        return pa.array([sink.getvalue().to_pybytes()], pa.binary())

    return pa.RecordBatch.from_arrays([block.column("ids"), blob(WORDS), blob(POSTINGS), block.column("n_docs"), block.column("n_terms")],
                                      names=["ids", "words", "postings", "n_docs", "n_terms"])


def _unpacked(value: pa.BinaryScalar) -> dict[str, pa.Array]:
    part = pa.ipc.open_stream(value.as_buffer()).read_next_batch()
    return {c: part.column(c)[0].values for c in part.schema.names}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The stored index of every whole text, one row a block: ids, words, postings, n_docs, n_terms.

    ``words`` holds the terms and the lengths of their posting lists (dfs), ``postings``
    the documents' sizes and the lists one after the other (docs, tfs); a posting's
    document is its place in ``ids``, which is in order (nulls last).  Documents stay in their task, so nothing is shuffled.  A null text has no
    term and is kept with size 0; repeated rows are documents of their own; an empty
    table has no block; columns not named are ignored.
    """
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, kind = [], [], 0, pa.null()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in slices(batch, "text"):
                for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if len(ids) >= block_docs or held >= BLOCK_BYTES:
                        yield _packed(_block(ids, texts, kind))
                        ids, texts, held = [], [], 0
                    ids.append(i)
                    texts.append(t)
                    held += len(t or "")
        if ids:
            yield _packed(_block(ids, texts, kind))

    kind = src.schema["doc_id"].dataType.simpleString()
    return stored(src.mapInArrow(run, f"ids array<{kind}>, words binary, postings binary, n_docs long, n_terms long"), "search-index",
                  {"parquet.block.row.count.limit": GROUP_ROWS})


class _Lists:
    """Impacts of a block's posting lists with their range maxima, for the terms that items ask for."""

    def __init__(self, row: dict, weights: dict[str, int], n: int, total: int):
        sizes = np.asarray(row["sizes"], np.int64)
        ends = np.cumsum(np.asarray(row["dfs"], np.int64))
        asked = [(i, t) for i, t in enumerate(row["terms"]) if t in weights]
        self.width = len(sizes) + 1
        self.slot = {t: s for s, (_, t) in enumerate(asked)}
        at = [i for i, _ in asked]
        length = np.asarray(row["dfs"], np.int64)[at]
        first = ends[at] - length
        take = np.arange(length.sum()) + np.repeat(first - (np.cumsum(length) - length), length)
        doc = np.asarray(row["docs"], np.int64)[take]
        tf = np.asarray(row["tfs"], np.int64)[take]
        m = 75 + 25 * sizes[doc] * n // max(total, 1)
        w = np.repeat(np.array([weights[t] for _, t in asked], np.int64), length)
        slot = np.repeat(np.arange(len(asked), dtype=np.int64), length)
        self.doc = np.append(doc, 0)
        self.impact = np.append(w * (1_000_000_000 * tf // (1000 * tf + 12 * m)), 0)
        self.key = np.append(slot * self.width + doc, np.iinfo(np.int64).max)
        size = len(doc)
        longest = int(length.max(initial=1))
        self.best = np.empty((longest.bit_length(), size + 1), np.int32)      # place of the maximum of 2^k postings
        self.best[0] = np.arange(size + 1)
        for k in range(1, len(self.best)):
            half = 1 << (k - 1)
            a, b = self.best[k - 1], np.append(self.best[k - 1][half:], np.full(min(half, size + 1), size, np.int32))[:size + 1]
            self.best[k] = np.where(self.impact[b] > self.impact[a], b, a)
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, len(self.best)):
            self.log[1 << k:] = k

    def maxima(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the first greatest impact of each range of postings; the last place, of impact 0, for an empty range."""
        n = end - start
        k = self.log[n]
        a, b = self.best[k, start], self.best[k, end - (1 << k)]
        return np.where(n > 0, np.where(self.impact[b] > self.impact[a], b, a), len(self.doc) - 1)


class _Kept:
    """The best documents of an item so far, best first: (-score, id is null, id)."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def floor(self, ids: list, known: int) -> tuple[int, int]:
        """Score to beat, and how many of a block's first documents win a tie against the last kept one."""
        if len(self.rows) < self.k:
            return 0, 0
        score, null, last = self.rows[-1]
        return -score, known if null else bisect_left(ids, last, 0, known)

    def add(self, score: int, i) -> None:
        insort(self.rows, (-score, i is None, i if i is not None else 0))
        del self.rows[self.k:]


def best_first(lists: _Lists, slots: np.ndarray, times: np.ndarray, ids: list, known: int, kept: _Kept) -> int:
    """Search one block for one item; returns the number of documents scored."""
    base = slots * lists.width
    scored = 0

    def bounded(lo, hi, start, end):
        top = lists.maxima(start, end)
        each = times * lists.impact[top]
        strongest = each.argmax(axis=1)
        bound = each.sum(axis=1)
        live = bound > 0
        return bound[live], lo[live], hi[live], lists.doc[top[np.arange(len(lo)), strongest]][live]

    n = lists.width - 1
    start, end = np.searchsorted(lists.key, base)[None, :], np.searchsorted(lists.key, base + n)[None, :]
    queue = bounded(np.zeros(1, np.int64), np.full(1, n, np.int64), start, end)
    while len(queue[0]):
        least, ties = kept.floor(ids, known)
        bound, lo, hi, split = queue
        live = (bound > least) | ((bound == least) & (lo < ties))
        if not live.all():
            bound, lo, hi, split = (x[live] for x in queue)
            if not len(bound):
                break
        if len(bound) > SPLITS:
            order = np.argpartition(-bound, SPLITS)
            now, later = order[:SPLITS], order[SPLITS:]
        else:
            now, later = slice(None), slice(0, 0)
        rest = (bound[later], lo[later], hi[later], split[later])
        lo, hi, split = lo[now], hi[now], split[now]
        key = base + split[:, None]
        at = np.searchsorted(lists.key, key)
        hit = lists.key[at] == key
        score = (times * lists.impact[at] * hit).sum(axis=1)
        scored += len(split)
        good = (score > least) | ((score == least) & (split < ties))
        for s, d in sorted(zip((-score[good]).tolist(), split[good].tolist())):
            kept.add(-s, ids[d])
        left = bounded(lo, split, np.searchsorted(lists.key, base + lo[:, None]), at)
        right = bounded(split + 1, hi, at + hit, np.searchsorted(lists.key, base + hi[:, None]))
        queue = tuple(np.concatenate(x) for x in zip(rest, left, right))
    return scored


def _pass(index: DataFrame, items: list[dict[str, int]], weights: dict[str, int], n: int, total: int, k: int) -> DataFrame:
    """(number, doc_id, score): for each of the numbered ``items`` the ``k`` best documents of every task."""
    asked = [(number, known) for number, counts in enumerate(items)
             if (known := [(t, c) for t, c in counts.items() if weights.get(t, 0) > 0])]
    weights = {t: w for t, w in weights.items() if w > 0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {number: _Kept(k) for number, _ in asked}
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for b in range(batch.num_rows):
                row = _unpacked(batch.column("words")[b]) | _unpacked(batch.column("postings")[b])
                row = {c: x.to_pylist() if c == "terms" else x.to_numpy(zero_copy_only=False) for c, x in row.items()}
                ids = batch.column("ids")[b].as_py()
                lists = _Lists(row, weights, n, total)
                known = len(ids) - ids.count(None)
                for number, counts in asked:
                    here = [(lists.slot[t], c) for t, c in counts if t in lists.slot]
                    if here:
                        slots, times = np.array(here, np.int64).T
                        best_first(lists, slots, times, ids, known, kept[number])
        rows = [(number, None if null else i, -s) for number, _ in asked for s, null, i in kept[number].rows]
        if rows:
            numbers, docs, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(docs, kind), pa.array(scores, pa.int64())],
                                             names=["number", "doc_id", "score"])

    return index.select("ids", "words", "postings").mapInArrow(run, f"number int, doc_id {index.schema['ids'].dataType.elementType.simpleString()}, score long")


def frequencies(index: DataFrame, terms: list[str]) -> DataFrame:
    """(term, df): the number of documents that hold each of ``terms``; no row for a term in none."""
    asked = pa.array(terms, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("words"):
                held = _unpacked(value)
                known = pc.is_in(held["terms"], value_set=asked)
                yield pa.RecordBatch.from_arrays([held["terms"].filter(known), held["dfs"].filter(known)], names=["term", "df"])

    return index.select("words").mapInArrow(run, "term string, df int").groupBy("term").agg(F.sum("df").alias("df"))


def _batches(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """Rows of (item, text) in batches of at most ``limit`` bytes of text; a longer text is a batch of its own."""
    held, size = [], 0
    for r in items.toLocalIterator():
        own = len((r["text"] or "").encode("utf-8", "surrogatepass"))
        if held and size + own > limit:
            yield held
            held, size = [], 0
        held.append((r["item"], r["text"]))
        size += own
    if held:
        yield held


def search(index: DataFrame, items: DataFrame, k: int = 20, item_col: str = "item_id", text_col: str = "text",
           batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The ``k`` documents of ``index`` with the highest scores above 0 for each row of ``items``: item_id, rank, doc_id, score.

    Equal scores go by ascending doc_id, nulls last.  An item without terms, or whose
    terms no document holds, gives no row; each of repeated item rows is answered; null
    ids stay null.  Items are taken in batches of bounded size, one pass over the index
    each, whose result is stored; what the driver and the tasks hold is one batch and
    the document frequencies of its terms.
    """
    spark = index.sparkSession
    head = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    n, total = head["n"] or 0, head["total"] or 0
    source = items.select(items[item_col].alias("item"), items[text_col].cast("string").alias("text"))
    kind = source.schema["item"].dataType.simpleString()
    doc_kind = index.schema["ids"].dataType.elementType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {doc_kind}, score long")
    for batch in _batches(source, batch_bytes) if n else ():
        counts = [dict(Counter(t.decode("utf-8", "replace") for t in terms_of(text))) for _, text in batch]
        dfs = frequencies(index, sorted(set().union(*counts))).collect()     # terms of one batch
        weights = {r["term"]: math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1))) for r in dfs}
        found = _pass(index, counts, weights, n, total, k)
        order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(batch)], f"number int, item_id {kind}")
        out = out.unionByName(checkpointed(found.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score")))
    return out
