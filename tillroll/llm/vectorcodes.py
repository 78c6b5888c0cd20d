"""Vector codes by codebooks that a GNAT searches (operator 11).

A vector is read as whole numbers, cut into parts, and each part replaced by the number
of its nearest codebook entry.  The entries of a codebook stand in a geometric
near-neighbour access tree: a node has split points among its entries, every other
entry hangs under its nearest split point, and the node stores, for each split point
and each subtree, the range of the distances between them.  A query's distances to the
split points, with the best distance so far, show by the triangle inequality which
subtrees hold nothing as near.  Only the bounds are rounded, and always to the safe
side; a subtree goes only where the inequality is strict, so equal distances survive
and are settled in whole numbers by the lower entry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
FANOUT = 16              # split points of a node
LEAF = 16                # entries that are compared without a further split
ROWS = 4096              # vectors searched together
SLACK = 2.0 ** -48       # relative widening of rounded distances, far above the error of a root and a sum


def squared(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``q`` to all rows of ``e``, as 64-bit integers.

    While all sums stay below 2^53 doubles are exact and a matrix product serves.
    """
    if not len(q) or not len(e):
        return np.zeros((len(q), len(e)), np.int64)
    reach = int(np.abs(q).max()) + int(np.abs(e).max())
    if reach * reach * q.shape[1] < 1 << 53:
        x, y = q.astype(np.float64), e.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None, :]).astype(np.int64)
    out = np.zeros((len(q), len(e)), np.int64)
    for j in range(q.shape[1]):
        d = q[:, j, None] - e[None, :, j]
        out += d * d
    return out


def _below(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 - SLACK)


def _above(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 + SLACK)


class Gnat:
    """Tree over the rows ``at`` of ``entries``: split points, subtrees, and the least and greatest distance between them."""

    def __init__(self, entries: np.ndarray, at: np.ndarray | None = None, fanout: int = FANOUT, leaf: int = LEAF):
        self.entries = entries
        self.at = np.arange(len(entries)) if at is None else at
        self.children: list[Gnat] = []
        own = entries[self.at]
        if len(own) <= leaf:
            return
        # split points: the first entry, then always the one farthest from those chosen; copies of them are not chosen
        chosen, near = [0], squared(own, own[:1])[:, 0]
        while len(chosen) < fanout and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, squared(own, own[chosen[-1:]])[:, 0])
        if len(chosen) == 1:
            return                                  # all entries are equal
        d2 = squared(own, own[chosen])
        home = d2.argmin(axis=1)
        home[chosen] = -1
        kept = [j for j in range(len(chosen)) if (home == j).any()]
        self.splits = self.at[chosen]
        self.children = [Gnat(entries, self.at[home == j], fanout, leaf) for j in kept]
        self.owner = np.array(kept, np.int64)
        self.least = np.array([_below(d2[home == j].min(axis=0)) for j in kept])        # [subtree, split point]
        self.most = np.array([_above(d2[home == j].max(axis=0)) for j in kept])

    def _look(self, q: np.ndarray, rows: np.ndarray, at: np.ndarray, best: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Compare ``rows`` with the entries ``at``; nearer ones, and equally near ones of a lower number, are taken."""
        d2 = squared(q[rows], self.entries[at])
        low = d2.min(axis=1)
        number = np.where(d2 == low[:, None], at[None, :], np.iinfo(np.int64).max).min(axis=1)
        better = (low < best[rows]) | ((low == best[rows]) & (number < entry[rows]))
        best[rows[better]], entry[rows[better]] = low[better], number[better]
        return d2

    def search(self, q: np.ndarray, rows: np.ndarray, best: np.ndarray, entry: np.ndarray) -> int:
        """Nearest entries of ``q[rows]`` into ``best`` and ``entry``; returns the number of distances computed."""
        if not len(rows):
            return 0
        if not self.children:
            self._look(q, rows, self.at, best, entry)
            return len(rows) * len(self.at)
        d2 = self._look(q, rows, self.splits, best, entry)
        low, high, home = _below(d2), _above(d2), d2.argmin(axis=1)
        count = d2.size
        for first in (True, False):                 # the subtree of the nearest split point first: it shrinks the ball
            for j, child in enumerate(self.children):
                mine = np.flatnonzero((home == self.owner[j]) == first)
                reach = _above(best[rows[mine]])[:, None]
                gone = (low[mine] - reach > self.most[j]) | (high[mine] + reach < self.least[j])
                count += child.search(q, rows[mine[~gone.any(axis=1)]], best, entry)
        return count


def nearest(tree: Gnat, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of ``q`` the number of its nearest entry (the lower of equals), the squared distance, and the work done."""
    best = np.full(len(q), np.iinfo(np.int64).max)
    entry = np.full(len(q), np.iinfo(np.int64).max)
    count = tree.search(q, np.arange(len(q)), best, entry)
    return entry, best, count


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = PARTS, scale: int = SCALE) -> tuple[DataFrame, int]:
    """(vec_id, label, v) of the rows that are coded, with v = floor(scale * component), stored; and the length of v."""
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"),
                          vectors[vector_col].cast("array<double>").alias("x"))
    most = F.floor(F.sqrt(F.lit(float(1 << 62)) / F.size("x")) / 2)
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") > 0) & (F.size("x") % parts == 0))
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < most)))
    lengths = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    width = lengths[0]["n"] if lengths else 0
    numbers = F.transform("x", lambda c: F.floor(c * scale).cast("int"))
    return stored(rows.where(F.size("x") == width).select("vec_id", "label", numbers.alias("v")), "vector-numbers"), width


def _sums(rows: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """(part, entry, n, sums) of every task: its vectors added up by nearest entry."""
    parts, d = len(books), width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                v = _matrix(batch.column("v").slice(at, ROWS), width)
                for p in range(parts):
                    q = v[:, p * d:(p + 1) * d]
                    entry, _, _ = nearest(trees[p], q)
                    count[p] += np.bincount(entry, minlength=len(books[p]))
                    np.add.at(total[p], entry, q)
        used = [(p, int(e)) for p in range(parts) for e in np.flatnonzero(count[p])]
        if used:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
                 pa.array([int(count[p][e]) for p, e in used], pa.int64()),
                 pa.array([total[p][e] for p, e in used], pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    return rows.select("v").mapInArrow(run, "part int, entry int, n long, sums array<long>")


def fit(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks, one integer matrix a part: the parts of the first ``entries`` vectors by id, moved ``rounds`` times.

    A round gives each entry the componentwise floor of the mean of the parts nearest to
    it; an unused entry stays.  All vectors take part.  What reaches the driver is the
    codebooks, at most ``entries`` * ``width`` numbers.
    """
    d = width // parts
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    first = np.array([r["v"] for r in seeds], np.int64).reshape(-1, width)
    books = [first[:, p * d:(p + 1) * d].copy() for p in range(parts)]
    for _ in range(rounds if len(first) else 0):
        sums = _sums(rows, books, width).select("part", "entry", F.col("n").cast("decimal(38,0)").alias("n"), F.posexplode("sums").alias("pos", "s"))
        moved = sums.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        for r in moved.collect():
            books[r["part"]][r["entry"], r["pos"]] = int(r["s"]) // int(r["n"])
    return books


def encode(rows: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """(vec_id, label, code, error): the entries' numbers as two hex digits a part, and the summed squared distances."""
    d = width // len(books)
    label = rows.schema["label"].dataType.simpleString()
    vec = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                v = _matrix(part.column("v"), width)
                found = [nearest(t, v[:, p * d:(p + 1) * d])[:2] for p, t in enumerate(trees)]
                codes = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                     pa.array(sum(e for _, e in found), pa.int64())], names=["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id {vec}, label {label}, code string, error long")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' numbers by part, entry and position, joined by commas."""
    return sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def decode(coded: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """(vec_id, decoded): the vector that each code stands for, in the scale of the input."""
    kind = coded.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [bytes.fromhex(c) for c in batch.column("code").to_pylist()]
            vectors = [np.concatenate([b[e] for b, e in zip(books, code)]) / scale for code in codes]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(vectors, pa.list_(pa.float64()))], names=["vec_id", "decoded"])

    return coded.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, decoded array<double>")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Codes of all vectors: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null, or holds null, NaN or an infinity, are dropped.  So are
    rows whose squared distances have no place in a 64-bit integer (components of some
    10^5 and more at 64 dimensions), empty vectors, lengths that four parts do not
    divide, and vectors of another length than most rows have (of equally frequent
    lengths the shorter counts).  Fewer than 256 vectors give as many entries.  Null ids
    come last in choosing the first entries, equal ids go by their numbers; repeated
    rows give a row each; null labels are one group; ``label_error`` is null where the
    sum has no place in a 64-bit integer.  An empty table gives no rows, and other
    columns are ignored.
    """
    rows, width = whole_numbers(vectors, id_col, vector_col, label_col)
    books = fit(rows, width) if width else []
    if not width:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = stored(encode(rows, books, width), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    totals = stored(coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "__label"), "vector-labels")
    return coded.join(totals, coded["label"].eqNullSafe(totals["__label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
