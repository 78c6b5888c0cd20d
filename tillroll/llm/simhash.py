"""SimHash near-duplicates through a byte-position inverted index (operator 6).

A text's 64-bit fingerprint is read as eight positional bytes.  Two fingerprints that
differ in at most four bits agree in at least four of the eight, so the posting lists
are keyed by three positions and their bytes, over twenty triples of positions chosen
so that any four positions hold one of the triples.  Fingerprints that meet in a list
are tallied by their shared positional bytes, those with the guaranteed minimum are
verified bit by bit, and each list gives a spanning forest of its links, never all of
its pairs.  Connected components come from Spark joins.
"""

from __future__ import annotations

from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, sized, slices, text_of

SEED = 42
POSITIONS = 8
FEW = 8            # list length up to which pairs are compared in arrays over many lists at once


def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash of the lower-cased (A-Z) word shingles, repeats included; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()     # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[:n - shingle] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        h = np.array(hashes[at:at + (1 << 14)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, text_sha, fp) of every whole text, one row per input row; fp as a signed 64-bit integer."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                fps = [fingerprint(t or "", shingle) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_sha"),
                                                  pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())],
                                                 names=["doc_id", "text_sha", "fp"])

    src = docs.select(docs[id_col].alias("doc_id"), F.sha2(text_of(docs[text_col].cast("string")), 256).alias("text_sha"),
                      docs[text_col].cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text_sha string, fp long")


def covering_triples() -> list[tuple[int, int, int]]:
    """Twenty triples of the eight positions such that any four positions hold one of them.

    The positions are cut into three groups; a triple lies in one group, or has two
    positions in a group and one in the next.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for t in combinations(range(POSITIONS), 3):
        n = [sum(group[p] == g for p in t) for g in range(3)]
        if max(n) == 3 or any(n[g] == 2 and n[(g + 1) % 3] == 1 for g in range(3)):
            out.append(t)
    return out


def postings(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint in the list of every triple of positions with its bytes there."""
    def byte(p: int) -> Column:
        return F.shiftright("fp", 8 * p).bitwiseAND(0xFF)

    keys = [F.lit(i << 24).cast("long") + byte(a) * 65536 + byte(b) * 256 + byte(c)
            for i, (a, b, c) in enumerate(covering_triples())]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _close(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs reach the minimum of shared positional bytes and then differ in at most ``distance`` bits."""
    diff = np.bitwise_xor(x, y).view(np.uint64)      # bits are counted of unsigned values only
    shared = (diff.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
    good = shared >= POSITIONS - distance
    good[good] = np.bitwise_count(diff[good]) <= distance
    return good


def forest(x: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join the members of one list into the components that all their links would give.

    Breadth first: each member reached is compared with those not reached yet, so a
    dense list needs few rounds and gives one link for each member it reaches.
    """
    links = []
    rest = np.arange(len(x))
    while rest.size:
        front, rest = [int(rest[0])], rest[1:]
        while front and rest.size:
            i = front.pop()
            near = _close(x[rest], np.broadcast_to(x[i], rest.shape), distance)
            if near.any():
                found = rest[near].tolist()
                links += [(i, j) for j in found]
                front += found
                rest = rest[~near]
    return links


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b) with a < b as signed integers: verified links that span the components of the distinct ``fps``."""
    if not 0 <= distance <= 4:
        raise ValueError("the triples of positions cover up to four differing bits")

    def emit(a, b):
        a, b = np.minimum(a, b), np.maximum(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        keys, values = np.zeros(0, np.int64), [np.zeros(0, np.int64)]
        for batch in chain(_blocks(batches), [None]):
            if batch is None:
                x = np.concatenate(values)
                whole = len(keys)
            else:
                k, v = batch
                if len(keys) and k[-1] == keys[-1] and k[0] == keys[-1]:      # one list goes on: keep it in parts
                    keys = np.concatenate([keys, k])
                    values.append(v)
                    continue
                keys, x = np.concatenate([keys, k]), np.concatenate([*values, v])
                whole = int(np.searchsorted(keys, keys[-1]))                  # the last list may go on
            done, at = keys[:whole], x[:whole]
            keys, values = keys[whole:], [x[whole:]]
            if not whole:
                continue
            start = np.flatnonzero(np.concatenate([[True], done[1:] != done[:-1]]))
            size = np.diff(np.concatenate([start, [whole]]))
            of = np.repeat(size, size)
            for step in range(1, FEW):
                i = np.flatnonzero((of[:-step] <= FEW) & (done[:-step] == done[step:])) if whole > step else []
                if len(i):
                    good = _close(at[i], at[i + step], distance)
                    if good.any():
                        yield emit(at[i][good], at[i + step][good])
            for s, n in zip(start[size > FEW].tolist(), size[size > FEW].tolist()):
                got = forest(at[s:s + n], distance)
                if got:
                    a, b = np.array(got).T
                    yield emit(at[s:s + n][a], at[s:s + n][b])

    def _blocks(batches):
        for b in batches:
            if b.num_rows:
                yield b.column("key").to_numpy(), b.column("fp").to_numpy()

    lists = postings(fps).repartition("key").sortWithinPartitions("key")
    return lists.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, nodes: int | None = None) -> DataFrame:
    """(node, label): the smallest node of each node's component, for the nodes of ``edges`` (a, b).

    Every round a node and its label take the smallest label among their neighbours,
    then labels are followed one step; a round that changes nothing ends it.  The state
    is checkpointed each round, so the lineage stays short; its files are as many as its
    rows ask for.  ``nodes``, if known, is about how many there are.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = checkpointed(sized(edges.select(F.explode(ways).alias("w")).select("w.a", "w.b"), nodes))
    ends = both.count()
    state = checkpointed(sized(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), ends))
    while True:
        met = (both.join(state.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
               .join(state.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b"))
        offers = (met.select(F.explode(F.array("a", "la")).alias("node"), F.col("lb").alias("offer"))
                  .groupBy("node").agg(F.min("offer").alias("offer")))
        hooked = state.join(offers, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("offer", "label")).alias("label"))
        parents = hooked.select(F.col("node").alias("label"), F.col("label").alias("parent"))
        after = checkpointed(sized(hooked.join(parents, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("parent", "label")).alias("label")), ends))
        changed = after.where("old <> label").limit(1).count()
        state = after.select("node", "label")
        if not changed:
            return state


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """Every row's fingerprint and component: doc_id, text_sha, fp, group_fp, component_id.

    ``group_fp`` names the component, ``component_id`` is its smallest doc_id (null if
    all are null).  Null text is read as empty; texts without words have fingerprint
    zero and are linked like any other.  Null and equal ids and repeated rows give a
    row each; an empty table gives none; other columns are ignored.
    """
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    n = rows.count()
    distinct = checkpointed(sized(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), n))
    joined = components(links(distinct.select("fp"), distance), n)
    named = (distinct.join(joined, F.col("fp") == F.col("node"), "left")
             .select("fp", "first_id", "n", F.coalesce("label", "fp").alias("group_fp"), F.col("node").isNotNull().alias("linked")))
    firsts = named.where("linked").groupBy("group_fp").agg(F.min("first_id").alias("group_id"))
    table = (named.where("linked OR n > 1").join(firsts, "group_fp", "left")
             .select("fp", "group_fp", F.when(F.col("linked"), F.col("group_id")).otherwise(F.col("first_id")).alias("group_id"),
                     F.lit(True).alias("shared")))
    return rows.join(table, "fp", "left").select(
        "doc_id", "text_sha", "fp", F.coalesce("group_fp", "fp").alias("group_fp"),
        F.when(F.col("shared"), F.col("group_id")).otherwise(F.col("doc_id")).alias("component_id"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id, then the smallest text digest.

    Null ids come last in a group; of fully repeated rows one stays.
    """
    found = groups(docs, shingle=shingle, distance=distance)
    first = found.groupBy("group_fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_sha")).alias("k"))
    chosen = first.select(F.col("k.doc_id").alias("__id"), F.col("k.text_sha").alias("__sha"))
    rows = docs.withColumn("__own", F.sha2(text_of(F.col("text")), 256))
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sha"))
    return rows.join(chosen, match, "left_semi").dropDuplicates(["doc_id", "__own"]).select(*docs.columns)
