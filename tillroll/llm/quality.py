"""Document quality rules with an n-gram perplexity band (operator 2).

Base rules count words, symbols, repeated lines and repeated word windows.  The
method's verdict comes from a character 4-gram model with modified Kneser-Ney
smoothing.  Characters are whole code points and n-grams are 64-bit hashes, so the
tables grow with the corpus; they are stored by Spark and never come to one place.
The texts are read in runs of consecutive documents: a run's distinct n-grams meet
the tables in a join, and the run's documents are scored with the rows that come back.

Every text is in the counts, and a model this large would know it by heart.  So a text
is scored by what the other texts hold: its own counts, and those of its exact copies,
are taken off in every order.  Each language has its own lower and upper perplexity
band; documents outside it are rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, slices, stored, text_of

GRAM = 4                     # characters of the longest n-gram
START = 0x110000             # stands before a text, where no character can
STEP = 0x9E3779B97F4A7C15    # of the polynomial hash
RUN = 32 << 20               # bytes of text whose n-grams meet the tables together
SLICE = 1 << 18              # bytes of text in arrays at once: they stay in a core's cache
MERGE = 1 << 19              # n-grams of a run that are gathered before equal ones meet
WORD = re.compile(r"[^\x20\x09-\x0d]+")
SPACES = " \t\n\v\f\r"
SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 5
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(text: str) -> tuple[int, int, int, int, int]:
    """The base counts of one text, in the order of BASE_COLUMNS."""
    words = text.encode("utf-8", "surrogatepass").split()          # bytes: ASCII white space only, as in WORD
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif WORD.search(line):
            seen.add(line)
    chars = len(text) - sum(map(text.count, SPACES))
    return len(words), chars, len(SYMBOLS.findall(text)), dup, _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words inside a window of five words that stands twice or more in the text.

    Equal windows have equal hashes, so only windows whose hash comes twice are compared.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = each[:n].copy()
    for i in range(1, WINDOW):
        window = window * np.uint64(STEP) + each[i:n + i]
    order = np.argsort(window)
    held = window[order]
    alike = held[1:] == held[:-1]
    if not alike.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][alike]] = twice[order[:-1][alike]] = True
    first: dict[tuple, int] = {}
    marked = np.zeros(len(words) + 1, np.int64)
    for i in np.flatnonzero(twice).tolist():
        j = first.setdefault(tuple(words[i:i + WINDOW]), i)
        if j != i:
            marked[[i, j]] = 1, 1
    starts = np.flatnonzero(marked)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return int((np.cumsum(cover)[:len(words)] > 0).sum())


def hashes_of(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the n-grams of 0 to GRAM characters that end at each place, the places of the texts' characters, and their texts.

    An n-gram's hash is a polynomial in its characters; the context of the one at place
    i is the one of an order less at i - 1, its suffix the one of an order less at i.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    pad = GRAM - 1
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(raw)) + pad * (owner + 1)
    c = np.full(len(raw) + pad * len(texts), START + 1, np.uint64)
    c[at] = raw + np.uint32(1)
    grams = [np.zeros(len(c), np.uint64), c]
    for k in range(2, GRAM + 1):
        more = grams[-1].copy()
        more[k - 1:] += c[:len(c) - k + 1] * np.uint64(pow(STEP, k - 1, 1 << 64))
        grams.append(more)
    return grams, at, owner


def _alike(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A place of each distinct value, each place's number among them, and how many places each has."""
    order = np.argsort(x)
    held = x[order]
    new = np.ones(len(x), bool)
    new[1:] = held[1:] != held[:-1]
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back, np.diff(np.append(np.flatnonzero(new), len(x)))


def numbered(docs: DataFrame, packed: bool = False) -> DataFrame:
    """doc_id, lang and text of ``docs`` with the text's hash and the run of documents it belongs to.

    ``packed`` gives the texts compressed by zstandard instead: they are shuffled once, to
    their runs, and need less disk there.
    """
    src = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text_of(F.col("text").cast("string")).alias("text"))
    src = src.withColumn("text_hash", F.xxhash64("text"))

    def run(batches):
        at = TaskContext.get().partitionId() << 33
        held = 0
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            before = held + np.cumsum(sizes) - sizes
            held += int(sizes.sum())
            texts = batch.column("text")
            if packed:
                pack = zstandard.ZstdCompressor(level=1).compress
                texts = pa.array([pack(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(at + before // RUN, pa.int64()), batch.column("doc_id"), batch.column("lang"),
                                              texts, batch.column("text_hash")], names=["run", "doc_id", "lang", name, "text_hash"])

    kind = src.schema["doc_id"].dataType.simpleString()
    name, held = ("packed", "binary") if packed else ("text", "string")
    return src.mapInArrow(run, f"run long, doc_id {kind}, lang string, {name} {held}, text_hash long")


def _unpacked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows with their texts, as many together as hold about ``SLICE`` bytes; a longer text stands alone."""
    if "packed" not in batch.schema.names:
        yield from slices(batch, "text", SLICE)
        return
    unpack, texts, size, at = zstandard.ZstdDecompressor().decompress, [], 0, 0
    names = [n for n in batch.schema.names if n != "packed"]

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        text = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*(part.column(n) for n in names), text], names=[*names, "text"])

    for i, p in enumerate(batch.column("packed").to_pylist()):
        n = zstandard.frame_content_size(p)
        if texts and size + n > SLICE:
            yield rows(batch.slice(at, len(texts)))
            texts, size, at = [], 0, i
        texts.append(unpack(p))
        size += n
    if texts:
        yield rows(batch.slice(at, len(texts)))


def run_ngrams(docs: DataFrame) -> DataFrame:
    """The distinct n-grams of each run: (run, size, gram, context, suffix, n); texts themselves are rows of size 0.

    n counts the longest n-grams and the texts; it is 0 for the orders between.
    """
    names = ["run", "size", "gram", "context", "suffix", "n"]

    def distinct(parts):
        size, gram, context, suffix, n = map(np.concatenate, zip(*parts))
        first, back, _ = _alike(gram)
        return size[first], gram[first], context[first], suffix[first], np.bincount(back, n, len(first)).astype(np.int64)

    def rows(run, parts):
        size, *cols = distinct(parts)
        for at in range(0, len(size), 100_000):
            cut = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(size[cut]), run), pa.int64()), pa.array(size[cut], pa.int32()),
                 *(pa.array(c[cut].view(np.int64), pa.int64()) for c in cols)], names=names)

    def run(batches):
        now, parts, fresh = None, [], 0
        for batch in batches:
            for part in _unpacked(batch):
                runs = part.column("run").to_numpy()
                for one in np.unique(runs):
                    if parts and one != now:
                        yield from rows(now, parts)
                        parts, fresh = [], 0
                    now = int(one)
                    its = np.flatnonzero(runs == one)
                    own = part.slice(int(its[0]), len(its))
                    texts = own.column("text_hash").to_numpy().view(np.uint64)
                    none = np.zeros(len(texts), np.uint64)
                    parts.append((np.zeros(len(texts), np.int32), texts, none, none, np.ones(len(texts), np.int64)))
                    grams, at, _ = hashes_of(own.column("text").to_pylist())
                    first, _, n = _alike(grams[GRAM][at])
                    at = at[first]
                    for k in range(GRAM, 0, -1):
                        if k < GRAM:
                            first, _, n = _alike(grams[k][at])
                            at, n = at[first], np.zeros(len(first), np.int64)
                        parts.append((np.full(len(at), k, np.int32), grams[k][at], grams[k - 1][at - 1],
                                      grams[k - 1][at], n.astype(np.int64)))
                    fresh += sum(len(p[0]) for p in parts[-GRAM - 1:])
                    if fresh > MERGE:
                        parts, fresh = [distinct(parts)], 0
        if parts:
            yield from rows(now, parts)

    return docs.mapInArrow(run, "run long, size int, gram long, context long, suffix long, n long")


def tables(rows: DataFrame) -> tuple[DataFrame, dict[int, list[float]], int]:
    """The model over all texts: its rows (gram, count, total, mass), each order's discounts, the number of characters.

    The longest n-grams have raw counts, each lower one counts the distinct characters
    before it.  total and mass are those of the n-gram's context: all counts and all
    discounts after it.  A text's row has the number of its copies.
    """
    whole = rows.groupBy("gram").agg(F.first("size").alias("size"), F.first("context").alias("context"),
                                     F.first("suffix").alias("suffix"), F.sum("n").alias("n"))
    whole = stored(whole, "quality-ngrams")
    lower = whole.where("size > 1").select(F.col("suffix").alias("gram"), F.lit(None).cast("int").alias("size"),
                                           F.lit(None).cast("long").alias("context"), F.lit(1).cast("long").alias("n"))
    counts = (whole.select("gram", "size", "context", "n").unionByName(lower).groupBy("gram")
              .agg(F.max("size").alias("size"), F.max("context").alias("context"), F.sum("n").alias("count")))
    counts = stored(counts, "quality-counts")
    seen = {r["size"]: r for r in counts.where("size > 0").groupBy("size").agg(
        F.count(F.lit(1)).alias("all"), *(F.count_if(F.col("count") == i).alias(f"n{i}") for i in (1, 2, 3, 4))).collect()}
    discounts = {k: discounts_of([r[f"n{i}"] for i in (1, 2, 3, 4)]) for k, r in seen.items()}
    discount = F.lit(0.0)
    for k, d in discounts.items():
        by_count = F.when(F.col("count") >= 3, d[3]).when(F.col("count") == 2, d[2]).otherwise(d[1])
        discount = F.when(F.col("size") == k, by_count).otherwise(discount)
    after = counts.where("size > 0").groupBy("size", "context").agg(F.sum("count").alias("total"), F.sum(discount).alias("mass"))
    # the texts' own rows have no context; in the join they would all meet in one key
    table = counts.where("size > 0").join(after, ["size", "context"], "left").select("gram", "count", "total", "mass")
    table = table.unionByName(counts.where("size = 0").select("gram", "count"), allowMissingColumns=True)
    return table, discounts, seen[1]["all"] if 1 in seen else 0


def discounts_of(of: list[int]) -> list[float]:
    """Modified Kneser-Ney's discounts of the counts 0, 1, 2 and 3 or more, from how many n-grams have the counts 1 to 4."""
    y = of[0] / (of[0] + 2 * of[1]) if of[0] + 2 * of[1] else 0.0
    return [0.0] + [min(max(i - (i + 1) * y * of[i] / of[i - 1], 0.0), i) if of[i - 1] else 0.0 for i in (1, 2, 3)]


def log_probs(texts: list[str], copies: np.ndarray, table: tuple, discounts: dict[int, list[float]], characters: int) -> list[float | None]:
    """Mean log probability a character of each text under the counts of all texts but itself and its copies.

    ``table`` has the sorted hashes of at least the texts' n-grams with counts, totals and masses.
    """
    keys, counts, totals, masses = table
    grams, at, owner = hashes_of(texts)
    if not len(at):
        return [None] * len(texts)
    salt = owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    first, _, n = _alike(grams[GRAM][at] + salt)
    at, owner, salt = at[first], owner[first], salt[first]
    top, weight = owner, n                     # the texts' distinct n-grams, and how often each stands in its text
    own = n * copies[owner]
    levels = []
    for k in range(GRAM, 0, -1):
        gram = grams[k][at].view(np.int64)
        row = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
        if not (keys[row] == gram).all():
            raise RuntimeError("the documents came in another order when they were read again: in_place is for tables read from files")
        d = np.array(discounts[k])
        count = counts[row]
        rest = np.maximum(count - own, 0)
        kept = d[np.minimum(rest, 3)]
        _, group, _ = _alike(grams[k - 1][at - 1] + salt)
        total = totals[row] - np.bincount(group, own)[group]
        mass = masses[row] + np.bincount(group, kept - d[np.minimum(count, 3)])[group]
        some = total > 0
        size = np.where(some, total, 1)
        seen, back = np.where(some, (rest - kept) / size, 0.0), np.where(some, np.maximum(mass, 0.0) / size, 1.0)
        if k > 1:
            first, down, _ = _alike(grams[k - 1][at] + salt)
            own = np.bincount(down, rest == 0).astype(np.int64)      # n-grams that no other text holds count before no other
            at, salt = at[first], salt[first]
            levels.append((seen, back, down))
    p = seen + back / (characters + 1)
    for seen, back, down in reversed(levels):
        p = seen + back * p[down]
    total = np.bincount(top, weight * np.log(np.maximum(p, 1e-12)), len(texts))   # a tiny corpus may leave no weight for the unseen
    return [float(x / len(t)) if t else None for x, t in zip(total.tolist(), texts)]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", in_place: bool = False) -> DataFrame:
    """Base counts and mean log probability a character of every whole text, one row per input row.

    The documents are read twice, in runs.  The runs are stored first, so their order
    need not be the same when they are made again; ``in_place`` spares that copy for a
    table that is read from files as it is, whose partitions and order are (else this fails).
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[text_col].alias("text"))
    src = numbered(docs, packed=True)
    if not in_place:
        src = stored(src, "quality-documents")
    rows = stored(run_ngrams(numbered(docs) if in_place else src), "quality-runs")
    table, discounts, characters = tables(rows)
    known = rows.select("run", "gram").join(table, "gram")

    def run(docs, known):
        order = np.argsort(known.column("gram").to_numpy())
        held = tuple(known.column(c).fill_null(0).to_numpy()[order] for c in ("gram", "count", "total", "mass"))
        out = []
        for batch in docs.to_batches():
            for part in _unpacked(batch):
                texts = part.column("text").to_pylist()
                copies = held[1][np.minimum(np.searchsorted(held[0], part.column("text_hash").to_numpy()), len(held[0]) - 1)]
                cols = list(zip(*map(measures, texts)))
                out.append(pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lang"), *(pa.array(c, pa.int64()) for c in cols),
                     pa.array(list(map(len, texts)), pa.int64()),
                     pa.array(log_probs(texts, copies, held, discounts, characters), pa.float64())],
                    names=["doc_id", "lang", *BASE_COLUMNS, "n_chars", "log_prob"]))
        return pa.Table.from_batches(out)

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.groupBy("run").cogroup(known.groupBy("run")).applyInArrow(
        run, f"doc_id {kind}, lang string, " + ", ".join(f"{c} long" for c in BASE_COLUMNS) + ", n_chars long, log_prob double")


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_words: int = 10,
           max_repeat_percent: int = 20, width: float = 3.0, steady_chars: int = 1000, in_place: bool = False) -> DataFrame:
    """Keep or reject every document by the base rules and its language's perplexity band.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    perplexity, band_low, band_high, base_failed, kept.  A language's band is the
    median of the log perplexity of its documents that pass the base rules, plus or
    minus ``width`` times half their interquartile range (at least 2 % of the
    median); all documents count.  A short text's mean is noisier, so for n characters
    the band is sqrt(1 + steady_chars / n) times as wide.  Null languages share one band.  Null text is read
    as empty: it has no words, no perplexity, and fails the base rules.  Null and
    equal ids and repeated rows give a row each; an empty table gives none.  Very long
    texts are counted and scored whole; other columns, whatever their names, are ignored.
    ``in_place`` is for tables read from files (see ``score``).
    """
    scored = score(docs, id_col, text_col, lang_col, in_place)
    failed = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat_percent) * F.col("n_words"))
    scored = checkpointed(scored.withColumn("base_failed", failed).withColumn("log_ppl", -F.col("log_prob"))
                          .withColumn("lang", F.coalesce("lang", F.lit(""))))
    usable = scored.where("NOT base_failed")
    cuts = usable.groupBy("lang").agg(F.percentile_approx("log_ppl", [0.25, 0.5, 0.75], 10_000).alias("q"))
    mid, spread = F.col("q")[1], (F.col("q")[2] - F.col("q")[0]) / 2
    bands = cuts.select("lang", mid.alias("mid"), (F.lit(width) * F.greatest(spread, F.lit(0.02) * F.abs(mid))).alias("reach"))
    bands = stored(bands, "quality-bands")        # a row a language: Spark sees that it is small, and no language meets in one task
    reach = F.col("reach") * F.sqrt(1 + F.lit(steady_chars) / F.greatest("n_chars", F.lit(1)))
    out = scored.join(bands, "lang", "left").withColumn("low", F.col("mid") - reach).withColumn("high", F.col("mid") + reach)
    inside = F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(False))
    return out.select("doc_id", *BASE_COLUMNS, F.exp("log_ppl").alias("perplexity"), F.exp("low").alias("band_low"),
                      F.exp("high").alias("band_high"), "base_failed", (~F.col("base_failed") & inside).alias("kept"))
