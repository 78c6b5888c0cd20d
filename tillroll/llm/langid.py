"""Language identification by a bidirectional gated recurrent network over bytes (operator 3).

The network reads the bytes of a word (white-space separated; longer words are
read in segments) in both directions, labels every position with a distribution
over the languages, and a document's distribution is the mean over the positions
of all its words.  State starts anew at each word, so a batch's distinct words
are read once and weighted by how often they occur.  It is trained in numpy by
backpropagation through time on a bounded sample of labelled rows.
"""

from __future__ import annotations

import pickle
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

UNKNOWN = "und"
SEGMENT = 48                     # bytes of a word that are read in one go
LETTER = regex.compile(r"\p{L}")  # a numeral such as one half is no letter
SPREAD = 32                      # parts in which a language's sample is chosen before the parts are merged


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _segments(words: list[bytes]) -> tuple[list[bytes], list[int]]:
    """Words cut into segments, and the word that each segment belongs to."""
    out, owner = [], []
    for i, w in enumerate(words):
        for at in range(0, len(w), SEGMENT):
            out.append(w[at:at + SEGMENT])
            owner.append(i)
    return out, owner


def _matrix(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes, one row a segment, padded with 0 on the right; and the mask of real bytes."""
    width = max(map(len, segments))
    x = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in segments), np.uint8).reshape(len(segments), width)
    n = np.fromiter(map(len, segments), np.int64, len(segments))
    return x, np.arange(width)[None, :] < n[:, None]


@dataclass
class Network:
    """Gated recurrent units in both directions and a softmax at every position."""

    langs: list[str]
    w: dict[str, np.ndarray]
    words: int = 0               # of the language with the fewest words to learn from
    by_lang: dict[str, int] = field(default_factory=dict)        # words to learn from, by language

    @classmethod
    def new(cls, langs: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w[d + "x"] = rng.normal(0, 0.3, (256, 3 * hidden))       # a byte's part of the gates and the candidate
            w[d + "u"] = rng.normal(0, hidden ** -0.5, (hidden, 2 * hidden))
            w[d + "c"] = rng.normal(0, hidden ** -0.5, (hidden, hidden))
            w[d + "o"] = rng.normal(0, hidden ** -0.5, (hidden, len(langs)))
        w["ob"] = np.zeros(len(langs))
        return cls(langs, {k: v.astype(np.float32) for k, v in w.items()})

    def _read(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States at every position, read from the left (f) or from the right (b)."""
        n, width = x.shape
        hid = self.w[d + "c"].shape[0]
        h = np.zeros((n, hid), np.float32)
        states = np.zeros((width, n, hid), np.float32)
        for t in (range(width) if d == "f" else range(width - 1, -1, -1)):
            a = self.w[d + "x"][x[:, t]]
            gates = _sigmoid(a[:, :2 * hid] + h @ self.w[d + "u"])
            z, r = gates[:, :hid], gates[:, hid:]
            c = np.tanh(a[:, 2 * hid:] + (r * h) @ self.w[d + "c"])
            m = mask[:, t:t + 1]
            new = np.where(m, h + z * (c - h), h)
            if keep is not None:
                keep.append((t, h, z, r, c, m))
            h = new
            states[t] = h
        return states

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(rows, positions, languages); padding positions are meaningless."""
        y = self._read("f", x, mask, None) @ self.w["fo"] + self._read("b", x, mask, None) @ self.w["bo"] + self.w["ob"]
        y = np.exp(y - y.max(-1, keepdims=True))
        return (y / y.sum(-1, keepdims=True)).transpose(1, 0, 2)

    def gradients(self, x: np.ndarray, mask: np.ndarray, lang: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the positions and its gradients, by backpropagation through time."""
        tape: dict[str, list] = {"f": [], "b": []}
        states = {d: self._read(d, x, mask, tape[d]) for d in "fb"}
        y = states["f"] @ self.w["fo"] + states["b"] @ self.w["bo"] + self.w["ob"]
        y = np.exp(y - y.max(-1, keepdims=True))
        p = y / y.sum(-1, keepdims=True)
        weight = (mask.T / mask.sum()).astype(np.float32)
        picked = p[:, np.arange(len(x)), lang]
        loss = float(-(np.log(picked + 1e-9) * weight).sum())
        dy = p
        dy[:, np.arange(len(x)), lang] -= 1
        dy *= weight[..., None]
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        g["ob"] = dy.sum((0, 1))
        for d in "fb":
            hid = self.w[d + "c"].shape[0]
            g[d + "o"] = np.einsum("tnh,tnl->hl", states[d], dy, optimize=True)
            dh = np.zeros((len(x), hid), np.float32)
            for t, h, z, r, c, m in reversed(tape[d]):
                dh = dh + dy[t] @ self.w[d + "o"].T
                live = dh * m
                dz = live * (c - h) * z * (1 - z)
                dc = live * z * (1 - c * c)
                drh = dc @ self.w[d + "c"].T
                dr = drh * h * r * (1 - r)
                gates = np.concatenate([dz, dr], 1)
                g[d + "c"] += (r * h).T @ dc
                g[d + "u"] += h.T @ gates
                np.add.at(g[d + "x"], x[:, t], np.concatenate([gates, dc], 1))
                dh = np.where(m, live * (1 - z) + drh * r + gates @ self.w[d + "u"].T, dh)
        return loss, g


def train(words: list[tuple[bytes, str]], langs: list[str], hidden: int = 12, epochs: int = 6,
          batch: int = 256, rate: float = 0.01, seed: int = 7) -> Network:
    """Fit the network to (word, language) pairs with Adam; the same input gives the same network."""
    net = Network.new(langs, hidden, seed)
    index = {lang: i for i, lang in enumerate(langs)}
    pairs = [(w[:SEGMENT], index[lang]) for w, lang in words if w]
    pairs.sort(key=lambda p: len(p[0]))
    rng = np.random.default_rng(seed)
    m1 = {k: np.zeros_like(v) for k, v in net.w.items()}
    m2 = {k: np.zeros_like(v) for k, v in net.w.items()}
    blocks = [pairs[i:i + batch] for i in range(0, len(pairs), batch)]   # words of like length together
    data = [(*_matrix([w for w, _ in b]), np.array([i for _, i in b])) for b in blocks]
    step = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(data)):
            _, g = net.gradients(*data[k])
            step += 1
            lr = rate * (1 - 0.8 * epoch / epochs)
            for name, v in net.w.items():
                m1[name] += 0.1 * (g[name] - m1[name])
                m2[name] += 0.01 * (g[name] ** 2 - m2[name])
                v -= (lr * (m1[name] / (1 - 0.9 ** step)) / (np.sqrt(m2[name] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def labelled_words(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", docs_per_lang: int = 300,
                   words_per_doc: int = 40) -> list[tuple[bytes, str]]:
    """A bounded sample of labelled words: at most docs_per_lang * words_per_doc a language.

    Distinct texts are chosen by hash, copies counting once, and words by a hash of the
    word and its place, from the whole texts; a word longer than a segment gives any one of its segments.  Only non-null,
    non-empty languages and texts take part.
    """
    rows = (docs.select(docs[lang_col].alias("lang"), docs[text_col].cast("string").alias("text"))
            .where("lang IS NOT NULL AND lang <> '' AND text RLIKE '\\\\S'")
            .withColumn("key", F.xxhash64("lang", "text")))
    keys = rows.select("lang", "key").distinct()
    # the least keys of each part, then of the language: the second step reads SPREAD * docs_per_lang rows a language
    for by in (["lang", F.pmod(F.xxhash64("key"), F.lit(SPREAD))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("key"))
        keys = keys.withColumn("rank", rank).where(F.col("rank") <= docs_per_lang).select("lang", "key")
    picked = keys
    # a long word gives one of its segments, cut here, so that what is collected is bounded
    word = F.transform(F.split("text", r"\s+"), lambda w, i: F.struct(F.xxhash64(w, i, F.col("key")).alias("h"), w.alias("w")))
    word = F.slice(F.array_sort(F.filter(word, lambda w: F.length(w["w"]) > 0)), 1, words_per_doc)
    words = F.transform(word, lambda w: F.substring(
        w["w"], (F.pmod(w["h"], F.ceil(F.length(w["w"]) / SEGMENT)) * SEGMENT + 1).cast("int"), F.lit(SEGMENT)))
    # picked holds at most docs_per_lang keys a language
    sample = (rows.join(F.broadcast(picked), ["lang", "key"]).select("lang", "key", words.alias("ws"))
              .dropDuplicates(["lang", "key"]).select("lang", "ws").collect())
    return [(w[:SEGMENT].encode()[:SEGMENT], r["lang"]) for r in sorted(sample, key=lambda r: (r["lang"], r["ws"])) for w in r["ws"]]


def fit(docs: DataFrame, **sizes) -> Network | None:
    """A network for the languages of ``docs``, or None where no labelled text is left to learn from."""
    words = labelled_words(docs, **sizes)
    langs = sorted({lang for _, lang in words})
    if not langs:
        return None
    net = train(words, langs)
    net.by_lang = dict(Counter(lang for _, lang in words))
    net.words = min(net.by_lang.values())
    return net


class Reader:
    """Pooled word distributions with a bounded cache."""

    def __init__(self, net: Network, most: int = 250_000, rows: int = 2048):
        self.net, self.most, self.rows = net, most, rows
        self.cache: dict[str, int] = {}
        self.sums = np.zeros((0, len(net.langs)))

    def learn(self, words: set[str]) -> None:
        """Sum of the distributions over the positions of each new word."""
        if len(self.cache) + len(words) > self.most:
            self.cache, self.sums = {}, self.sums[:0]
        new = sorted(words - self.cache.keys(), key=len)
        if not new:
            return
        segments, owner = _segments([w.encode("utf-8", "replace") for w in new])
        order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
        sums = np.zeros((len(new), len(self.net.langs)))
        for at in range(0, len(order), self.rows):
            some = order[at:at + self.rows]
            x, mask = _matrix([segments[i] for i in some])
            p = (self.net.probabilities(x, mask) * mask[..., None]).sum(1)
            np.add.at(sums, [owner[i] for i in some], p)
        self.cache.update(zip(new, range(len(self.sums), len(self.sums) + len(new))))
        self.sums = np.concatenate([self.sums, sums])

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [t.split() for t in texts]
        self.learn(set().union(*split) if split else set())
        out = []
        get = self.cache.__getitem__
        for t, ws in zip(texts, split):
            if not LETTER.search(t):
                out.append((UNKNOWN, 0.0))
                continue
            total = self.sums[np.fromiter(map(get, ws), np.int64, len(ws))].sum(0)
            best = int(total.argmax())
            out.append((self.net.langs[best], float(total[best] / total.sum())))
        return out


def predict(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score added, one row per input row, in one pass without a shuffle.

    lang_pred is ``und`` and score 0 where text is null, empty or has no letter,
    or where ``net`` is None.  The text is read whole; no other column is an input.
    Columns of the same names as the added ones are replaced.  Equal texts get equal
    results; an empty table stays empty.
    """
    held = pickle.dumps((net.langs, net.w)) if net is not None else None
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches):
        reader = Reader(Network(*pickle.loads(held))) if held else None
        for batch in batches:
            for part in slices(batch, text_col):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                got = reader.predict(texts) if reader else [(UNKNOWN, 0.0)] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    names=[*part.schema.names, "lang_pred", "score"])

    src = docs.select(*(docs[c] for c in keep))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    return src.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def held_out(doc_id) -> F.Column:
    """Documents kept from training: CRC-32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, **sizes) -> DataFrame:
    """Fit on the labelled, not held-out rows of ``docs`` and predict every row.

    Adds held_out (false for a null id), lang_pred and score to the columns of ``docs``.
    """
    docs = docs.withColumn("held_out", held_out("doc_id"))
    return predict(docs, fit(docs.where(~F.col("held_out")), **sizes))
