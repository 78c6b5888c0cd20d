"""BPE by speculation and verification (operator 10, and the token source of operator 8).

Each white-space word is cut by the tokenizer's own pattern into pieces.  For a
piece the longest vocabulary token is taken again and again (the speculation).
The proposal is the exact BPE result when every adjacent pair of tokens is
compatible: undoing the merges of the pair from the last to the first, no merge
across the boundary would have come earlier than the merge that was made.  The
check runs on arrays of all distinct pairs of a batch at once.  Only pieces with
an incompatible pair are merged step by step.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slices

NONE = np.int64(1 << 40)
SHORT = 64                # bytes up to which pieces are merged together, by equal length
MAX_WORDS = 1_000_000     # cached words of a worker; the cache is emptied and refilled beyond that


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: byte values by letter."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBPE:
    """Vocabulary with word-end suffix, its merges, and a bounded cache of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        letters = _byte_letters()
        self.names = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.special_re = regex.compile("|".join(regex.escape(t) for t in self.special)) if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        self.stand_in = {b: c for c, b in letters.items()}

        size = max(self.names) + 1
        self.form = np.full(size, -1, np.int64)     # rank of the merge that makes a token
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        ordered = True                              # each token has one merge, later than its parts'
        for r, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.rank[x, y] = (r, z)
            ordered &= self.form[z] < 0 and self.form[x] < r and self.form[y] < r
            self.form[z], self.left[z], self.right[z] = r, x, y
        self.ordered = ordered
        keys = np.array([(x << 20) | y for x, y in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array([r for r, _ in self.rank.values()], np.int64)[order]

        self.first = [vocab[self.stand_in[b]] for b in range(256)]
        self.last = [vocab[self.stand_in[b] + suffix] for b in range(256)]
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for t, i in vocab.items():
            end = t.endswith(suffix) and t != suffix
            body = t[: -len(suffix)] if end else t
            if not body or any(c not in letters for c in body):
                continue
            raw = bytes(letters[c] for c in body)
            if len(raw) == 1 or self.merge(raw, end) == [i]:     # a token that BPE can reach
                (self.final if end else self.inner)[raw] = i
        self.words: dict[str, bytes] = {}
        self.first_of, self.last_of = np.array(self.first, np.int64), np.array(self.last, np.int64)
        self.made = np.array([z for _, z in self.rank.values()], np.int64)
        self.grow_tree()

    def merge(self, raw: bytes, end: bool = True) -> list[int]:
        """Exact merging of one piece with a heap: the lowest rank first, the leftmost of equal ranks."""
        ids = [self.first[b] for b in raw]
        if end:
            ids[-1] = self.last[raw[-1]]
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1])))]
        heapify(heap)
        while heap:
            _, i, x, y = heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = rank[x, y][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((ids[i], ids[k]))):
                    heappush(heap, (r[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (r := rank.get((ids[h], ids[i]))):
                heappush(heap, (r[0], h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]

    def ranks_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE where there is none."""
        key = (x.astype(np.int64) << 20) | y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_many(self, raws: list[bytes]) -> list[list[int]]:
        """Exact merging of many short pieces of one length, one merge a piece in each round."""
        n, width = len(raws), len(raws[0])
        raw = np.frombuffer(b"".join(raws), np.uint8).reshape(n, width)
        ids = self.first_of[raw]
        ids[:, -1] = self.last_of[raw[:, -1]]
        out: list[list[int]] = [[]] * n
        rows, ranks = np.arange(n), self.ranks_of(ids[:, :-1], ids[:, 1:])
        while True:
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)                    # the leftmost of equal ranks
                low = ranks[np.arange(len(rows)), at]
                done = low == NONE
            else:
                done = np.ones(len(rows), bool)
            for i, got in zip(rows[done].tolist(), ids[done].tolist()):
                out[i] = got
            go = ~done
            if not go.any():
                return out
            rows, ids, ranks, at, low = rows[go], ids[go], ranks[go], at[go], low[go]
            line = np.arange(len(rows))
            ids[line, at] = self.made[low]
            keep = np.ones(ids.shape, bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            has = at < ranks.shape[1]                        # the pair that starts with the merged token
            ranks[line[has], at[has]] = self.ranks_of(ids[line[has], at[has]], ids[line[has], at[has] + 1])
            has = at > 0
            ranks[line[has], at[has] - 1] = self.ranks_of(ids[line[has], at[has] - 1], ids[line[has], at[has]])

    def propose(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest vocabulary token first, for all pieces at once by walks down a prefix tree.

        ``raw`` holds the pieces' bytes one after the other, ``ends`` where each ends.
        Returns the tokens in order and the piece that each belongs to.
        """
        starts = np.concatenate([[0], ends[:-1]])
        piece = np.arange(len(ends))
        begin, at, node = starts.copy(), starts.copy(), np.zeros(len(ends), np.int64)
        best, stop = np.full(len(ends), -1), starts.copy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while piece.size:
            open_ = at < ends[piece]
            key = (node << 8) | raw[np.minimum(at, len(raw) - 1)]
            k = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            step = open_ & (self.edges[k] == key)
            node = np.where(step, self.targets[k], node)
            at = at + step
            token = np.where(at == ends[piece], self.final_at[node], self.inner_at[node])
            hit = step & (token >= 0)
            best, stop = np.where(hit, token, best), np.where(hit, at, stop)
            over = ~step
            if over.any():
                found.append((begin[over], best[over], piece[over]))
                begin, at, node = np.where(over, stop, begin), np.where(over, stop, at), np.where(over, 0, node)
                live = ~(over & (stop == ends[piece]))
                if not live.all():
                    piece, begin, at, node, best, stop = (x[live] for x in (piece, begin, at, node, best, stop))
        where, tokens, owner = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(where, kind="stable")
        return tokens[order], owner[order]

    def grow_tree(self) -> None:
        """The prefix tree of the reachable tokens as sorted arrays of edges."""
        nodes: dict[bytes, int] = {b"": 0}
        for raw in [*self.inner, *self.final]:
            for n in range(1, len(raw) + 1):
                nodes.setdefault(raw[:n], len(nodes))
        edges = sorted(((nodes[raw[:-1]] << 8) | raw[-1], i) for raw, i in nodes.items() if raw)
        self.edges, self.targets = (np.array(x, np.int64) for x in zip(*edges))
        self.inner_at, self.final_at = np.full(len(nodes), -1), np.full(len(nodes), -1)
        for raw, t in self.inner.items():
            self.inner_at[nodes[raw]] = t
        for raw, t in self.final.items():
            self.final_at[nodes[raw]] = t

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For arrays of neighbours: would BPE leave each boundary uncrossed?

        ``u`` and ``v`` are the parts that touch the boundary, ``cu`` and ``cv`` the
        ranks of the merges that use them up.  A merge of ``u`` and ``v`` happens
        when it ranks before both; on a tie the leftmost occurrence goes first,
        which is the one inside ``x`` on the left and this one on the right.
        """
        u, v = x.astype(np.int64), y.astype(np.int64)
        cu, cv = np.full(len(u), NONE), np.full(len(u), NONE)
        good = np.ones(len(u), bool)
        live = np.arange(len(u))
        while live.size:
            r = self.ranks_of(u[live], v[live])
            crossed = (r < cu[live]) & (r <= cv[live])
            good[live[crossed]] = False
            live = live[~crossed]
            fu, fv = self.form[u[live]], self.form[v[live]]
            more = (fu >= 0) | (fv >= 0)
            live, fu, fv = live[more], fu[more], fv[more]
            later = fu > fv
            a, b = live[later], live[~later]
            cu[a], u[a] = fu[later], self.right[u[a]]
            cv[b], v[b] = fv[~later], self.left[v[b]]
        return good

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        if not pieces:
            return []
        raws = [p.encode() for p in pieces]
        ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)))
        flat, owner = self.propose(np.frombuffer(b"".join(raws), np.uint8), ends)
        inside = owner[1:] == owner[:-1]
        if self.ordered:
            pair = (flat[:-1][inside] << 20) | flat[1:][inside]
            one, back = np.unique(pair, return_inverse=True)
            good = self.compatible(one >> 20, one & ((1 << 20) - 1))[back]
            wrong = np.unique(owner[1:][inside][~good])
        else:
            wrong = np.unique(owner[1:][inside])
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(raws)))]).tolist()
        joined = flat.astype("<u4").tobytes()
        out = [joined[4 * i:4 * j] for i, j in zip(cuts[:-1], cuts[1:])]
        alike: dict[int, list[int]] = {}
        for i in wrong.tolist():
            alike.setdefault(len(raws[i]), []).append(i)
        for n, members in alike.items():
            if n <= SHORT:
                exact = self.merge_many([raws[i] for i in members])
            else:
                exact = [self.merge(raws[i]) for i in members]
            for i, ids in zip(members, exact):
                out[i] = self._bytes(ids)
        return out

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}I", *ids)

    def learn(self, new: set[str]) -> None:
        """Put the ids of new white-space words into the cache, and of the pieces that they are cut into."""
        words = self.words
        if len(words) + len(new) > MAX_WORDS:
            words.clear()
        cut = {w: ps for w in new if (ps := self.pieces(w)) != [w]}
        fresh = [w for w in new if w not in cut]
        fresh += {p for ps in cut.values() for p in ps if p not in words and p not in new} | (
            {p for ps in cut.values() for p in ps} & cut.keys())
        words.update(zip(fresh, self.encode_pieces(fresh)))
        for w, ps in cut.items():
            words[w] = words[ps[0]] if len(ps) == 1 else b"".join([words[p] for p in ps])

    def _split(self, text: str) -> list[str | int]:
        """Normalised white-space words; a special token's string gives its id, a number among the words."""
        if self.special_re is not None and "<|" in text and (found := list(self.special_re.finditer(text))):
            out, at = [], 0
            for m in found:
                out += self._split(text[at:m.start()])
                out.append(self.special[m[0]])
                at = m.end()
            return out + self._split(text[at:])
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):       # white space to Python, not to the tokenizer
            return regex.findall(r"\S+", text)
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each text."""
        split = [self._split(t) for t in texts]
        get = self.words.get
        ids = [list(map(get, ws)) for ws in split]
        gaps = [(ws, got, k) for ws, got in zip(split, ids) for k in _gaps(got)]
        if gaps:
            missing = {ws[k] for ws, _, k in gaps}
            numbers = [w for w in missing if isinstance(w, int)]
            self.learn(missing.difference(numbers))
            for w in numbers:
                self.words[w] = self._bytes([w])
            for ws, got, k in gaps:
                got[k] = self.words[ws[k]]
        return list(map(b"".join, ids))

    def decode(self, ids: bytes) -> str:
        """The tokens' names joined by spaces, as a tokenizer without a decoder gives them."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _gaps(got: list) -> list[int]:
    """Where ``got`` is None."""
    out, k = [], -1
    try:
        while True:
            k = got.index(None, k + 1)
            out.append(k)
    except ValueError:
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBPE:
    """The vocabulary at ``path``, read once in each Python worker."""
    return WordBPE(path)


def token_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  vocab_path: str | None = None) -> DataFrame:
    """Encode and decode every text; one row per input row, in one pass without a shuffle.

    Returns (doc_id, n_tokens, ids_sha256, decoded_sha256).  Null text is read as
    empty: no tokens, digests of the empty string.  Null ids are kept.  Repeated
    rows and equal ids give one row each.  Texts are taken whole, also very long
    ones; other columns are ignored.  An empty table gives an empty result.
    """
    path = vocab_path or default_vocabulary()

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                coded = bpe.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"),
                     pa.array([len(b) // 4 for b in coded], pa.int64()),
                     pa.array([sha256(b).hexdigest() for b in coded], pa.string()),
                     pa.array([sha256(bpe.decode(b).encode()).hexdigest() for b in coded], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def crc(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
