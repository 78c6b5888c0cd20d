"""Operators 8 and 10 against the tokenizers library and brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from corpus import AWKWARD, awkward, empty, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import bpe, packing
from tillroll.llm.common import table

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.default_vocabulary()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


@pytest.fixture(scope="module")
def own():
    return bpe.vocabulary(PATH)


def ids_of(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


def test_tokens_have_one_merge_later_than_their_parts(own):
    assert own.ordered


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "th", "ing", " ", "\n", "'s", "'LL", "É", "ß", "İ", "Σ", "ñ", "1", "²", "中", "😀", "\x1c", "\x85", "́", "_", "#", "\0", "\0\0", "<|endoftext|>", "<|ENDOFTEXT|>", "ﬁ", "K"]),
    max_size=30).map("".join))
def test_odd_texts_as_the_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    (got,) = bpe.vocabulary(PATH).encode([text])
    assert ids_of(got) == want
    assert bpe.vocabulary(PATH).decode(got) == LIBRARY.decode(want, skip_special_tokens=False)


def test_a_plain_text_is_never_read_as_a_special_token():
    own = bpe.vocabulary(PATH)
    for text in ("\0\0<|ENDOFTEXT|>", "\0\0<|endoftext|>", "<|endoftext|>x<|EndOfText|>", "49407 <|endoftext|>"):
        for _ in range(2):                        # also once the words are cached
            want = LIBRARY.encode(text, add_special_tokens=False).ids
            assert ids_of(own.encode([text])[0]) == want


def test_pair_check_agrees_with_exact_merging(own, library):
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randint(1, 14))) for _ in range(4000)]
    for word, got in zip(words, own.encode_pieces(words)):
        assert ids_of(got) == own.merge(word.encode())


def test_long_pieces_and_a_refilled_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 50)
    own = bpe.WordBPE(PATH)
    for text in ("ab" * 5000, prose(3, 400), "q" * 3000 + " " + prose(4, 300)):
        assert ids_of(own.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_digests_of_awkward_rows(spark, library):
    got = sorted(map(tuple, bpe.token_digests(awkward(spark)).collect()), key=str)
    want = []
    for doc, text, *_ in AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(said.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.token_digests(empty(spark)).count() == 0


def test_best_fit_takes_the_tightest_window():
    rnd = random.Random(2)
    for _ in range(30):
        cap = rnd.choice([7, 64, 100])
        lengths = [rnd.randint(1, cap) for _ in range(rnd.randint(0, 80))]
        open_: list[list[int]] = []
        for n in sorted(lengths, reverse=True):
            fits = [w for w in open_ if sum(w) + n <= cap]
            if fits:
                max(fits, key=sum).append(n)
            else:
                open_.append([n])
        got = packing.best_fit_decreasing(lengths, cap)
        assert sorted(i for w in got for i in w) == list(range(len(lengths)))
        assert sorted(sum(lengths[i] for i in w) for w in got) == sorted(map(sum, open_))


def check_pieces(rows, texts, library, cap):
    """Every id in one piece, sequences without gaps, and the padding left."""
    ids = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sum(r.length for r in rows) == sum(map(len, ids))
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= cap
    return by_doc, ids, [sum(p.length for p in s) for s in by_sequence.values()]


def test_packing_whole_table(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs).collect()
    by_doc, _, filled = check_pieces(rows, texts.values(), library, 4096)
    for doc, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    padding = sum(4096 - n for n in filled if n & (n - 1))
    assert padding < 0.01 * sum(filled)


def test_packing_awkward_rows(spark, library):
    rows = packing.pack(awkward(spark), capacity=64).collect()
    check_pieces(rows, [r[1] for r in AWKWARD], library, 64)
    assert packing.pack(empty(spark)).count() == 0
