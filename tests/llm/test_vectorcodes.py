"""Operator 11: the tree against every entry, the whole query against plain Python, awkward vectors."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import vectorcodes as vc
from tillroll.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long"


def exact(q, e):
    return [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in e] for x in q]


def plain_nearest(q, e):
    d = exact(q, e)
    return [min(range(len(e)), key=lambda j: (r[j], j)) for r in d], [min(r) for r in d]


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 90), st.sampled_from([1, 3, 100, 2 ** 27]), st.integers(1, 5), st.integers(1, 6))
def test_tree_finds_the_lowest_nearest_entry(seed, n, reach, d, leaf):
    rnd = np.random.default_rng(seed)
    entries = rnd.integers(-reach, reach + 1, (n, d))
    q = np.concatenate([rnd.integers(-reach, reach + 1, (40, d)), entries[: 10]])
    tree = vc.Gnat(entries, fanout=4, leaf=leaf)
    entry, best, _ = vc.nearest(tree, q)
    wanted = plain_nearest(q.tolist(), entries.tolist())
    assert (entry.tolist(), best.tolist()) == wanted


def test_subtrees_are_eliminated_and_ranges_hold():
    rnd = np.random.default_rng(1)
    middles = rnd.integers(-5000, 5000, (16, 8))
    entries = (middles[np.arange(256) % 16] + rnd.integers(-60, 60, (256, 8)))
    q = middles[rnd.integers(0, 16, 1000)] + rnd.integers(-60, 60, (1000, 8))
    tree = vc.Gnat(entries)
    entry, best, work = vc.nearest(tree, q)
    d = vc.squared(q, entries)
    assert (best == d.min(axis=1)).all() and (entry == d.argmin(axis=1)).all()
    assert work < 1000 * 256 / 4
    held = Counter(tree.splits.tolist())
    for child, least, most in zip(tree.children, tree.least, tree.most):
        held.update(child.at.tolist())
        real = np.sqrt(vc.squared(entries[child.at], entries[tree.splits]))
        assert (least <= real.min(axis=0)).all() and (most >= real.max(axis=0)).all()
    assert held == Counter(range(256))


def test_equal_entries_and_ties():
    entries = np.array([[5, 5]] * 40 + [[0, 0]] * 40 + [[0, 2]])
    entry, best, _ = vc.nearest(vc.Gnat(entries, leaf=2), np.array([[5, 5], [0, 0], [0, 1], [9, 9], [0, 3]]))
    assert entry.tolist() == [0, 40, 40, 0, 80] and best.tolist() == [0, 0, 1, 32, 1]


def test_squared_distances_are_exact_at_any_size():
    rnd = np.random.default_rng(2)
    for reach in (10, 2 ** 20, 2 ** 26):
        q, e = rnd.integers(-reach, reach, (7, 16)), rnd.integers(-reach, reach, (5, 16))
        assert vc.squared(q, e).tolist() == exact(q, e)


def plain(rows, parts=4, entries=256, rounds=4):
    """Rows of (vec_id, embedding, label) coded in plain Python."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    d = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * d:(p + 1) * d]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    for r in range(rounds + 1):
        found = [plain_nearest([cut(v, p) for _, v, _ in kept], books[p]) for p in range(parts)]
        if r == rounds:
            break
        for p in range(parts):
            groups = defaultdict(list)
            for (_, v, _), e in zip(kept, found[p][0]):
                groups[e].append(cut(v, p))
            for e, g in groups.items():
                books[p][e] = [sum(x) // len(g) for x in zip(*g)]
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(found[p][1][i] for p in range(parts)) for i in range(len(kept))]
    by_label = Counter()
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    return [(i, "".join(f"{found[p][0][k]:02x}" for p in range(parts)), errors[k], by_label[label], digest)
            for k, (i, _, label) in enumerate(kept)]


def same(got, wanted):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(wanted, key=key)


def test_small_tables_against_plain_python(spark):
    rnd = np.random.default_rng(4)
    # few distinct values, so that entries and distances tie; more rows than entries
    rows = [(int(i), [float(x) for x in rnd.integers(-2, 3, 8) / 1024], int(rnd.integers(0, 3))) for i in rnd.permutation(400)]
    got = vc.compress(spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    same(got.collect(), plain(rows))
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(size=16)], None if i % 3 else i % 2) for i in range(300)]
    same(vc.compress(spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA).repartition(5)).collect(), plain(rows))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], None), (5, [-inf, 0.0, 0.0, 0.0], 2),
            (6, [0.5, -0.25, 0.0, 1e-9], None), (6, [0.5, -0.25, 0.0, 1e-9], None), (6, [0.5, -0.25, 0.0, -1e-9], 3),
            (None, [0.0, -0.0, 1.0, 2.0], None), (None, None, None), (-9, [-1000.0, 1000.0, 3.0, -3.0], 3)]
    wanted = plain(rows)
    odd = [(7, [], 1), (8, [1.0, 2.0, 3.0], 1), (9, [1.0] * 8, 1), (10, [3e38, 0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows + odd], SCHEMA)
    same(vc.compress(df).collect(), wanted)
    none = spark.createDataFrame([], SCHEMA)
    assert vc.compress(none).collect() == [] and vc.compress(df.where("vec_id < 6 AND vec_id > 0")).collect() == []
    named = vc.compress(none.selectExpr("CAST(vec_id AS string) AS name", "embedding", "CAST(label AS string) AS kind"), "name", label_col="kind")
    assert named.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_whole_table_decodes_near_the_input(spark, sf):
    vectors = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows, width = vc.whole_numbers(vectors, "vec_id", "embedding", "label")
    books = vc.fit(rows, width)
    coded = vc.encode(rows, books, width)
    decoded = {r.vec_id: np.array(r.decoded) for r in vc.decode(coded, books).collect()}
    given_ = {r.vec_id: np.array(r.embedding) for r in vectors.collect()}
    errors = {r.vec_id: r.error for r in coded.collect()}
    assert set(decoded) == set(given_)
    for i, x in given_.items():
        whole = np.floor(x.astype(np.float64) * 1024)
        assert int(((decoded[i] * 1024 - whole) ** 2).sum()) == errors[i]
    # each round moves the entries nearer to the vectors: less error than with the first entries
    start = vc.encode(rows, vc.fit(rows, width, rounds=0), width).agg({"error": "sum"}).first()[0]
    assert sum(errors.values()) < start
