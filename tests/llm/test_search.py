"""Operator 12 against a plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from corpus import AWKWARD, awkward, empty, prose

from tillroll.llm import search
from tillroll.llm.common import table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=20):
    """(item, rank, doc, score) with every document scored for every item."""
    held = [(i, Counter(plain_terms(t)), len(plain_terms(t))) for i, t in docs]
    n, total = sum(s > 0 for _, _, s in held), sum(s for _, _, s in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in held:
            m = 75 + 25 * size * n // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in plain_terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def found(spark, docs, items, k=20, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    index = search.build_index(d.repartition(3), block_docs=options.pop("block_docs", search.BLOCK_DOCS))
    return [tuple(r) for r in search.search(index, q, k, **options).collect()]


def same(got, wanted):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(wanted, key=key)


def test_terms_are_the_maximal_runs():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(chr(rnd.choice([rnd.randrange(128), rnd.randrange(256), rnd.randrange(0x3000), 0x1F600])) for _ in range(40))
        assert [t.decode() for t in search.terms_of(text)] == plain_terms(text)
    assert search.terms_of(None) == [] and search.terms_of(" \n!") == []
    assert [t.decode() for t in search.terms_of("İKK x\u0085Y Z")] == ["İkK x\u0085y", "z"]


def test_range_maxima_give_the_first_greatest_impact():
    rnd = np.random.default_rng(3)
    row = {"sizes": rnd.integers(1, 60, 50), "terms": ["a", "b", "c"], "dfs": [50, 7, 20],
           "docs": np.concatenate([np.arange(50), np.sort(rnd.choice(50, 7, False)), np.sort(rnd.choice(50, 20, False))]),
           "tfs": rnd.integers(1, 4, 77)}
    lists = search._Lists(row, {"a": 900, "c": 400}, 50, int(row["sizes"].sum()))
    assert lists.slot == {"a": 0, "c": 1} and len(lists.doc) == 71
    for low, high in ((0, 50), (50, 70)):
        for s in range(low, high + 1):
            for e in range(s, high + 1):
                at = int(lists.maxima(np.array([s]), np.array([e]))[0])
                assert at == (s + int(lists.impact[s:e].argmax()) if e > s else 70)


def test_interval_search_scores_few_documents_and_loses_none():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(rnd.choices(words, weights=[1 / (j + 1) for j in range(400)], k=rnd.randrange(5, 80)))) for i in range(2000)]
    import pyarrow as pa
    block = search._block([i for i, _ in docs], [t for _, t in docs], pa.int64())
    row = {c: block.column(c)[0].values.to_numpy() for c in ("sizes", "dfs", "docs", "tfs")} | {"terms": block.column("terms")[0].as_py()}
    df = dict(zip(row["terms"], row["dfs"].tolist()))
    total = int(row["sizes"].sum())
    weights = {t: math.floor(1000 * math.log((2 * 2000 + 2) / (2 * n + 1))) for t, n in df.items()}
    lists = search._Lists(row, weights, 2000, total)
    items = [(j, " ".join(rnd.choices(words, k=6))) for j in range(10)]
    got, scored = [], 0
    for j, text in items:
        kept = search._Kept(20)
        slots, times = np.array([(lists.slot[t], c) for t, c in Counter(text.split()).items() if t in lists.slot]).T
        scored += search.best_first(lists, slots, times, list(range(2000)), 2000, kept)
        got += [(j, r + 1, i, -s) for r, (s, _, i) in enumerate(kept.rows)]
    same(got, plain(docs, items))
    assert scored < 10 * 2000 / 2


def test_whole_table_against_plain_scoring(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    items = table(spark, "/root/testdata/sf0.001", "benchmark")
    got = search.search(search.build_index(docs, block_docs=37), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    same([tuple(r) for r in got.collect()],
         plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]))


def test_ties_copies_and_small_blocks(spark):
    rnd = random.Random(9)
    docs = [(i, "the same passage of the river") for i in rnd.sample(range(5000), 300)]
    docs += [(10_000 + i, prose(i, rnd.randrange(1, 30))) for i in range(200)] + [(7, "river"), (7, "river"), (7, "river")]
    items = [(1, "passage of the river"), (2, "RIVER river"), (3, "stone house"), (4, "nothing like that anywhere"), (5, None), (5, "élan x9")]
    wanted = plain(docs, items)
    for size in (1, 16, 4096):
        same(found(spark, docs, items, block_docs=size), wanted)
    same(found(spark, docs, items, k=3), plain(docs, items, 3))
    same(found(spark, docs, items, batch_bytes=1), wanted)


def test_the_index_stores_whole_blocks_in_small_groups(spark):
    texts = [(i, prose(i, 20) + " stone") for i in range(30)]
    index = search.build_index(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), block_docs=2)
    sizes = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles()]
    assert sum(m.num_rows for m in sizes) == 15
    assert max(m.row_group(g).num_rows for m in sizes for g in range(m.num_row_groups)) <= search.GROUP_ROWS     # what a reader holds at once
    assert [f.name for f in index.schema.fields if f.dataType.typeName() == "array"] == ["ids"]                  # no posting is an object to the JVM
    df = Counter(t for _, text in texts for t in set(plain_terms(text)))
    asked = sorted(df)[:5] + ["stone", "nowhere"]
    assert {r.term: r.df for r in search.frequencies(index, asked).collect()} == {t: df[t] for t in asked if t in df}


def test_awkward_and_empty_tables(spark):
    docs = [(r[0], r[1]) for r in AWKWARD]
    items = [(1, "same text the house"), (None, "élan straße"), (2, ""), (2, None), (3, "x" * 5000), (3, "中文 <|endoftext|>"), (3, "x" * 5000)]
    got = search.search(search.build_index(awkward(spark)), spark.createDataFrame(items, "item_id long, text string"))
    same([tuple(r) for r in got.collect()], plain(docs, items))
    for d, q in ((empty(spark), awkward(spark)), (awkward(spark), empty(spark))):
        assert search.search(search.build_index(d), q, item_col="doc_id").collect() == []
    names = spark.createDataFrame([("b", "river"), ("a", "river"), (None, "river"), ("c", "stone")], "doc_id string, text string")
    got = search.search(search.build_index(names), spark.createDataFrame([("q", "river")], "item_id string, text string")).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]
