"""Operator 13: the curve, the two laws, awkward tables and the written files."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from corpus import AWKWARD, awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import hilbert
from tillroll.llm.common import table

SMALL = "/root/testdata/sf0.001"


def quadrant_curve(order: int) -> list[tuple[int, int]]:
    """The two-dimensional curve by its textbook recursion of four turned copies."""
    if order == 0:
        return [(0, 0)]
    half, n = quadrant_curve(order - 1), 1 << (order - 1)
    return ([(y, x) for x, y in half] + [(x, y + n) for x, y in half] + [(x + n, y + n) for x, y in half]
            + [(2 * n - 1 - y, n - 1 - x) for x, y in half])


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    n = 1 << bits
    cells = spark.range(n ** dims).select(*((F.floor(F.col("id") / n ** i) % n).cast("int").alias(f"c{i}") for i in range(dims)))
    got = sorted((r.curve, *r[:dims]) for r in hilbert.curve_index(cells, [f"c{i}" for i in range(dims)], bits).collect())
    assert [g[0] for g in got] == list(range(n ** dims))
    assert all(sum(abs(a - b) for a, b in zip(x[1:], y[1:])) == 1 for x, y in zip(got, got[1:]))
    if dims == 2:
        walk = [g[1:] for g in got]
        assert walk in (quadrant_curve(bits), [(y, x) for x, y in quadrant_curve(bits)])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 2 ** 62), min_size=2, max_size=30))
def test_number_slots_keep_the_order(spark, values):
    rows = spark.createDataFrame([(v,) for v in sorted(values)], "v long")
    slots = [r[0] for r in rows.select(hilbert.number_slot(F.col("v"))).collect()]
    assert slots == sorted(slots) and 0 <= slots[0] and slots[-1] <= hilbert.FINE


def test_string_slots_keep_the_order_behind_a_common_start(spark):
    values = ["https://a.org/x", "https://a.org/y", "https://b.org", "https://b.orgé", "https://z", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    slots = [r[0] for r in rows.select("i", hilbert.string_slots(rows, ["v"])["v"][1].alias("s")).orderBy("i").select("s").collect()]
    assert slots[-1] == 0 and slots[:-1] == sorted(slots[:-1]) and slots[0] == 1 and slots[2] < slots[4] < hilbert.FINE


def _whole(rows, shards, law):
    for s, group in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(group))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)          # runs of the curve
    assert all(r.law == law and r.grown_shard is None for r in rows)


def test_rows_law_on_the_whole_table(spark):
    docs = table(spark, SMALL, "documents")
    rows = hilbert.shard(docs).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(i, len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    _whole(rows, 16, "rows")


def test_bytes_law_cuts_where_a_share_of_the_bytes_is_passed(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = hilbert.shard(docs, shards=8, law="bytes").collect()
    _whole(rows, 8, "bytes")
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert all(abs(sizes[s] - total / 8) <= largest for s in range(8))


def test_one_source_of_a_third_of_the_rows_is_spread(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"))
    rows = hilbert.shard(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert max(Counter(r.shard for r in rows).values()) - min(Counter(r.shard for r in rows).values()) <= 1
    by_source = Counter()
    for s in {r.source for r in rows}:
        by_source[s] = len({r.shard for r in rows if r.source == s})
    assert by_source["hot"] <= 7 and sum(by_source.values()) <= len(by_source) + 16      # a source lies in few shards


def test_awkward_and_empty_tables(spark):
    rows = hilbert.shard(awkward(spark), shards=4).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r[0], len((r[1] or "").encode()) + 1) for r in AWKWARD)
    _whole(rows, 4, "rows")
    assert len(hilbert.shard(awkward(spark), shards=100).collect()) == len(AWKWARD)
    assert hilbert.shard(empty(spark)).collect() == []
    assert hilbert.shard(empty(spark), law="bytes").collect() == []
    lone = hilbert.shard(awkward(spark).where("doc_id = 8"), law="bytes").collect()
    assert [(r.slot, r.curve) for r in lone] == [(0, 0)]
    nulls = spark.createDataFrame([(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    assert sorted((r.shard, r.slot) for r in hilbert.shard(nulls, shards=3).collect()) == [(0, 0), (1, 0), (2, 0)]
    for bad in ({"dimensions": ("nothing",)}, {"dimensions": ()}, {"law": "key"}):
        with pytest.raises(ValueError):
            hilbert.shard(awkward(spark), **bad)


def test_other_dimensions_and_string_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", "x" * (i % 7), i * 1000, "t") for i in range(64)], "doc_id string, text string, day long, lang string")
    rows = hilbert.shard(docs, shards=4, dimensions=("day", "size")).collect()
    assert Counter(r.shard for r in rows) == {s: 16 for s in range(4)} and {r.doc_id for r in rows} == {f"d{i}" for i in range(64)}


def test_written_shards_hold_every_row_and_can_be_skipped(spark, tmp_path):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    path = str(tmp_path / "shards")
    hilbert.write_shards(docs, path, shards=16)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(docs).isEmpty() and docs.exceptAll(back.drop("shard")).isEmpty()
    found = {r.doc_id: r.shard for r in hilbert.shard(docs).collect()}
    assert {r.doc_id: r.shard for r in back.select("doc_id", "shard").collect()} == found
    langs = back.groupBy("lang").agg(F.countDistinct("shard").alias("n")).collect()
    assert sum(r.n for r in langs) < 16 * len(langs) / 1.5            # whereas dealt by hash every language is in every shard
    hilbert.write_shards(awkward(spark), str(tmp_path / "odd"), shards=3)
    assert spark.read.parquet(str(tmp_path / "odd")).count() == len(AWKWARD)
    hilbert.write_shards(empty(spark), str(tmp_path / "none"))
