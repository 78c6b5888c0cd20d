"""Published loads, keyed dimension merges, the Bloom filter, and states of several loads against one build."""

import datetime as dt
import os
import random

import pytest
from helpers import SF001, line, raw_rows, star_from_raw
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions import bloom
from tillroll.operators import clean as C
from tillroll.operators import dims as D
from tillroll.operators import aggregates as A
from tillroll.operators import timeintel as TI
from tillroll.operators.measures import approx_customers, evaluate
from tillroll.plans import published as P
from tillroll.plans.app import open_warehouse, rejected, run_load
from tillroll.plans.warehouse import open_extracts, open_star

COUNTRIES = ("United Kingdom", "France", "EIRE", "Japan", "USA")


def lines_of(spark, rows):
    return C.clean_lines(raw_rows(spark, rows))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def business(star):
    """The fact without surrogates, and the dimensions."""
    fact = star.fact.join(star.dim_branches.select("branch_id", "country"), "branch_id")
    return [rows(fact.select("country", "invoice_no", "customer_id", "product_code", "date_key", "quantity", "line_total", "is_return")),
            rows(star.dim_customers), rows(star.dim_products), rows(star.dim_date), rows(star.dim_branches.select("country", "region", "branch_name"))]


JAN, FEB, MAR = (2011, 1, 10, 9), (2011, 2, 10, 9), (2011, 3, 10, 9)


def test_a_load_that_dies_leaves_the_last_version_readable(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    P.load(spark, root, lines_of(spark, [line("1", JAN), line("2", FEB)]), "replace")
    before = business(P.open_published(spark, root))
    real, seen = P._Load.write_whole, []

    def dies(self, table, df, partition=None):
        if table == "dim_customers":
            raise OSError("the disk is gone")
        seen.append(table)
        real(self, table, df, partition)

    monkeypatch.setattr(P._Load, "write_whole", dies)
    with pytest.raises(OSError):
        P.load(spark, root, lines_of(spark, [line("9", JAN, quantity=7, country="France")]), "replace")
    monkeypatch.undo()
    assert "dim_branches" in seen and len(os.listdir(f"{root}/dim_branches")) == 2      # it died between two tables
    assert P.versions(spark, root) == [1] and business(P.open_published(spark, root)) == before
    assert P.load(spark, root, lines_of(spark, [line("9", JAN, quantity=7)]), "replace") == 2       # and can be repeated
    removed = P.expire(spark, root, keep=1, older_than_days=0.0)
    assert len(os.listdir(f"{root}/dim_branches")) == 1 and any("dim_branches" in p for p in removed)
    assert P.open_published(spark, root).fact.count() == 1


def test_a_month_is_replaced_alone_and_readers_keep_their_version(spark, tmp_path):
    root = str(tmp_path / "wh")
    P.load(spark, root, lines_of(spark, [line("1", JAN), line("2", FEB), line("3", FEB, stock_code="B"), line("4", MAR)]), "replace")
    pinned, one = P.open_published(spark, root), P.read_manifest(spark, root)
    P.load(spark, root, lines_of(spark, [line("5", FEB, quantity=9)]), "months")
    two = P.read_manifest(spark, root)
    for table in P.BY_MONTH:
        old, new = one.folders[table], two.folders[table]
        assert set(old) == set(new) == {"201101", "201102", "201103"}
        assert [m for m in old if old[m] != new[m]] == ["201102"]
        written = os.listdir(f"{root}/{table}/{new['201102'][0]}")
        assert [d for d in written if d.startswith("sales_month=")] == ["sales_month=201102"]
    now = P.open_published(spark, root)
    assert sorted(r.invoice_no for r in now.fact.collect()) == ["1", "4", "5"]
    assert sorted(r.product_code for r in now.dim_products.collect()) == ["A1"]             # B went with its month
    assert sorted(r.invoice_no for r in pinned.fact.collect()) == ["1", "2", "3", "4"]
    assert rows(P.open_published(spark, root, 1).fact) == rows(pinned.fact)
    with pytest.raises(ValueError):
        P.open_published(spark, root, 7)


def test_of_two_loads_from_one_version_the_second_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    P.load(spark, root, lines_of(spark, [line("1", JAN)]), "replace")
    real = P._publish

    def overtaken(sp, where, manifest):
        monkeypatch.setattr(P, "_publish", real)
        P.load(sp, where, lines_of(sp, [line("2", FEB)]), "append")
        real(sp, where, manifest)

    monkeypatch.setattr(P, "_publish", overtaken)
    with pytest.raises(P.Conflict):
        P.load(spark, root, lines_of(spark, [line("3", MAR)]), "append")
    assert P.versions(spark, root) == [1, 2] and sorted(r.invoice_no for r in P.open_published(spark, root).fact.collect()) == ["1", "2"]
    assert not [f for f in os.listdir(f"{root}/_manifests") if "draft" in f and f.endswith(".json")]


def test_branches_keep_their_numbers(spark, tmp_path):
    root = str(tmp_path / "wh")
    P.load(spark, root, lines_of(spark, [line("1", MAR, country="Japan"), line("2", MAR, country="France", source_rank=2)]), "replace")
    first = {r.country: r.branch_id for r in P.open_published(spark, root).dim_branches.collect()}
    P.load(spark, root, lines_of(spark, [line("3", JAN, country="EIRE"), line("4", JAN, country="Japan"), line("5", FEB, country="USA")]), "append")
    star = P.open_published(spark, root)
    now = {r.country: r.branch_id for r in star.dim_branches.collect()}
    assert first == {"Japan": 1, "France": 2} and now == {**first, "EIRE": 3, "USA": 4}
    names = dict((r.invoice_no, r.country) for r in star.fact.join(star.dim_branches, "branch_id").collect())
    assert names == {"1": "Japan", "2": "France", "3": "EIRE", "4": "Japan", "5": "USA"}


def _random_rows(rnd, n):
    return [line(f"{'C' if rnd.random() < 0.1 else ''}{rnd.randrange(30)}", (2011, rnd.randrange(1, 5), rnd.randrange(1, 28), rnd.randrange(24)),
                 stock_code=f"S{rnd.randrange(6)}", description=f"name {rnd.randrange(3)}", quantity=rnd.randrange(1, 9), price=float(rnd.randrange(0, 4)),
                 customer_id=rnd.choice([None, 1.0, 2.0, 3.0]), country=rnd.choice(COUNTRIES), source_rank=rnd.randrange(1, 4)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_any_loads_equal_one_build_over_the_lines_that_are_loaded(spark, tmp_path, seed):
    rnd = random.Random(seed)
    root, held = str(tmp_path / "wh"), []
    for step in range(3):
        batch = _random_rows(rnd, rnd.choice([0, 1, 25]) if step else 25)
        mode = "replace" if step == 0 else rnd.choice(["append", "months", "replace"])
        storable = {r["invoice_date"].month for r in batch if r["price"] > 0}
        held = batch if mode == "replace" else held + batch if mode == "append" else [r for r in held if r["invoice_date"].month not in storable] + batch
        P.load(spark, root, lines_of(spark, batch), mode)
    star, whole = P.open_published(spark, root), star_from_raw(spark, held)
    got, wanted = business(star), business(whole)
    assert got[:4] == wanted[:4]
    assert set(wanted[4]) <= set(got[4])                    # a branch stays when its last line is replaced
    assert rows(evaluate(star, ("net_sales", "total_transactions", "items_per_basket"), by=("country",))) == \
        rows(evaluate(whole, ("net_sales", "total_transactions", "items_per_basket"), by=("country",)))
    assert rows(TI.retention(star, by=("country",))) == rows(TI.retention(whole, by=("country",)))
    assert rows(approx_customers(star, by=("country",))) == rows(evaluate(whole, ("active_customers",), by=("country",)))
    version = P.compact(spark, root)
    if version is not None:
        after = P.open_published(spark, root)
        assert business(after) == got and all(len(f) == 1 for f in P.read_manifest(spark, root).folders["fact_sales"].values())
        assert rows(evaluate(after, ("net_sales",), by=("product_code",))) == rows(evaluate(star, ("net_sales",), by=("product_code",)))


def test_bitmaps_go_when_customer_numbers_are_sparse(spark, tmp_path):
    root = str(tmp_path / "wh")
    dense = [line(str(i), (2011, 1 + i % 3, 5, 9), customer_id=float(i % 5 + 1)) for i in range(30)]
    sparse = [line(str(100 + i), (2011, 2, 5, 9), customer_id=float(i * 40_000_000 + 7)) for i in range(40)]
    P.load(spark, root, lines_of(spark, dense), "replace")
    assert A.BITMAPS in P.open_published(spark, root).aggregates
    P.load(spark, root, lines_of(spark, sparse), "append")
    star = P.open_published(spark, root)
    assert A.BITMAPS not in star.aggregates and rows(TI.retention(star)) == rows(TI.retention(star_from_raw(spark, dense + sparse)))
    P.load(spark, root, lines_of(spark, dense), "months")
    assert A.BITMAPS not in P.open_published(spark, root).aggregates
    P.load(spark, root, lines_of(spark, dense), "replace")
    assert A.BITMAPS in P.open_published(spark, root).aggregates


def test_empty_loads(spark, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(FileNotFoundError):
        P.open_published(spark, root)
    with pytest.raises(ValueError):
        P.load(spark, root, lines_of(spark, [line("1")]), "upsert")
    P.load(spark, root, lines_of(spark, [line("1", price=0.0)]), "months")
    star = P.open_published(spark, root)
    assert star.fact.count() == 0 and star.dim_products.count() == 0 and star.dim_date.count() == 0 and star.lines.count() == 1
    P.load(spark, root, lines_of(spark, [line("1", JAN)]), "append")
    P.load(spark, root, lines_of(spark, [line("2", JAN, price=0.0)]), "months")         # no clean line: no month is touched
    assert P.open_published(spark, root).fact.count() == 1 and P.versions(spark, root) == [1, 2, 3]


def test_application_loads_extracts(spark, tmp_path):
    extracts, root = open_extracts(spark, SF001), str(tmp_path / "wh")
    star = run_load(spark, extracts, root)
    whole = open_star(spark, SF001)
    for t in ("dim_customers", "dim_products", "dim_branches", "dim_date"):
        assert rows(getattr(star, t)) == rows(getattr(whole, t))
    assert rows(evaluate(star, by=("country",))) == rows(evaluate(whole, by=("country",)))
    assert rejected(star).count() > 0 and not [d for d in os.listdir(root) if d.startswith("_stage")]
    run_load(spark, extracts, root)                                                      # repeating a load changes nothing
    again = open_warehouse(spark, root)
    assert P.versions(spark, root) == [1, 2] and rows(evaluate(again, by=("country",))) == rows(evaluate(whole, by=("country",)))
    assert open_warehouse(spark, root, 1).fact.count() == whole.fact.count()


# ------------------------------------------------------------------ merge and filter


def _dim(spark, pairs):
    return spark.createDataFrame(pairs, "code string, name string, n long")


def test_two_loads_keep_the_first_row(spark):
    stored = D.dedupe_dim(_dim(spark, [("a", "first", 1), ("a", "later", 2), ("b", "b", 1)]), "code", [F.col("n")])
    new = D.merge_dim(stored, _dim(spark, [("a", "other", 0), ("c", "late", 5), ("c", "early", 4), (None, "no key", 1)]), "code", [F.col("n")])
    assert rows(new) == [("c", "early", 4)]
    assert rows(D.merge_dim(stored.limit(0), _dim(spark, [("a", "x", 1)]), "code", [F.col("n")])) == [("a", "x", 1)]
    assert rows(D.merge_dim(stored, _dim(spark, []), "code", [F.col("n")])) == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 3)), max_size=40), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 3)), max_size=40))
def test_merge_against_a_dictionary(spark, stored, batch):
    order = [F.col("n"), F.col("name")]
    one = [(f"k{k}", f"old{n}", n) for k, n in stored]
    two = [(f"k{k}", f"new{n}", n) for k, n in batch]
    held = {}
    for k, name, n in sorted(one, key=lambda r: (r[2], r[1])) + sorted(two, key=lambda r: (r[2], r[1])):
        held.setdefault(k, (k, name, n))
    first = D.dedupe_dim(_dim(spark, one), "code", order)
    assert rows(first.unionByName(D.merge_dim(first, _dim(spark, two), "code", order))) == sorted(held.values())


def test_a_batch_beyond_the_bound_is_joined_plainly(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BLOCKS", 0)
    new = D.merge_dim(_dim(spark, [("a", "a", 1)]), _dim(spark, [("a", "x", 1), ("b", "y", 1)]), "code", [F.col("n")])
    assert rows(new) == [("b", "y", 1)] and bloom.blocks_for(1) is None


def test_bloom_filter_loses_no_key_and_lets_few_others_through(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("key "), F.col("id") * 3).alias("k"))
    blocks = bloom.blocks_for(20_000)
    table = bloom.build(keys, ["k"], blocks)
    sizes = table.agg(F.count("block"), F.max(F.length("bitmap"))).first()
    assert blocks == 8 and tuple(sizes) == (8, bloom.BLOCK // 8)
    assert bloom.may_hold(keys, ["k"], table, blocks).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("key "), F.col("id") * 3 + 1).alias("k"))
    assert bloom.may_hold(others, ["k"], table, blocks).count() < 20_000 * 0.02
    pairs = spark.range(50).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    one = bloom.build(pairs, ["a", "b"], 1)
    assert bloom.may_hold(pairs, ["a", "b"], one, 1).count() == 50 and bloom.may_hold(pairs.limit(0), ["a", "b"], one, 1).count() == 0
    assert bloom.may_hold(pairs, ["a", "b"], bloom.build(pairs.limit(0), ["a", "b"], 1), 1).count() == 0


def test_states_do_not_depend_on_the_cut_of_the_lines(spark):
    rnd = random.Random(11)
    clean = C.clean_only(lines_of(spark, [r | {"price": 1.0 + r["price"]} for r in _random_rows(rnd, 120)]))
    for state, of, whole in ((D.customer_state, D.customers_of, D.dim_customers), (D.product_state, D.products_of, D.dim_products)):
        for parts in (1, 3):
            cut = [state(clean.where(F.pmod(F.xxhash64("invoice", "quantity"), F.lit(parts)) == i)) for i in range(parts)]
            union = cut[0]
            for c in cut[1:]:
                union = union.unionByName(c)
            assert rows(of(union)) == rows(whole(clean))
    assert rows(D.branches_of(D.branch_state(clean))) == rows(D.dim_branches(clean))
    assert rows(D.calendar_of(D.branch_state(clean))) == rows(D.dim_date(clean))
    assert isinstance(D.calendar_of(D.branch_state(clean)).first().date, dt.date)
