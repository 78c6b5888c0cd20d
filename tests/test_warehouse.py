"""Freshness and repeatability of the materialised star."""

from __future__ import annotations

import os
import shutil

import pytest
from helpers import SF001
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.operators.business import kpi_totals
from tillroll.plans.warehouse import _key_dir, open_star, prune_builds
from tillroll.session import checkpoint_base


def test_rewriting_a_part_file_is_seen(spark, tmp_path):
    sf = tmp_path / "sf"
    for t in ("orders", "part", "customer", "nation"):
        os.makedirs(sf, exist_ok=True)
        shutil.copy(f"{SF001}/{t}.parquet", sf / f"{t}.parquet")
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    lines.where("l_orderkey % 40 = 0").coalesce(1).write.parquet(str(sf / "lineitem.parquet"))
    first = kpi_totals(open_star(spark, str(sf)).fact).first()
    key = _key_dir(spark, str(sf))
    lines.where("l_orderkey % 40 = 1").coalesce(1).write.parquet(str(tmp_path / "other"))
    part = next((sf / "lineitem.parquet").glob("part-*"))
    shutil.copy(next((tmp_path / "other").glob("part-*")), part)
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    assert _key_dir(spark, str(sf)) != key
    spark.catalog.refreshByPath(str(sf / "lineitem.parquet"))
    assert kpi_totals(open_star(spark, str(sf)).fact).first() != first


def test_loading_twice_leaves_both_readable(spark):
    one, two = (E.queries()["sink_star"](spark, SF001) for _ in range(2))
    assert one.count() == two.count() > 0


def test_superseded_builds_are_pruned(spark):
    old = open_star(spark, SF001).base
    new = open_star(spark, SF001, rebuild=True).base
    assert old != new
    assert old not in [p.removeprefix("file:") for p in prune_builds(spark, 1)]          # too young
    gone = [p.removeprefix("file:") for p in prune_builds(spark, -1)]
    assert old.removeprefix("file:") in gone and new.removeprefix("file:") not in gone
    assert open_star(spark, SF001).fact.agg(F.count("*")).first()[0] > 0


def test_clusters_need_a_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_base(Session())
