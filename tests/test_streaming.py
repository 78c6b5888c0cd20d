import datetime as dt
import shutil

from helpers import raw_rows

from tillroll.sources import raw as RW
from tillroll.streaming import ingest_extracts


def test_incremental_ingest(spark, tmp_path):
    landing, lines, ckpt = (str(tmp_path / p) for p in ("landing", "lines", "ckpt"))
    first = RW.route_sources(raw_rows(spark, [dict(invoice="1"), dict(invoice="C2", quantity=-1),
                                               dict(invoice="3", price=0.0)]).drop("source_rank"),
                             "2011-01-01")
    RW.write_sources(first, landing)
    ingest_extracts(spark, landing, lines, ckpt)
    got = spark.read.parquet(lines)
    assert got.count() == 3
    assert {r.status for r in got.collect()} == {"clean", "dropped_price"}

    second = RW.route_sources(raw_rows(spark, [dict(invoice="4", country="Japan",
                                                    invoice_date=dt.datetime(2011, 2, 1))]).drop("source_rank"),
                              "2011-01-01")
    RW.write_sources(second, str(tmp_path / "batch2"))
    # land the new files next to the already processed ones
    for src in (tmp_path / "batch2").glob("source=*/*.csv"):
        dest = tmp_path / "landing" / src.parent.name
        dest.mkdir(exist_ok=True)
        shutil.copy(src, dest / ("b2-" + src.name))
    ingest_extracts(spark, landing, lines, ckpt)
    rows = spark.read.parquet(lines).collect()
    assert len(rows) == 4
    assert [r.source_rank for r in rows if r.invoice == "4"] == [5]
