"""Command line: ``python -m tillroll <command> …``.

  split     --raw PATH --extracts DIR --uk-cutoff DATE   split raw CSV data into six regional extracts
  etl       --extracts DIR --warehouse DIR       load six regional CSV extracts into a star
  load      --extracts DIR --warehouse DIR [--mode replace|months|append]   one published load
  sql       --warehouse DIR --query TEXT         run Spark SQL over the star's views
  forecast  --warehouse DIR --out DIR [--fmt csv|parquet] [--method search|grid]
"""

from __future__ import annotations

import argparse

from .plans.app import open_warehouse, register_views, rejected, run_etl, run_forecast, run_load
from .session import get_session
from .sources.raw import split_extract


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tillroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("split")
    s.add_argument("--raw", required=True)
    s.add_argument("--extracts", required=True)
    s.add_argument("--uk-cutoff", required=True, help="first day of the second UK extract")
    s.add_argument("--multi-line", action="store_true", help="fields hold quoted line breaks")
    e = sub.add_parser("etl")
    e.add_argument("--extracts", required=True)
    e.add_argument("--warehouse", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--extracts", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--mode", default="months", choices=("replace", "months", "append"))
    q = sub.add_parser("sql")
    q.add_argument("--warehouse", required=True)
    q.add_argument("--query", required=True)
    q.add_argument("--rows", type=int, default=50)
    f = sub.add_parser("forecast")
    f.add_argument("--warehouse", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--fmt", default="csv", choices=("csv", "parquet"))
    f.add_argument("--method", default="search", choices=("search", "grid"))
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    if args.cmd == "split":
        split_extract(spark, args.raw, args.extracts, args.uk_cutoff, multi_line=args.multi_line)
    elif args.cmd == "etl":
        star = run_etl(spark, args.extracts, args.warehouse)
        print(f"star written to {star.base}")
        rejected(star).orderBy("source_rank", "reason").show(truncate=False)
    elif args.cmd == "load":
        star = run_load(spark, args.extracts, args.warehouse, args.mode)
        print(f"published in {star.base}")
        rejected(star).orderBy("source_rank", "reason").show(truncate=False)
    elif args.cmd == "sql":
        register_views(spark, open_warehouse(spark, args.warehouse))
        spark.sql(args.query).show(args.rows, truncate=False)
    else:
        print(run_forecast(open_warehouse(spark, args.warehouse), args.out, args.fmt, method=args.method))


if __name__ == "__main__":
    main()
