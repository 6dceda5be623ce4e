"""Run registered queries from the command line.

    python -m fleetlens list
    python -m fleetlens run QUERY --data DIR --out PATH [--format parquet|csv|json]

``run`` evaluates the query over the tables in ``DIR`` and writes the result
with Spark's DataFrameWriter (the result never passes through the driver).
The session comes from ``spark-submit`` when there is one; otherwise a local
session is started.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fleetlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="names of the registered queries")
    run = sub.add_parser("run", help="run one query and write its result")
    run.add_argument("query")
    run.add_argument("--data", required=True, help="folder with the <table>.parquet files")
    run.add_argument("--out", required=True, help="output path")
    run.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    run.add_argument("--mode", default="errorifexists",
                     choices=["errorifexists", "overwrite", "append", "ignore"])
    args = ap.parse_args(argv)

    from fleetlens.plans.catalog import QUERIES

    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    if args.query not in QUERIES:
        print(f"unknown query {args.query!r}; see `python -m fleetlens list`", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    from fleetlens.session import build_session

    spark = SparkSession.getActiveSession() or build_session()
    df = QUERIES[args.query](spark, args.data)
    writer = df.write.mode(args.mode).format(args.format)
    if args.format == "csv":
        writer = writer.option("header", "true")
    writer.save(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
