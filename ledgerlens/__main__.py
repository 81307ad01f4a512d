"""Run a named report.

    python -m ledgerlens list
    python -m ledgerlens run <report> --src <folder> [--out <folder> --format parquet|csv] [--rows 20]
    python -m ledgerlens explain <report> --src <folder>
    python -m ledgerlens materialise --src <folder> --out <facts folder> [--tasks-per-month N]

``--src`` is a folder with the source tables (``lineitem.parquet`` ...).
Without ``--out`` the first rows are printed. On a cluster, ship the package
with ``spark-submit --py-files`` and a driver script that calls
``ledgerlens.__main__.main([...])``, or call the report functions directly.
"""

from __future__ import annotations

import argparse
import sys

from .plans.registry import QUERIES


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    m = sub.add_parser("materialise")
    m.add_argument("--src", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--tasks-per-month", type=int, default=1)
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("report", choices=sorted(QUERIES))
        p.add_argument("--src", required=True)
        if name == "run":
            p.add_argument("--out")
            p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
            p.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name, fn in sorted(QUERIES.items()):
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:34s} {doc[0] if doc else ''}")
        return 0

    from pyspark.sql import SparkSession

    from .session import apply_semantics
    from .sources import star
    spark = SparkSession.builder.appName(f"ledgerlens-{getattr(args, 'report', args.cmd)}").getOrCreate()
    apply_semantics(spark)
    if args.cmd == "materialise":
        star.write_facts(spark, args.src, args.out, tasks_per_month=args.tasks_per_month)
        return 0
    df = QUERIES[args.report](spark, args.src)
    if args.cmd == "explain":
        df.explain("formatted")
    elif args.out:
        writer = df.write.mode("overwrite")
        (writer.option("header", "true").csv(args.out) if args.format == "csv" else writer.parquet(args.out))
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
