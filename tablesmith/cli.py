"""Command line: run the sync registry, or one table sync from an export folder.

    python -m tablesmith.cli jobs --registry sync_jobs [--pending] [--root DIR] [--workers 4]
    python -m tablesmith.cli sync --export DIR --mapping schema.csv --target TABLE [--root DIR] [--single-line]

The session comes from ``SparkSession.builder.getOrCreate()`` (so
``spark-submit`` settings apply); the store lives under ``--root`` or the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tablesmith")
    sub = ap.add_subparsers(dest="cmd", required=True)
    j = sub.add_parser("jobs", help="run due jobs of a registry table and write their status back")
    j.add_argument("--registry", required=True)
    j.add_argument("--pending", action="store_true", help="run PENDING jobs instead of re-syncing PASS ones")
    j.add_argument("--where", help="run the jobs matching this SQL condition, whatever their status")
    j.add_argument("--workers", type=int, default=4)
    j.add_argument("--retries", type=int, default=2)
    j.add_argument("--root")
    s = sub.add_parser("sync", help="full refresh of one table from an exported CSV folder")
    s.add_argument("--export", required=True)
    s.add_argument("--mapping", required=True, help="schema CSV: source_key, destination_key, data_type")
    s.add_argument("--target", required=True)
    s.add_argument("--root")
    s.add_argument("--single-line", action="store_true", help="no cell holds a line break: large files are split")
    for sub_parser in (j, s):
        sub_parser.add_argument("--input-gb", type=float, help="size of the input: shuffle and scan settings are derived from it")
    args = ap.parse_args(argv)

    from tablesmith.plans import jobs as jp
    from tablesmith.session import apply_settings, scale_settings
    from tablesmith.plans.sync import SyncSpec, sync_table
    from tablesmith.sinks.tables import TableStore
    from tablesmith.sources.files import csv_scan, mapping_scan

    spark = SparkSession.builder.appName("tablesmith").getOrCreate()
    if args.input_gb:
        apply_settings(spark, scale_settings(int(args.input_gb * 1e9)))
    store = TableStore(spark, args.root)
    if args.cmd == "jobs":
        res = jp.run_registry(spark, store, args.registry, pending=args.pending, where=args.where,
                              max_workers=args.workers, retries=args.retries)
        rows = [r.asDict() for r in res.collect()]  # one row per job
        print(json.dumps(rows, default=str))
        return 0 if all(r["status"] == "PASS" for r in rows) else 1
    mapping = [r.asDict() for r in mapping_scan(spark, args.mapping).orderBy("position").collect()]  # one per column
    res = sync_table(csv_scan(spark, args.export, multi_line=not args.single_line), SyncSpec(mapping, args.target), store)
    print(json.dumps(res.__dict__, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
