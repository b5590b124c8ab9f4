"""Command line: load the deliveries of one batch date."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tidemark.batches import parse_batch_date
from tidemark.plans import Roots, run_batch
from tidemark.specs import DATASETS
from tidemark.streaming import run_arrivals, run_flat_arrivals


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", exit_on_error=False)
    parser.add_argument("batch_date", help="yyyymmdd")
    come_from = parser.add_mutually_exclusive_group(required=True)
    come_from.add_argument("--deliveries", help="folder with <dataset>_<yyyymmdd>.csv")
    come_from.add_argument("--source", help="folder with a folder per dataset; new files are landed first")
    parser.add_argument("--flat", action="store_true", help="with --source: files of all datasets lie side by side")
    parser.add_argument("--landing", help="folder in which deliveries are kept as raw lines; --source needs it")
    parser.add_argument("--checkpoint", help="with --source: folder that remembers the landed files")
    parser.add_argument("--checked", required=True, help="folder for checked deliveries")
    parser.add_argument("--tables", required=True, help="folder of the stored tables")
    parser.add_argument("--dataset", action="append", choices=[d.name for d in DATASETS], help="default: all")
    parser.add_argument("--bad-rows", choices=["refuse", "null"], default="refuse")
    parser.add_argument("--broadcast-mb", type=int, help="largest list or bitmap of delivered keys to broadcast")
    parser.add_argument("--large-snapshot-mb", type=int, help="snapshots above are read twice to spare a shuffle")
    parser.add_argument("--repair", action="store_true", help="bring later batches of histories up to date")
    parser.add_argument("--catalog", help="database in which to register the tables")
    try:
        given = parser.parse_args(arguments)
        batch_date = parse_batch_date(given.batch_date)
        if given.source and not (given.landing and given.checkpoint):
            raise ValueError("--source needs --landing and --checkpoint")
    except (argparse.ArgumentError, SystemExit, ValueError) as error:
        if isinstance(error, SystemExit) and error.code in (0, None):
            return 0
        print(f"Error in the arguments: {error}", file=sys.stderr)
        return 1

    builder = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC")
    if given.catalog:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    datasets = [d for d in DATASETS if not given.dataset or d.name in given.dataset]
    sizes = {"broadcast_bytes": given.broadcast_mb, "large_snapshot": given.large_snapshot_mb}
    limits = {name: mb << 20 for name, mb in sizes.items() if mb is not None}
    options = {"bad_rows": given.bad_rows, "catalog": given.catalog, "limits": limits}
    if given.source:
        roots = Roots("", given.checked, given.tables, given.landing)
        arrive = run_flat_arrivals if given.flat else run_arrivals
        reports = arrive(spark, given.source, given.checkpoint, roots, datasets, batch_date, **options)
    else:
        roots = Roots(given.deliveries, given.checked, given.tables, given.landing)
        reports = run_batch(spark, batch_date, roots, datasets, **options, repair=given.repair)
    for report in reports:
        print(report)
    return 0 if all(report.ok for report in reports) else 2


if __name__ == "__main__":
    sys.exit(main())
