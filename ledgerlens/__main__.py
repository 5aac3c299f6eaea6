"""Command line: build the star schema from a delivered file and write every report.

    spark-submit -m ledgerlens --csv s3://bucket/accounts.csv --out s3://bucket/reports
    python -m ledgerlens --landing /data/staging_parquet --out /data/reports --report risk_deciles

    spark-submit -m ledgerlens --csv s3://bucket/jan.csv --publish s3://bucket/star
    spark-submit -m ledgerlens --csv s3://bucket/feb.csv --append s3://bucket/star
    spark-submit -m ledgerlens --star s3://bucket/star --out s3://bucket/reports

Input is the source CSV (no id column, flag column ``default``; ids are assigned in
file order), a stored landing table in RAW_SCHEMA, or a stored star schema, which is
opened without rebuilding. ``--publish`` stores the input as the only batch of a star
schema, ``--append`` as one more (CSV accounts get the next ids). Each report is
written as Parquet under ``--out/<key>`` by the executors; ``--show`` also prints
reports of at most ``--show-rows`` rows. Intermediate tables go to a folder below the
shared ``spark.checkpoint.dir`` of the session, which is removed at the end.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import mart
from .plans.registry import REPORTS
from .plans.store import StarStore
from .session import scratch_run
from .sources import raw as rawio


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerlens")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="source CSV file or folder")
    src.add_argument("--landing", help="stored landing table (Parquet, RAW_SCHEMA)")
    src.add_argument("--star", help="stored star schema (a folder that --publish or --append wrote)")
    sink = ap.add_mutually_exclusive_group(required=True)
    sink.add_argument("--out", help="output folder; one Parquet table per report")
    sink.add_argument("--publish", metavar="ROOT", help="store the input as a star schema in this folder")
    sink.add_argument("--append", metavar="ROOT", help="add the input to the star schema in this folder")
    ap.add_argument("--report", action="append", help="report key (repeatable; default: all)")
    ap.add_argument("--lenient", action="store_true", help="NULL + audit instead of errors on bad values")
    ap.add_argument("--show", action="store_true", help="also print small reports")
    ap.add_argument("--show-rows", type=int, default=50)
    args = ap.parse_args(argv)

    keys = args.report or list(REPORTS)
    unknown = sorted(set(keys) - set(REPORTS))
    if unknown:
        raise SystemExit(f"unknown report(s): {', '.join(unknown)}; known: {', '.join(REPORTS)}")
    spark = SparkSession.builder.appName("ledgerlens").getOrCreate()
    if args.star and not args.out:
        raise SystemExit("--star is read for reports: give --out")
    with scratch_run(spark):
        run(spark, args, keys)


def run(spark: SparkSession, args: argparse.Namespace, keys: list[str]) -> None:
    root = args.publish or args.append
    if root:
        star = StarStore(spark, root)
        first = star.manifest()["next_id"] if args.append and star.versions() else 1
        staging = (rawio.read_raw_csv(spark, args.csv, lenient=args.lenient, first_id=first) if args.csv
                   else rawio.read_raw_parquet(spark, args.landing))
        version = (star.append if args.append else star.rebuild)(staging, lenient=args.lenient)
        print(f"{root}: version {version}")
        return
    if args.star:
        pf = mart.Portfolio.open(spark, args.star)
    else:
        staging = (rawio.read_raw_csv(spark, args.csv, lenient=args.lenient) if args.csv
                   else rawio.read_raw_parquet(spark, args.landing))
        pf = mart.build(staging, lenient=args.lenient)
    for key in keys:
        df = REPORTS[key](pf)
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{key}")
        if args.show:
            small = spark.read.parquet(f"{args.out.rstrip('/')}/{key}")
            if small.limit(args.show_rows + 1).count() <= args.show_rows:
                print(f"== {key}")
                small.show(args.show_rows, truncate=False)


if __name__ == "__main__":
    main()
