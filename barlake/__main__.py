"""Jobs for ``spark-submit``.

    spark-submit --py-files barlake.zip job.py run --landing ... --warehouse ...

where ``job.py`` is ``from barlake.__main__ import main; main()``; locally,
``python -m barlake run ...``. Master, storage and format settings belong to
``spark-submit``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

import barlake as b
from barlake.operators.quality import POLICIES
from barlake.plans.pipeline import MODES, STORE
from barlake.plans.compaction import SMALL_BYTES
from barlake.sources.files import path_exists
from barlake.sources.payloads import LAYOUTS


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="barlake")
    jobs = parser.add_subparsers(dest="job", required=True)

    ddl = jobs.add_parser("ddl", help="create both catalog tables anew; files stay")
    ddl.add_argument("--warehouse", required=True)
    ddl.add_argument("--database", default="barlake")
    ddl.add_argument("--format", default="parquet")

    run = jobs.add_parser("run", help="landed payloads to bronze to silver")
    stream = jobs.add_parser("stream", help="the same, for payload files not seen before")
    for job in (run, stream):
        job.add_argument("--landing", required=True)
        job.add_argument("--warehouse", required=True)
        job.add_argument("--layout", choices=LAYOUTS, default="files")
        job.add_argument("--on-fail", choices=POLICIES, default="report")
        job.add_argument("--store", choices=STORE, default="all", help="changed: only new bars")
        job.add_argument("--untimed", choices=("store", "reject"), default="store")
        job.add_argument("--format", default="parquet")
    run.add_argument("--date", help="roll up this day only (yyyy-MM-dd)")
    run.add_argument("--symbol", help="roll up this symbol only")
    run.add_argument("--recompute", choices=("all", "touched"), default="touched")
    run.add_argument("--mode", choices=MODES, default="replace")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--max-files", type=int, help="payload files per micro-batch")

    dedup = jobs.add_parser("dedup", help="rewrite bronze without repeated bars")
    dedup.add_argument("--warehouse", required=True)
    dedup.add_argument("--date", help="this day only (yyyy-MM-dd)")
    dedup.add_argument("--format", default="parquet")

    files = jobs.add_parser("compact", help="rewrite days that have many small files")
    files.add_argument("--warehouse", required=True)
    files.add_argument("--small", type=int, default=SMALL_BYTES, help="bytes")
    files.add_argument("--at-least", type=int, default=8, help="small files that a day must have")

    mend = jobs.add_parser("recover", help="complete interrupted replacements of days")
    mend.add_argument("--warehouse", required=True)

    for job in (run, stream, dedup, files, mend):
        job.add_argument("--database", help="catalog tables to tell about the days written")

    csv = jobs.add_parser("csv", help="landed payloads to CSV, values as they are")
    csv.add_argument("--landing", required=True)
    csv.add_argument("--layout", choices=LAYOUTS, default="files")
    csv.add_argument("--folder", required=True)
    return parser


def run_job(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "ddl":
        b.create_tables(spark, args.warehouse, args.database, args.format)
        b.create_silver_tables(spark, args.warehouse, args.database, args.format)
    elif args.job == "run":
        result = b.run_pipeline(
            spark,
            args.landing,
            args.warehouse,
            date=args.date,
            symbol=args.symbol,
            layout=args.layout,
            recompute=args.recompute,
            mode=args.mode,
            on_fail=args.on_fail,
            fmt=args.format,
            database=args.database,
            store=args.store,
            untimed=args.untimed,
        )
        print(f"batch {result.batch_id}: {result.rejected} payloads rejected")
        if result.diverted:
            print("the batch is in quarantine")
        for row in result.bronze_checks + result.silver_checks:
            outcome = "passed" if row.passed else "FAILED"
            print(f"{outcome}  {row.dataset}: {row.check} (value {row.value})")
    elif args.job == "stream":
        b.ingest_stream(
            spark,
            args.landing,
            args.warehouse,
            args.checkpoint,
            layout=args.layout,
            on_fail=args.on_fail,
            fmt=args.format,
            max_files_per_trigger=args.max_files,
            database=args.database,
            store=args.store,
            untimed=args.untimed,
        ).awaitTermination()
    elif args.job == "dedup":
        b.deduplicate_bronze(spark, args.warehouse, args.date, args.format, args.database)
    elif args.job == "compact":
        for table in (b.TRADE, b.DAILY_TRADES):
            if path_exists(spark, table.path(args.warehouse)):
                n = b.compact(
                    spark, table, args.warehouse, args.small, args.at_least, args.database
                )
                print(f"{n} days of {table.name} written anew")
    elif args.job == "recover":
        print(f"{b.recover(spark, args.warehouse, args.database)} replacements completed")
    else:
        raw = b.read_payloads(spark, args.landing, args.layout)
        print(b.export_bars_csv(raw, args.folder))


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"barlake-{args.job}").getOrCreate()
    run_job(spark, args)


if __name__ == "__main__":
    main()
