"""Jobs for spark-submit, started through run_job.py.

    spark-submit run_job.py load  --warehouse W --landing L --year 2023 --months 1-6
    spark-submit run_job.py ingest --warehouse W --landing L --checkpoint C
    spark-submit run_job.py reference --warehouse W --airports A.json --airlines B.json
    spark-submit run_job.py train --output M --max-rows-per-file 100000 FILE...
    spark-submit run_job.py train --output M --landing L --year 2023
    spark-submit run_job.py score --model M --input FLIGHTS --output SCORED
"""

import argparse

from tarmac.functions.periods import month_list, monthly_paths
from tarmac.operators import clean, model
from tarmac.plans import load, training
from tarmac.plans.warehouse import Warehouse
from tarmac.session import keep_methods_compiled
from tarmac.sources.raw import (
    read_airline_reference, read_airport_reference, read_flight_files,
)
from tarmac.streaming.ingest import ingest_stream


def arguments(argv=None):
    parser = argparse.ArgumentParser(prog="tarmac")
    commands = parser.add_subparsers(dest="command", required=True)

    one = commands.add_parser("load", help="clean, check and load months of one year")
    one.add_argument("--warehouse", required=True)
    one.add_argument("--landing", required=True)
    one.add_argument("--year", type=int, required=True)
    one.add_argument("--month", type=int)
    one.add_argument("--months", help="1-12 or 1,3,6")
    one.add_argument("--all-months", action="store_true")
    one.add_argument("--overwrite", action="store_true")
    one.add_argument("--skip-quality", action="store_true")
    one.add_argument("--no-fail-on-quality", action="store_true")
    one.add_argument("--run-type", default="manual", choices=["manual", "scheduled", "backfill"])

    one.add_argument("--date-format", action="append", help="of flight dates, such as M/d/yyyy; may be repeated")

    stream = commands.add_parser("ingest", help="load files that arrived since the last call")
    stream.add_argument("--warehouse", required=True)
    stream.add_argument("--landing", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--no-fail-on-quality", action="store_true")
    stream.add_argument("--date-format", action="append", help="as for load")

    names = commands.add_parser("reference", help="store names out of reference documents")
    names.add_argument("--warehouse", required=True)
    names.add_argument("--airports", help="JSON documents of airports")
    names.add_argument("--airlines", help="JSON documents of airlines")

    fit = commands.add_parser("train", help="train the delay classifier")
    fit.add_argument("files", nargs="*")
    fit.add_argument("--landing", help="folder of the monthly files of --year")
    fit.add_argument("--year", type=int)
    fit.add_argument("--month", type=int, help="one month of --year; all of them without")
    fit.add_argument("--output", required=True)
    fit.add_argument("--max-rows-per-file", type=int)
    fit.add_argument("--test-size", type=float, default=0.2)
    fit.add_argument("--random-state", type=int, default=42)
    fit.add_argument("--trees", type=int, default=120)
    fit.add_argument("--min-leaf", type=int, default=20)
    fit.add_argument("--depth", type=int, default=12, help="of the trees; Spark's end is 30")

    rate = commands.add_parser("score", help="score flights, rejecting unusable rows")
    rate.add_argument("--model", required=True)
    rate.add_argument("--input", required=True, help="Parquet with the feature columns")
    rate.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    if args.command == "train" and not (args.files or (args.landing and args.year)):
        fit.error("name files, or --landing and --year")
    return args


def run(spark, args):
    keep_methods_compiled(spark)
    if args.command == "load":
        warehouse = Warehouse(spark, args.warehouse)
        load.ensure_calendar(warehouse)
        return [
            load.run_month(
                warehouse,
                read_flight_files(spark, path),
                args.year,
                month,
                source_file=path,
                skip_quality=args.skip_quality,
                overwrite=args.overwrite,
                fail_on_quality=not args.no_fail_on_quality,
                run_type=args.run_type,
                date_formats=tuple(args.date_format or clean.DATE_FORMATS),
            )
            for month in month_list(args.month, args.months, args.all_months)
            for path in [monthly_paths(args.landing, args.year, month)]
        ]
    if args.command == "ingest":
        return ingest_stream(Warehouse(spark, args.warehouse), args.landing, args.checkpoint,
                             fail_on_quality=not args.no_fail_on_quality,
                             date_formats=tuple(args.date_format or clean.DATE_FORMATS))
    if args.command == "reference":
        return load.enrich_dimensions(
            Warehouse(spark, args.warehouse),
            args.airports and read_airport_reference(spark, args.airports),
            args.airlines and read_airline_reference(spark, args.airlines))
    if args.command == "train":
        files = list(args.files)
        if args.year:
            files.append(monthly_paths(args.landing, args.year, args.month))
        return training.train_classifier(
            spark, files, args.output, args.max_rows_per_file, args.test_size,
            args.random_state, trees=args.trees, min_leaf=args.min_leaf, depth=args.depth)
    checked = model.input_problems(spark.read.parquet(args.input))
    good = checked.filter("problems = ''").drop("problems")
    model.score(model.load(args.model), good).write.parquet(f"{args.output}/scored")
    checked.filter("problems <> ''").write.parquet(f"{args.output}/rejected")

