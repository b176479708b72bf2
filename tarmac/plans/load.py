"""Loading a cleaned month, with run and quality audit, and refreshing the summary tables."""

import logging
import secrets
import time
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import clean, dimensions, quality
from tarmac.plans import states, summaries
from tarmac.plans import warehouse as wh
from tarmac.session import forget, shuffles_removed, work_folder

log = logging.getLogger(__name__)

JOB_NAME = "flight_delay_load"


def now():
    return datetime.now(timezone.utc)


def new_run_id():
    """Ascending with time; runs that start in the same microsecond differ by their low bits."""
    return (time.time_ns() // 1000 << 12) + secrets.randbelow(1 << 12)


def run_key(run_id):
    """What a run's audit rows are stored by."""
    return f"run-{run_id}"


def audit_run(spark, run_id, year, month, status, started_at, run_type="manual", source_file=None,
              rows_extracted=0, rows_validated=0, rows_loaded=0, rows_rejected=0, error=None,
              notes=None, completed_at=None):
    """One row for the run table."""
    done = completed_at or now()
    seconds = Decimal(str(round((done - started_at).total_seconds(), 2)))
    return spark.createDataFrame([(
        run_id, JOB_NAME, run_type, year, month, source_file, status, rows_extracted,
        rows_validated, rows_loaded, rows_rejected, started_at, done, seconds, error, notes,
    )], schema.RUN)


def quality_rows(results, run_id, table="fact_flights", checked_at=None):
    """Check results as rows of the audit table."""
    at = F.lit(checked_at).cast("timestamp") if checked_at else F.current_timestamp()
    return results.select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        "check_name", "check_type",
        F.lit(table).alias("table_name"),
        "column_name", "rows_checked", "rows_failed",
        F.col("pass_rate").cast("decimal(6,4)").alias("pass_rate"),
        F.col("threshold").cast("decimal(6,4)").alias("threshold"),
        "passed",
        at.alias("checked_at"),
        "details",
    )


def count_rows(facts, year=None, month=None):
    """Rows, and how many of them lack a required value or lie outside the month."""
    unusable = F.lit(False)
    for c in schema.FACT_NOT_NULL:
        unusable = unusable | F.col(c).isNull()
    if year is not None:
        unusable = unusable | F.coalesce(
            (F.col("year") != year) | (F.col("month") != month), F.lit(True))
    return facts.agg(
        F.count("*").alias("n"), F.count_if(unusable).alias("unusable")).first()


def refuse_unusable(seen, period="any month"):
    if seen["unusable"]:
        raise ValueError(
            f"{seen['unusable']} rows lack a required value or lie outside {period}")


def upsert_dimensions(warehouse, flights):
    """Append the carriers and airports seen for the first time."""
    carriers = dimensions.new_carrier_rows(flights, warehouse.carriers())
    warehouse.append(carriers, "dim_carriers")
    airports = dimensions.new_airport_rows(flights, warehouse.airports())
    warehouse.append(airports, "dim_airports")


def load_month(warehouse, flights, source_file, year, month, overwrite=False, run_type="manual",
               rows_extracted=None, run_id=None):
    """Load a cleaned month unless it is there already; `overwrite` replaces it.

    `flights` is read several times, so hand in a stored table. Writes a run row in every case.
    """
    spark = warehouse.spark
    started = now()
    run = {"run_id": run_id or new_run_id(), "year": year, "month": month, "run_type": run_type,
           "source_file": source_file, "started_at": started}
    existing = wh.rows_of_month(warehouse.facts(), year, month).first()["existing_rows"]
    if existing and not overwrite:
        warehouse.record(audit_run(spark, status="skipped", **run), "pipeline_runs", run_key(run["run_id"]))
        return {"skipped": True, "existing_rows": existing}
    counts = {"rows_extracted": rows_extracted or 0}
    try:
        facts = flights.transform(wh.to_facts)
        seen = count_rows(facts, year, month)
        extracted = seen["n"] if rows_extracted is None else rows_extracted
        counts = {"rows_extracted": extracted, "rows_validated": seen["n"],
                  "rows_rejected": extracted - seen["n"]}
        refuse_unusable(seen, f"{year}-{month:02d}")
        upsert_dimensions(warehouse, facts)
        keyed = wh.loadable_facts(facts, warehouse.carriers(), warehouse.airports())
        warehouse.publish(warehouse.written_months(keyed, year, month))
        stored = wh.rows_of_month(warehouse.facts(), year, month).first()["existing_rows"]
        counts["rows_loaded"] = stored
    except Exception as error:
        failed = audit_run(spark, status="failed", error=str(error), **run, **counts)
        warehouse.record(failed, "pipeline_runs", run_key(run["run_id"]))
        raise
    warehouse.record(audit_run(spark, status="success", **run, **counts), "pipeline_runs", run_key(run["run_id"]))
    return {"status": "success", "run_id": run["run_id"], "year": year, "month": month,
            "source_file": source_file, **counts}


SUMMARIES = {
    "mv_carrier_performance":
        lambda w, state, least: summaries.carriers_served(state["state_routes"], w.carriers()),
    "mv_route_analysis": lambda w, state, least: summaries.routes_flown(
        state["state_routes"], state["state_delays"], w.airports(), least),
    "mv_monthly_summary":
        lambda w, state, least: summaries.months_flown(state["state_days"], w.read("dim_date")),
}
SKETCHED = {"mv_sketches": lambda w, state, least: summaries.sketched(state["state_sketches"])}


def refresh_summaries(warehouse, years, sketches=False, min_route_flights=50):
    """Recompute the summary tables for the given years from the states of their months.

    Only months that changed since are read for it (see `states`). A summary that cannot be built is
    reported and does not keep the others from being refreshed; those built appear together. `sketches` adds the table of
    approximate figures.
    """
    problems, published = {}, []
    state = states.current(warehouse, years, sketches)
    for name, build in (SUMMARIES | SKETCHED if sketches else SUMMARIES).items():
        try:
            published += _years_beside(warehouse, name, build(warehouse, state, min_route_flights), years)
        except Exception as error:  # noqa: BLE001 - whatever the cause, the load stands
            log.warning("could not refresh %s: %s", name, error)
            problems[name] = str(error)
    warehouse.publish(published)
    return problems


def _years_beside(warehouse, table, summary, years):
    """Write the years of a summary beside the live ones; gives the rows to publish. A year without rows ends up empty."""
    folder = f"version={wh.new_version()}"
    path = f"{warehouse.path(table)}/{folder}"
    summary.hint("rebalance", "year").write.partitionBy("year").parquet(path)
    written = warehouse.spark.read.schema(summary.schema).parquet(path)
    filled = {r["year"] for r in written.select("year").distinct().collect()} if "year" in written.columns else set()
    for year in set(years) - filled:
        warehouse.spark.createDataFrame([], summary.drop("year").schema).write.parquet(f"{path}/year={year}")
    return [(table, f"year={year}", f"{folder}/year={year}", None) for year in years]


def ensure_calendar(warehouse, first=schema.CALENDAR_START, last=schema.CALENDAR_END):
    """Append the days the calendar table lacks."""
    spark = warehouse.spark
    wanted = dimensions.build_dim_date(spark, first, last)
    stored = warehouse.read("dim_date", wanted.schema)
    missing = wanted.join(stored.select("date_id"), "date_id", "left_anti")
    warehouse.append(missing.coalesce(1), "dim_date")


#: Hashes of keys that occur again are sent to every task up to this number.
FEW_AGAIN = 1 << 20


def _without_duplicates(typed, order, work):
    """`clean.remove_duplicates` of a stored table that shuffles only the rows whose key may occur again, if these are few.

    Keys are counted by a hash of eight bytes. Equal keys have equal hashes, null parts too, so a row whose hash occurs
    once has no duplicate; the others go through the exact rule. The hashes that occur again are stored in `work`.
    """
    spark = typed.sparkSession
    hashed = F.xxhash64(*[F.col(c) for c in schema.FLIGHT_KEY if c in typed.columns])
    typed.groupBy(hashed.alias("_again")).agg(F.count("*").alias("_n")).filter("_n > 1").select(
        "_again").write.parquet(work)
    again = spark.read.schema("_again long").parquet(work)
    number = again.count()
    if number == 0:
        return typed
    if number > FEW_AGAIN:
        return clean.remove_duplicates(typed, order)
    found = hashed == F.col("_again")
    again = F.broadcast(again)  # at most FEW_AGAIN rows
    return typed.join(again, found, "left_anti").unionByName(
        typed.join(again, found, "left_semi").transform(clean.remove_duplicates, order))


def cleaned_once(spark, raw, stats, order=("input_order",), date_formats=clean.DATE_FORMATS, stored=None, deal=()):
    """Valid flights of raw rows; adds the counts along the way to `stats`.

    Files are parsed once. The typed rows and then the cleaned rows are stored in the shared work
    folder and every later step reads them there, so a lost executor costs a re-read of columns,
    and the input order of the rows cannot change between steps. The typed rows are deleted once the cleaned ones are
    stored; these, in `stored` if given, are the caller's to delete. They are dealt by the columns of `deal`, if any.
    """
    typed_path = work_folder(spark, "typed")
    raw.transform(clean.standardise, date_formats).write.parquet(typed_path)
    typed = spark.read.parquet(typed_path)
    profile = clean.null_profile(typed).first().asDict()
    stats["rows_raw"] = profile.pop("rows_raw")
    stats["null_profile"] = profile
    stored, again = stored or work_folder(spark, "cleaned"), work_folder(spark, "again")
    unique = _without_duplicates(typed, order, again).drop("input_order")
    if deal:  # before columns are added, so that these are not shuffled
        unique = unique.hint("rebalance", *deal).sortWithinPartitions(*deal)
    unique.withColumn("_valid", clean.airports_valid()).transform(clean.derive_columns).write.parquet(stored)
    for path in (typed_path, again):
        forget(spark, path)
    unique = spark.read.parquet(stored)
    stats.update(unique.agg(
        F.count("*").alias("rows_after_dedup"),
        F.count_if("_valid").alias("rows_valid"),
        *clean.outcome_counts(F.col("_valid")),
    ).first().asDict())
    stats["rows_rejected"] = stats["rows_raw"] - stats["rows_valid"]
    return unique.filter("_valid").drop("_valid")


def enrich_dimensions(warehouse, airports=None, airlines=None):
    """Store what reference documents know about the airports and carriers of the warehouse.

    The new table is written beside the old one and published in one step.
    """
    for table, known, reference, key, columns in (
        ("dim_airports", warehouse.airports(), airports, "iata_code",
         ["airport_name", "city", "country_code", "latitude", "longitude", "utc_offset_hrs"]),
        ("dim_carriers", warehouse.carriers(), airlines, "carrier_code", ["carrier_name", "is_active"]),
    ):
        if reference is not None:
            warehouse.replace_table(dimensions.enrich(known, reference, key, columns), table)


def run_month(warehouse, raw, year, month, source_file=None, order=("input_order",),
              skip_quality=False, overwrite=False, fail_on_quality=True, run_type="manual",
              as_of=None, refresh=True, date_formats=clean.DATE_FORMATS):
    """Clean, check and load one month of raw rows. The cleaned rows and shuffle files go when they have been read."""
    spark = warehouse.spark
    started = now()
    run_id = new_run_id()
    stats = {"year": year, "month": month, "run_id": run_id, "steps_completed": []}
    # Nothing is parsed for a month that is there and is to stay.
    existing = wh.rows_of_month(warehouse.facts(), year, month).first()["existing_rows"]
    if existing and not overwrite:
        warehouse.record(audit_run(spark, run_id, year, month, "skipped", started, run_type, source_file),
                         "pipeline_runs", run_key(run_id))
        return stats | {"status": "skipped", "skipped": True, "existing_rows": existing}
    cleaned = work_folder(spark, "cleaned")
    try:
        with shuffles_removed(spark):
            return _run_month(warehouse, raw, year, month, source_file, order, skip_quality, overwrite, fail_on_quality,
                              run_type, as_of, refresh, date_formats, started, stats, cleaned)
    finally:
        forget(spark, cleaned)


def _run_month(warehouse, raw, year, month, source_file, order, skip_quality, overwrite, fail_on_quality, run_type,
               as_of, refresh, date_formats, started, stats, cleaned):
    spark, run_id = warehouse.spark, stats["run_id"]
    try:
        flights = cleaned_once(spark, raw, stats, order, date_formats, cleaned)
        stats["steps_completed"].append("transform")

        if not skip_quality:
            # A dozen rows: kept on the driver, so that the checks run once.
            found = quality.run_all_checks(flights, as_of)
            results = spark.createDataFrame(found.collect(), found.schema)
            warehouse.record(quality_rows(results, run_id), "data_quality_results", run_key(run_id))
            stats["quality_results"] = [r.asDict() for r in results.collect()]
            stats["quality_passed"] = not quality.gate(results, fail=False)
            stats["steps_completed"].append("quality")
            quality.gate(results, fail=fail_on_quality)
    except Exception as error:
        warehouse.record(audit_run(
            spark, run_id, year, month, "failed", started, run_type, source_file,
            rows_extracted=stats.get("rows_raw", 0), rows_validated=stats.get("rows_valid", 0),
            error=str(error),
        ), "pipeline_runs", run_key(run_id))
        raise
    loaded = load_month(warehouse, flights, source_file, year, month, overwrite, run_type,
                        rows_extracted=stats["rows_raw"], run_id=run_id)
    stats.update(loaded)
    stats["steps_completed"].append("load")
    if refresh and not loaded.get("skipped"):
        stats["refresh_problems"] = refresh_summaries(warehouse, [year])
        stats["steps_completed"].append("refresh")
    stats["status"] = "skipped" if loaded.get("skipped") else "success"
    return stats
