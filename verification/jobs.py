"""Queries for loads, audit, refresh, ingest and the classifier."""

from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import flight
from tarmac.operators import clean, model
from tarmac.plans import load
from tarmac.plans import warehouse as wh
from tarmac.session import work_folder
from tarmac.sources import sample_flights as sample
from tarmac.sources.raw import read_flight_files
from tarmac.streaming import ingest
from verification.registry import query
from verification.reports import CARRIER_SQL, MIN_ROUTE_FLIGHTS, MONTHLY_SQL, ROUTE_SQL
from verification.sql_text import rnd
from verification.tables import CARRIER_IDS, ID

PERIOD = (1998, 3)
IN_PERIOD = '"year" = 1998 AND "month" = 3'
LOADABLE = "regexp_matches(dest_airport, '^[A-Z]{3}$')"


def _warehouse(spark):
    return wh.Warehouse(spark, work_folder(spark, "warehouse"))


def _month(spark, folder):
    """All flights, cleaned, as if they were those of one month."""
    stored = work_folder(spark, "cleaned")
    flights = sample.flights(spark, folder).transform(clean.keep_valid_airports)
    flights.withColumns({
        "year": F.lit(PERIOD[0]).cast("smallint"), "month": F.lit(PERIOD[1]).cast("smallint"),
        "source_file": F.lit("march"),
    }).write.option("maxRecordsPerFile", 100_000).parquet(stored)  # several files, several tasks
    return spark.read.parquet(stored)


def _deliveries(spark, folder):
    """Raw text of all arrivals in two parts: flights, then corrections. A flight number per row
    leaves no doubt about which flight a correction is for."""
    text = sample.raw_text(spark, folder, dirty=False).withColumn(
        "Flight_Number_Reporting_Airline", F.concat_ws("-", *ID))
    return [text.filter(F.col("resent") == n).select(*schema.RAW_TO_CANONICAL) for n in (0, 1)]


def _land(rows, folder):
    """Files as they are delivered. A compressed file is read by one task, so none is large."""
    rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 100_000).csv(folder, header=True)


# --- loads ----------------------------------------------------------------------------------

@query("load_overwrite_partition", f"""
SELECT "year", "month", COUNT(*) AS flights,
       SUM(arrival_delay_min + CASE WHEN {IN_PERIOD} THEN 1000 ELSE 0 END) AS arrival_sum
FROM f GROUP BY "year", "month" """)
def load_overwrite_partition(spark, folder):
    """All months stored, then one of them replaced, twice."""
    stored = work_folder(spark, "months")
    flights = sample.flights(spark, folder).drop(*ID)
    wh.write_months(flights, stored)
    year, month = PERIOD
    corrected = flights.filter((F.col("year") == year) & (F.col("month") == month)).withColumn(
        "arrival_delay_min", (F.col("arrival_delay_min") + 1000).cast("decimal(7,2)"))
    for _ in range(2):
        wh.write_months(corrected, stored)
    return (
        spark.read.parquet(stored).groupBy("year", "month")
        .agg(F.count("*").alias("flights"), F.sum("arrival_delay_min").alias("arrival_sum"))
    )


RUN_COLUMNS = ["status", "year", "month", "rows_extracted", "rows_validated", "rows_loaded",
               "rows_rejected", "source_file"]


@query("load_skip_existing", f"""
, n AS (SELECT COUNT(*) AS n FROM f WHERE {LOADABLE})
SELECT 'success' AS status, 1998 AS "year", 3 AS "month", n AS rows_extracted, n AS rows_validated, n AS rows_loaded,
       CAST(0 AS BIGINT) AS rows_rejected, 'march' AS source_file FROM n
UNION ALL SELECT 'skipped', 1998, 3, 0, 0, 0, 0, 'march'""")
def load_skip_existing(spark, folder):
    store = _warehouse(spark)
    flights = _month(spark, folder)
    for _ in range(2):
        load.load_month(store, flights, "march", *PERIOD)
    return store.runs().select(*RUN_COLUMNS)


@query("load_month", f"""
SELECT flight_date, carrier_code, carrier_id, flight_number, route, arrival_delay_min, delay_category, 1998 AS "year", 3 AS "month"
FROM f JOIN ({CARRIER_IDS.replace('SELECT carrier_code FROM carriers', f'SELECT DISTINCT carrier_code FROM f WHERE {LOADABLE}')}) USING (carrier_code)
WHERE {LOADABLE}""")
def load_month(spark, folder):
    """Load a month twice, the second time replacing the first."""
    store = _warehouse(spark)
    flights = _month(spark, folder)
    for _ in range(2):
        load.load_month(store, flights, "march", *PERIOD, overwrite=True)
    return store.facts().select(
        "flight_date", "carrier_code", "carrier_id", "flight_number", "route",
        "arrival_delay_min", "delay_category", "year", "month")


@query("audit_run_row", f"""
, n AS (SELECT COUNT(*) AS n FROM f WHERE {LOADABLE})
SELECT 'success' AS status, 1998 AS "year", 3 AS "month", n AS rows_extracted, n AS rows_loaded, 0 AS has_error FROM n
UNION ALL SELECT 'failed', 1998, 4, n, 0, 1 FROM n""")
def audit_run_row(spark, folder):
    """A load that succeeds, and one that fails because its rows are of another month."""
    store = _warehouse(spark)
    flights = _month(spark, folder)
    load.load_month(store, flights, "march", *PERIOD)
    try:
        load.load_month(store, flights, "march", 1998, 4)
    except ValueError:
        pass
    return store.runs().select(
        "status", "year", "month", "rows_extracted", "rows_loaded",
        F.col("error_message").isNotNull().cast("int").alias("has_error"))


LATEST = """SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey, flight_date
    ORDER BY resent DESC) AS rn FROM arrivals"""


@query("run_month", f"""
SELECT 'success' AS status, (SELECT COUNT(*) FROM arrivals) AS rows_extracted, COUNT(*) AS rows_loaded,
       (SELECT COUNT(*) FROM arrivals) - COUNT(*) AS rows_rejected, SUM(arrival_delay_min) AS arrival_sum,
       CAST(12 AS BIGINT) AS checks_stored, COUNT(DISTINCT carrier_code) AS carriers_summarised
FROM ({LATEST}) WHERE rn = 1 AND {LOADABLE}""")
def run_month(spark, folder):
    """All arrivals as the CSV files of one month, through cleaning, checks, load and refresh."""
    store = _warehouse(spark)
    load.ensure_calendar(store, *sample.CALENDAR)
    landing = work_folder(spark, "landing")
    for part in _deliveries(spark, folder):
        as_month = part.withColumns({
            "Year": F.lit(str(PERIOD[0])), "Month": F.lit(f"{PERIOD[1]}.0")})
        _land(as_month, landing)
    load.run_month(store, read_flight_files(spark, landing), *PERIOD, source_file=landing)
    run = store.runs().select("status", "rows_extracted", "rows_loaded", "rows_rejected")
    facts = store.facts().agg(F.sum("arrival_delay_min").alias("arrival_sum"))
    checks = store.read("data_quality_results").agg(F.count("*").alias("checks_stored"))
    summary = store.read("mv_carrier_performance").agg(F.count("*").alias("carriers_summarised"))
    names = [*run.columns, "arrival_sum", "checks_stored", "carriers_summarised"]
    for one_row in (facts, checks, summary):
        run = run.unionByName(one_row, allowMissingColumns=True)
    return run.agg(*[F.max(c).alias(c) for c in names])


@query("mv_refresh", MONTHLY_SQL)
def mv_refresh(spark, folder):
    """Store all flights, refresh every year's summaries, and read one of them."""
    store = _warehouse(spark)
    store.replace_months(sample.flights(spark, folder).drop(*ID))
    load.ensure_calendar(store, *sample.CALENDAR)
    years = [r["year"] for r in store.facts().select("year").distinct().collect()]
    problems = load.refresh_summaries(store, years)
    if problems:
        raise RuntimeError(str(problems))
    return store.read("mv_monthly_summary")


CORRECTED = f"""SELECT * REPLACE (arrival_delay_min + CASE WHEN {IN_PERIOD} THEN 7 ELSE 0 END AS arrival_delay_min) FROM f"""


def _refreshed_after_a_correction(spark, folder, **options):
    """All months stored and summarised, then one month replaced and the summaries refreshed again: only the
    state of that month is made anew."""
    store = _warehouse(spark)
    for table, fields, rows in (("dim_carriers", schema.DIM_CARRIER, sample.numbered_carriers(spark, folder)),
                                ("dim_airports", schema.DIM_AIRPORT, sample.numbered_airports(spark, folder))):
        store.append(rows.select([(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                                  for f in fields]), table)
    flights = sample.flights(spark, folder).drop(*ID)
    load.ensure_calendar(store, *sample.CALENDAR)
    store.replace_months(flights)
    options = {"min_route_flights": MIN_ROUTE_FLIGHTS} | options
    years = [r["year"] for r in store.facts().select("year").distinct().collect()]
    load.refresh_summaries(store, years, **options)
    year, month = PERIOD
    store.replace_months(flights.filter((F.col("year") == year) & (F.col("month") == month)).withColumn(
        "arrival_delay_min", (F.col("arrival_delay_min") + 7).cast("decimal(7,2)")))
    problems = load.refresh_summaries(store, [year], **options)
    if problems:
        raise RuntimeError(str(problems))
    return store


@query("mv_refresh_carriers", CARRIER_SQL.replace("FROM f", f"FROM ({CORRECTED}) f"))
def mv_refresh_carriers(spark, folder):
    return _refreshed_after_a_correction(spark, folder).read("mv_carrier_performance")


@query("mv_refresh_routes", ROUTE_SQL.replace("FROM f", f"FROM ({CORRECTED}) f"))
def mv_refresh_routes(spark, folder):
    return _refreshed_after_a_correction(spark, folder).read("mv_route_analysis")


@query("sketch_percentiles", f"""
SELECT carrier_code, "year", COUNT(*) AS total_flights, TRUE AS median_within, TRUE AS p90_within
FROM ({CORRECTED}) GROUP BY carrier_code, "year" """)
def sketch_percentiles(spark, folder):
    """Approximate percentiles from merged sketches, held against the exact ranks of what they name: within 2.5 %."""
    store = _refreshed_after_a_correction(spark, folder, sketches=True)
    named = store.read("mv_sketches").select(
        F.col("carrier_code").alias("of"), F.col("year").alias("of_year"), "median_delay_min", "p90_delay_min")
    seen = store.facts().groupBy("carrier_code", "year", F.col("arrival_delay_min").cast("double").alias("delay")).agg(
        F.count("*").alias("n"))
    known = F.when(F.col("delay").isNotNull(), F.col("n"))

    def within(estimate, share):
        below, upto = (F.sum(F.when(test, known)) for test in (F.col("delay") < estimate, F.col("delay") <= estimate))
        return ((F.coalesce(below, F.lit(0)) / F.sum(known) - 0.025 <= share)
                & (F.coalesce(upto, F.lit(0)) / F.sum(known) + 0.025 >= share))

    return seen.join(named, (F.col("carrier_code") == F.col("of")) & (F.col("year") == F.col("of_year"))).groupBy(
        "carrier_code", "year").agg(
        F.sum("n").alias("total_flights"),
        within(F.col("median_delay_min"), 0.5).alias("median_within"),
        within(F.col("p90_delay_min"), 0.9).alias("p90_within")).withColumn("year", F.col("year").cast("int"))


@query("sketch_distinct", """
SELECT carrier_code, "year", COUNT(DISTINCT route) AS routes, COUNT(DISTINCT origin_airport) AS origins,
       TRUE AS routes_within, TRUE AS origins_within FROM f GROUP BY carrier_code, "year" """)
def sketch_distinct(spark, folder):
    """Approximate distinct counts from merged sketches, beside the exact ones: within 8 %, five times their standard error."""
    store = _refreshed_after_a_correction(spark, folder, sketches=True)
    named = store.read("mv_sketches").select(F.col("carrier_code").alias("of"), F.col("year").alias("of_year"),
                                             "routes_served", "airports_served")
    exact = store.facts().groupBy("carrier_code", "year").agg(
        F.count_distinct("route").alias("routes"), F.count_distinct("origin_airport").alias("origins"))

    def within(estimate, count):
        return F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(1.0), 0.08 * F.col(count))

    return exact.join(named, (F.col("carrier_code") == F.col("of")) & (F.col("year") == F.col("of_year"))).select(
        "carrier_code", F.col("year").cast("int").alias("year"), "routes", "origins",
        within("routes_served", "routes").alias("routes_within"),
        within("airports_served", "origins").alias("origins_within"))


@query("load_failed_replace", f"""
, n AS (SELECT COUNT(*) AS n, SUM(arrival_delay_min) AS s FROM f WHERE {LOADABLE})
SELECT n AS flights, s AS arrival_sum, 1 AS succeeded, 1 AS failed FROM n""")
def load_failed_replace(spark, folder):
    """A month whose replacement fails in the middle of its write: the old rows stay in sight."""
    store = _warehouse(spark)
    flights = _month(spark, folder)
    load.load_month(store, flights, "march", *PERIOD)
    breaking = flights.withColumn("arrival_delay_min", F.when(
        F.col("flight_number") == "7", F.lit("12345678.0")).otherwise(F.col("arrival_delay_min").cast("string"))
        .cast("decimal(18,2)"))
    try:
        load.load_month(store, breaking, "march", *PERIOD, overwrite=True)
    except Exception as error:  # noqa: BLE001 - the failure is the point
        assert "NUMERIC_VALUE_OUT_OF_RANGE" in str(error)
    runs = store.runs().agg(F.count_if(F.col("status") == "success").cast("int").alias("succeeded"),
                            F.count_if(F.col("status") == "failed").cast("int").alias("failed"))
    facts = store.facts().agg(F.count("*").alias("flights"), F.sum("arrival_delay_min").alias("arrival_sum"))
    both = facts.unionByName(runs, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query("stream_replay", f"""
SELECT COUNT(*) AS flights, SUM(arrival_delay_min) AS arrival_sum, CAST(2 AS BIGINT) AS runs, CAST(24 AS BIGINT) AS checks
FROM ({LATEST}) WHERE rn = 1 AND {LOADABLE}""")
def stream_replay(spark, folder):
    """Two deliveries, each merged twice as after a failure between the merge and the checkpoint: every one leaves one run
    row and twelve check rows, and the facts are those of one merge. Nobody reads the months that a merge replaced, so they go."""
    store = _warehouse(spark)
    for batch, part in enumerate(_deliveries(spark, folder)):
        landing = work_folder(spark, "landing")
        _land(part, landing)
        for _ in range(2):
            ingest.merge_batch(store, [landing], refresh=False, txn=ingest.transaction("progress", batch))
            store.drop_superseded("fact_flights")
    totals = [store.facts().agg(F.count("*").alias("flights"), F.sum("arrival_delay_min").alias("arrival_sum")),
              store.runs().agg(F.count("*").alias("runs")),
              store.read("data_quality_results").agg(F.count("*").alias("checks"))]
    whole = totals[0].unionByName(totals[1], allowMissingColumns=True).unionByName(totals[2], allowMissingColumns=True)
    return whole.agg(*[F.max(c).alias(c) for c in whole.columns])


@query("stream_ingest", f"""
SELECT "year", "month", COUNT(*) AS flights, SUM(arrival_delay_min) AS arrival_sum
FROM ({LATEST}) WHERE rn = 1 AND {LOADABLE} GROUP BY "year", "month" """)
def stream_ingest(spark, folder):
    """Two deliveries of CSV files, the second with the corrections, ingested one after the other;
    a third call finds nothing new."""
    store = _warehouse(spark)
    landing, checkpoint = work_folder(spark, "landing"), work_folder(spark, "progress")
    for part in _deliveries(spark, folder):
        _land(part, landing)
        ingest.ingest_stream(store, landing, checkpoint)
    ingest.ingest_stream(store, landing, checkpoint)
    return store.facts().groupBy("year", "month").agg(
        F.count("*").alias("flights"), F.sum("arrival_delay_min").alias("arrival_sum"))


@query("stream_refreshes_summaries", f"""
SELECT "year", "month", COUNT(*) AS total_flights FROM ({LATEST})
WHERE rn = 1 AND {LOADABLE} AND flight_date BETWEEN DATE '{sample.CALENDAR[0]}' AND DATE '{sample.CALENDAR[1]}'
GROUP BY "year", "month" """)
def stream_refreshes_summaries(spark, folder):
    """The monthly summary after two ingested deliveries; days outside the calendar have no part in it."""
    store = _warehouse(spark)
    load.ensure_calendar(store, *sample.CALENDAR)
    landing, checkpoint = work_folder(spark, "landing"), work_folder(spark, "progress")
    for part in _deliveries(spark, folder):
        _land(part, landing)
        ingest.ingest_stream(store, landing, checkpoint)
    return store.read("mv_monthly_summary").groupBy("year", "month").agg(
        F.sum("total_flights").alias("total_flights"))


@query("merge_late_flights", f"""
SELECT "year", "month", COUNT(*) AS flights, COUNT(*) AS ids,
       SUM(arrival_delay_min + CASE WHEN {IN_PERIOD} AND departure_delay_min > 15 THEN 7 ELSE 0 END) AS arrival_sum
FROM f GROUP BY "year", "month" """)
def merge_late_flights(spark, folder):
    """All months stored, then corrections of the late departures of one month merged into it."""
    store = _warehouse(spark)
    flights = sample.flights(spark, folder).withColumn("flight_number", F.concat_ws("-", *ID)).drop(*ID)
    store.replace_months(flights.transform(wh.with_flight_id))
    year, month = PERIOD
    late, stored = flights.filter((F.col("year") == year) & (F.col("month") == month) & (
        F.col("departure_delay_min") > 15)), work_folder(spark, "late")
    late.withColumn("arrival_delay_min", F.col("arrival_delay_min") + 7).write.parquet(stored)
    store.merge_months(spark.read.parquet(stored))
    return store.facts().groupBy("year", "month").agg(
        F.count("*").alias("flights"), F.count_distinct("flight_id").alias("ids"),
        F.sum("arrival_delay_min").alias("arrival_sum"))


# --- classifier -----------------------------------------------------------------------------

FEATURE_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, carrier_code, origin_airport, dest_airport, "month",
       CAST(isodow(flight_date) AS INT) AS day_of_week,
       scheduled_departure // 100 AS scheduled_departure_hour, scheduled_arrival // 100 AS scheduled_arrival_hour,
       distance_miles, CAST(is_delayed AS INT) AS is_delayed
FROM f WHERE {LOADABLE} AND NOT is_cancelled AND NOT is_diverted AND scheduled_arrival <= 2359"""


def feature_rows(spark, folder):
    flights = sample.flights(spark, folder).withColumn(
        "day_of_week", (F.weekday("flight_date") + 1).cast("smallint"))
    return model.features(flights, keep=ID)


def stored_features(spark, folder):
    stored = work_folder(spark, "features")
    feature_rows(spark, folder).write.option("maxRecordsPerFile", 100_000).parquet(stored)
    return spark.read.parquet(stored)


@query("ml_features", FEATURE_SQL)
def ml_features(spark, folder):
    return feature_rows(spark, folder)


@query("ml_class_balance", f"""
SELECT COUNT(*) AS flights, {rnd('AVG(is_delayed)', 6)} AS positive_rate, COUNT(DISTINCT is_delayed) AS labels
FROM ({FEATURE_SQL})""")
def ml_class_balance(spark, folder):
    return feature_rows(spark, folder).agg(
        F.count("*").alias("flights"),
        F.round(F.avg(schema.LABEL), 6).alias("positive_rate"),
        F.count_distinct(schema.LABEL).alias("labels"))


@query("ml_stratified_split", f"""
, x AS (SELECT *, md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey) AS h
        FROM ({FEATURE_SQL})),
c AS (SELECT *, COUNT(*) OVER () AS n, COUNT(*) OVER (PARTITION BY is_delayed) AS n_label,
             row_number() OVER (PARTITION BY is_delayed ORDER BY substr(h, 1, 15)) AS rn FROM x),
q AS (SELECT *, CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) AS tests,
             CASE is_delayed WHEN 1 THEN n_label ELSE n - n_label END AS late FROM c),
r AS (SELECT *, CAST(floor(CAST(tests AS DOUBLE) * late / n + 0.5) AS BIGINT) AS late_tests FROM q)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, is_delayed,
       rn <= CASE is_delayed WHEN 1 THEN late_tests ELSE tests - late_tests END AS is_test FROM r""")
def ml_stratified_split(spark, folder):
    return model.stratified_split(stored_features(spark, folder), ID).select(
        *ID, "is_delayed", "is_test")


@query("ml_impute", f"""
, x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_partkey % 13 <> 0 THEN carrier_code END AS carrier_code,
               CASE WHEN l_partkey % 17 <> 0 THEN distance_miles END AS distance_miles,
               CASE WHEN l_partkey % 19 <> 0 THEN CAST(scheduled_departure_hour AS DOUBLE) END AS hour FROM ({FEATURE_SQL}))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       COALESCE(carrier_code, (SELECT carrier_code FROM x WHERE carrier_code IS NOT NULL GROUP BY carrier_code
         ORDER BY COUNT(*) DESC, carrier_code LIMIT 1)) AS carrier_code,
       COALESCE(distance_miles, (SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY distance_miles) FROM x)) AS distance_miles,
       COALESCE(hour, (SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY hour) FROM x)) AS scheduled_departure_hour
FROM x""")
def ml_impute(spark, folder):
    def unless(column, n):
        return F.when(F.col("l_partkey") % n != 0, F.col(column))

    gaps = feature_rows(spark, folder).withColumns({
        "carrier_code": unless("carrier_code", 13),
        "distance_miles": unless("distance_miles", 17),
        "scheduled_departure_hour": unless("scheduled_departure_hour", 19),
    })
    return model.impute(gaps, model.fill_values(gaps)).select(
        *ID, "carrier_code", "distance_miles", "scheduled_departure_hour")


_TRAINED = {}


def trained(spark, folder):
    """Model folder of the sample tables; trained once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TRAINED:
        forest, report = model.train_and_evaluate(stored_features(spark, folder), ID)
        target = work_folder(spark, "classifier")
        model.save(forest, report, target)
        _TRAINED[key] = target
    return _TRAINED[key]


@query("ml_train")
def ml_train(spark, folder):
    """Sizes and quality of the trained forest, as stored beside it."""
    return spark.read.json(f"{trained(spark, folder)}/metrics")


@query("ml_score")
def ml_score(spark, folder):
    """All feature rows scored with the stored model, codes in lower case."""
    rows = stored_features(spark, folder).withColumns({
        c: F.lower(c) for c in schema.FEATURE_CATEGORIES})
    return model.score(model.load(trained(spark, folder)), rows)


# A given probability in place of a model's, so that SQL can follow.
GIVEN = f"""SELECT *, CAST((l_orderkey * 31 + l_partkey * 17) % 1001 AS DOUBLE) / 1000 AS p FROM ({FEATURE_SQL})"""


def given_predictions(spark, folder):
    p = ((F.col("l_orderkey") * 31 + F.col("l_partkey") * 17) % 1001).cast("double") / 1000
    rows = feature_rows(spark, folder).withColumn("p", p)
    return rows.withColumn("prediction", (F.col("p") > 0.5).cast("int"))


@query("ml_confusion", f"""
SELECT is_delayed, CAST(p > 0.5 AS INT) AS prediction, COUNT(*) AS flights FROM ({GIVEN}) GROUP BY ALL""")
def ml_confusion(spark, folder):
    return model.confusion(given_predictions(spark, folder))


@query("ml_metrics", f"""
, t AS (SELECT COUNT(*) AS rows_test, COUNT(*) FILTER (WHERE is_delayed = 0 AND p <= 0.5) AS true_negatives,
        COUNT(*) FILTER (WHERE is_delayed = 0 AND p > 0.5) AS false_positives,
        COUNT(*) FILTER (WHERE is_delayed = 1 AND p <= 0.5) AS false_negatives,
        COUNT(*) FILTER (WHERE is_delayed = 1 AND p > 0.5) AS true_positives FROM ({GIVEN}))
SELECT *, CAST(true_positives + true_negatives AS DOUBLE) / rows_test AS accuracy,
       CAST(true_positives AS DOUBLE) / (true_positives + false_positives) AS "precision",
       CAST(true_positives AS DOUBLE) / (true_positives + false_negatives) AS recall,
       CAST(2 * true_positives AS DOUBLE) / (2 * true_positives + false_positives + false_negatives) AS f1 FROM t""")
def ml_metrics(spark, folder):
    return model.metrics(given_predictions(spark, folder))


@query("ml_auc", f"""
, s AS (SELECT p, COUNT(*) FILTER (WHERE is_delayed = 1) AS pos, COUNT(*) FILTER (WHERE is_delayed = 0) AS neg FROM ({GIVEN}) GROUP BY p),
c AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT SUM(pos)::BIGINT AS positives, SUM(neg)::BIGINT AS negatives,
       ROUND(SUM(pos * (2 * below + neg))::DOUBLE / (2 * SUM(pos) * SUM(neg))::DOUBLE, 6) AS roc_auc FROM c""")
def ml_auc(spark, folder):
    return model.roc_auc(given_predictions(spark, folder), "p").withColumn("roc_auc", F.round("roc_auc", 6))


@query("ml_risk_band", f"""
SELECT CASE WHEN p >= 0.65 THEN 'High delay risk' WHEN p >= 0.4 THEN 'Medium delay risk' ELSE 'Low delay risk' END AS risk,
       CASE WHEN p > 0.5 THEN 'Delayed' ELSE 'Not delayed' END AS verdict, COUNT(*) AS flights
FROM ({GIVEN}) GROUP BY ALL""")
def ml_risk_band(spark, folder):
    return (
        given_predictions(spark, folder)
        .groupBy(flight.risk_band(F.col("p")).alias("risk"),
                 flight.delay_label(F.col("prediction")).alias("verdict"))
        .agg(F.count("*").alias("flights"))
    )


@query("ml_score_input_checks", """
SELECT concat_ws('; ', CASE WHEN origin_airport = dest_airport THEN 'origin equals destination' END,
         CASE WHEN NOT COALESCE(scheduled_arrival // 100 BETWEEN 0 AND 23, FALSE) THEN 'arrival hour' END,
         CASE WHEN NOT COALESCE(distance_miles - 100 BETWEEN 50 AND 6000, FALSE) THEN 'distance' END) AS problems,
       COUNT(*) AS flights
FROM f GROUP BY 1""")
def ml_score_input_checks(spark, folder):
    rows = sample.flights(spark, folder).select(
        "origin_airport", "dest_airport", "month",
        (F.weekday("flight_date") + 1).alias("day_of_week"),
        F.floor(F.col("scheduled_departure") / 100).alias("scheduled_departure_hour"),
        F.floor(F.col("scheduled_arrival") / 100).alias("scheduled_arrival_hour"),
        (F.col("distance_miles") - 100).alias("distance_miles"),
    )
    return model.input_problems(rows).groupBy("problems").agg(F.count("*").alias("flights"))
