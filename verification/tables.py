"""Queries for single operators: sources, cleaning, checks, aggregates, dimensions."""

from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import flight
from tarmac.functions import measures as m
from tarmac.functions import periods
from tarmac.operators import clean, dimensions, quality
from tarmac.plans import load
from tarmac.plans import warehouse as wh
from tarmac.session import work_folder
from tarmac.sources import raw as src
from tarmac.sources import sample_flights as sample
from verification.registry import query
from verification.sql_text import CALENDAR, avg, pct, rnd, with_flights

AS_OF = "2001-06-30"
ID = sample.ROW_ID
ORDER = sample.ARRIVAL_ORDER
CLEAN_NAMES = (
    "flight_date, carrier_code, flight_number, origin_airport, dest_airport, scheduled_departure,"
    " scheduled_arrival, departure_delay_min, arrival_delay_min, is_cancelled, is_diverted,"
    " cancellation_code, distance_miles, \"year\", \"month\", day_of_month, day_of_week"
)
CLEAN_LIST = [c.strip().strip('"') for c in CLEAN_NAMES.split(",")]


def raw_known(spark, folder):
    """Dirty raw text as the CSV reader hands it over: tokens for "no value" are null."""
    return src.null_tokens_to_null(sample.raw_text(spark, folder))


def csv_folder(spark, folder, dirty=True):
    """Raw text of all arrivals as CSV files, with the blank last column real files have."""
    landed = work_folder(spark, "landing")
    text = sample.raw_text(spark, folder, dirty).select(
        *schema.RAW_TO_CANONICAL, F.lit(None).cast("string").alias(" ")
    )
    text.write.csv(landed, header=True)
    return landed


# --- sources and sinks ----------------------------------------------------------------------

@query("src_csv_clean_tokens", """
SELECT "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest",
       NULLIF("CRSArrTime", 'n/a') AS "CRSArrTime",
       CASE WHEN "ArrDelay" IN ('NA', ' ') THEN NULL ELSE "ArrDelay" END AS "ArrDelay",
       NULLIF("Cancelled", '.') AS "Cancelled", NULLIF("Distance", 'NaN') AS "Distance",
       COUNT(*) AS copies
FROM rawt GROUP BY ALL""")
def src_csv_clean_tokens(spark, folder):
    names = ["FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
             "Origin", "Dest", "CRSArrTime", "ArrDelay", "Cancelled", "Distance"]
    rows = src.read_flight_files(spark, csv_folder(spark, folder))
    return rows.groupBy(*names).agg(F.count("*").alias("copies"))


@query("src_csv_mixed_layouts", """
SELECT 'flights_1998_0' || substr("Month", 1, 1) || '.csv' AS source_month, "Origin", "Dest", COUNT(*) AS flights,
       COUNT(*) FILTER (WHERE "Month" = '3.0') AS weekdays
FROM rawt WHERE "Year" = '1998' AND "Month" IN ('3.0', '4.0') GROUP BY ALL""")
def src_csv_mixed_layouts(spark, folder):
    """Two months of a year, the second with its columns in another order and without the weekday."""
    landed = work_folder(spark, "landing")
    text = sample.raw_text(spark, folder).filter("Year = '1998'").select(*schema.RAW_TO_CANONICAL)
    for month, names in ((3, text.columns), (4, [c for c in text.columns[::-1] if c != "DayOfWeek"])):
        text.filter(F.col("Month") == f"{month}.0").select(*names).write.csv(
            periods.monthly_paths(landed, 1998, month), header=True)
    rows = src.read_flight_files(spark, periods.monthly_paths(landed, 1998))
    month = F.element_at(F.split("source_file", "/"), -2)
    return rows.groupBy(month.alias("source_month"), "Origin", "Dest").agg(
        F.count("*").alias("flights"), F.count("DayOfWeek").alias("weekdays"))


@query("src_sample_per_file", raw_sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS flight_date
FROM (SELECT * FROM lineitem LIMIT 1000)""")
def src_sample_per_file(spark, folder):
    return src.first_rows_per_parquet_file(
        spark, f"{folder}/lineitem.parquet",
        [*ID, F.col("l_shipdate").cast("date").alias("flight_date")], 1000)


@query("sink_partitioned_roundtrip", """
SELECT "year", "month", COUNT(*) AS flights, SUM(arrival_delay_min) AS arrival_sum,
       COUNT(DISTINCT route) AS routes FROM f GROUP BY ALL""")
def sink_partitioned_roundtrip(spark, folder):
    stored = work_folder(spark, "months")
    wh.write_months(sample.flights(spark, folder).drop(*ID), stored)
    return (
        spark.read.parquet(stored).groupBy("year", "month")
        .agg(F.count("*").alias("flights"), F.sum("arrival_delay_min").alias("arrival_sum"),
             F.count_distinct("route").alias("routes"))
    )


def _code(key):
    return (f"chr(CAST(65 + {key} // 676 % 26 AS INT)) || chr(CAST(65 + {key} // 26 % 26 AS INT))"
            f" || chr(CAST(65 + {key} % 26 AS INT))")


@query("ref_airports", raw_sql=f"""
SELECT {_code('c_custkey')} AS iata_code, c_name AS airport_name,
       CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS city,
       CASE WHEN c_acctbal < 0 THEN 'US' ELSE 'N' || c_nationkey END AS country_code,
       CAST(CAST(c_nationkey + 0.5 AS DECIMAL(9,6)) AS DOUBLE) AS latitude,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(-c_nationkey AS DOUBLE) END AS longitude,
       CAST(c_nationkey % 12 AS DOUBLE) AS utc_offset_hrs
FROM customer""")
def ref_airports(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    positive = F.col("c_acctbal") >= 0
    documents = customers.select(
        F.expr(_code("c_custkey").replace("//", "DIV")).alias("iata_code"),
        F.col("c_name").alias("airport_name"),
        F.when(positive, F.col("c_mktsegment")).alias("city_iata_code"),
        F.when(positive, F.concat(F.lit("N"), F.col("c_nationkey"))).alias("country_iso2"),
        F.concat("c_nationkey", F.lit(".5")).alias("latitude"),
        F.when(F.col("c_custkey") % 2 == 0, (-F.col("c_nationkey")).cast("string"))
        .alias("longitude"),
        (F.col("c_nationkey") % 12).cast("string").alias("gmt"),
    )
    landed = work_folder(spark, "airports-json")
    documents.write.json(landed)
    return src.read_airport_reference(spark, landed, one_document=False)


@query("ref_airlines", raw_sql="""
SELECT 'C' || s_suppkey AS carrier_code, s_name AS carrier_name,
       CASE WHEN s_acctbal < 0 THEN '' ELSE 'N' || s_nationkey END AS country_code,
       s_acctbal >= 1000 AND s_suppkey % 2 = 0 AS is_active
FROM supplier""")
def ref_airlines(spark, folder):
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    documents = suppliers.select(
        F.concat(F.lit("C"), "s_suppkey").alias("iata_code"),
        F.col("s_name").alias("airline_name"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("N"), "s_nationkey")).alias("country_iso2"),
        F.when(F.col("s_acctbal") >= 1000,
               F.when(F.col("s_suppkey") % 2 == 0, "Active").otherwise("disabled")).alias("status"),
    )
    landed = work_folder(spark, "airlines-json")
    documents.write.json(landed)
    return src.read_airline_reference(spark, landed, one_document=False)


@query("ingest_manifest")
def ingest_manifest(spark, folder):
    files = src.file_manifest(spark, folder, "*.parquet")
    name = F.element_at(F.split("source_file", "/"), -1)
    return files.select(name.alias("file_name"), "file_bytes", "md5")


@query("staging_rows", """
SELECT CASE WHEN l_partkey % 41 = 0 THEN 'not-a-date' ELSE "FlightDate" END AS flight_date, "IATA_CODE_Reporting_Airline" AS carrier_code,
       "Flight_Number_Reporting_Airline" AS flight_number, "Origin" AS origin_airport, "Dest" AS dest_airport,
       "DepDelay" AS departure_delay, CASE WHEN "ArrDelay" IN ('NA', ' ') THEN NULL ELSE "ArrDelay" END AS arrival_delay,
       NULLIF("Cancelled", '.') AS is_cancelled, NULLIF("Distance", 'NaN') AS distance, FALSE AS is_processed,
       "IATA_CODE_Reporting_Airline" AS json_carrier, "CRSDepTime" AS json_departure,
       CASE WHEN "ArrDelay" IN ('NA', ' ') THEN NULL ELSE "ArrDelay" END AS json_delay,
       COUNT(*) AS copies
FROM rawt GROUP BY ALL""")
def staging_rows(spark, folder):
    stored = work_folder(spark, "staging")
    rows = wh.staged_rows(raw_known(spark, folder), source_file="sample")
    rows.write.mode("append").parquet(stored)
    staged = spark.read.parquet(stored)
    in_json = {"json_carrier": "IATA_CODE_Reporting_Airline", "json_departure": "CRSDepTime",
               "json_delay": "ArrDelay"}
    names = [*wh.STAGED_TEXT, "is_processed"]
    parsed = F.from_json("raw_data", ", ".join(f"`{v}` string" for v in in_json.values()))
    return (
        staged.withColumn("parsed", parsed)
        .withColumns({k: F.col("parsed")[v] for k, v in in_json.items()})
        .groupBy(*names, *in_json).agg(F.count("*").alias("copies"))
    )


FACT_SQL = ", ".join(
    '"year"' if c == "year" else '"month"' if c == "month"
    else "'sample.csv' AS source_file" if c == "source_file" else c for c in schema.FACT_COLUMNS)


@query("fact_projection", f"SELECT {FACT_SQL} FROM f")
def fact_projection(spark, folder):
    return sample.flights(spark, folder).withColumn("source_file", F.lit("sample.csv")).withColumn(
        "unexpected_col", F.lit("ignored")).transform(wh.to_facts)


# --- cleaning -------------------------------------------------------------------------------

@query("clean_rename", """
SELECT "FlightDate" AS flight_date, carrier_code, lpad(flight_number, 4, '0') AS flight_number,
       origin_airport, dest_airport, "Cancelled" AS is_cancelled, "Distance" AS distance_miles,
       "Year" AS "year", "Month" AS "month", resent, l_orderkey, l_linenumber
FROM rawt""")
def clean_rename(spark, folder):
    return sample.raw_text(spark, folder).transform(clean.rename_columns).select(
        "flight_date", "carrier_code", "flight_number", "origin_airport", "dest_airport",
        "is_cancelled", "distance_miles", "year", "month", "resent", "l_orderkey", "l_linenumber")


@query("clean_cast", f"SELECT {CLEAN_NAMES}, resent, l_orderkey, l_linenumber FROM cast_rows")
def clean_cast(spark, folder):
    return raw_known(spark, folder).transform(clean.standardise).select(
        *CLEAN_LIST, "resent", "l_orderkey", "l_linenumber")


@query("null_profile", """
SELECT COUNT(*) AS rows_raw, """ + ", ".join(
    f"COUNT(*) FILTER (WHERE NOT is_cancelled AND {c} IS NULL) AS {c}"
    for c in schema.DELAY_COLUMNS) + " FROM cast_rows")
def null_profile(spark, folder):
    return raw_known(spark, folder).transform(clean.standardise).transform(clean.null_profile)


@query("dedup_keep_last", """
SELECT * EXCLUDE (rn) FROM (
  SELECT flight_date, carrier_code, flight_number, origin_airport, dest_airport, arrival_delay_min,
         distance_miles, resent, l_orderkey, l_linenumber,
         row_number() OVER (PARTITION BY flight_date, carrier_code, flight_number, origin_airport, dest_airport
           ORDER BY resent DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM arrivals) WHERE rn = 1""")
def dedup_keep_last(spark, folder):
    return sample.arrivals(spark, folder).transform(clean.remove_duplicates, ORDER).select(
        *schema.FLIGHT_KEY, "arrival_delay_min", "distance_miles", "resent", "l_orderkey",
        "l_linenumber")


@query("valid_airports", """
SELECT route, COUNT(*) AS flights FROM f
WHERE regexp_matches(origin_airport, '^[A-Z]{3}$') AND regexp_matches(dest_airport, '^[A-Z]{3}$')
GROUP BY route""")
def valid_airports(spark, folder):
    return sample.flights(spark, folder).transform(clean.keep_valid_airports).groupBy(
        "route").agg(F.count("*").alias("flights"))


DERIVED = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("derive_flags", f"SELECT {DERIVED}, arrival_delay_min, is_delayed FROM f")
def derive_flags(spark, folder):
    return sample.flights(spark, folder).drop("is_delayed").transform(clean.derive_columns).select(
        *ID, "arrival_delay_min", "is_delayed")


@query("delay_category_counts", """
SELECT delay_category, COUNT(*) AS flights FROM f GROUP BY delay_category""")
def delay_category_counts(spark, folder):
    return sample.flights(spark, folder).drop("delay_category").transform(
        clean.derive_columns).groupBy("delay_category").agg(F.count("*").alias("flights"))


@query("derive_route", f"SELECT {DERIVED}, route FROM f")
def derive_route(spark, folder):
    return sample.flights(spark, folder).select(
        *ID, flight.route(F.concat(F.lit(" "), "origin_airport"),
                          F.concat("dest_airport", F.lit("  "))).alias("route"))


@query("derive_date_id", f"SELECT {DERIVED}, date_id FROM f")
def derive_date_id(spark, folder):
    return sample.flights(spark, folder).select(
        *ID, flight.date_id(F.col("flight_date")).alias("date_id"))


@query("clean_flights", f"""
SELECT {CLEAN_NAMES}, is_delayed, delay_category, route, date_id, l_orderkey, l_linenumber
FROM clean_rows""")
def clean_flights(spark, folder):
    return raw_known(spark, folder).transform(clean.clean_flights, ORDER).select(
        *CLEAN_LIST, "is_delayed", "delay_category", "route", "date_id", "l_orderkey",
        "l_linenumber")


@query("transform_stats", """
SELECT (SELECT COUNT(*) FROM rawt) AS rows_raw, (SELECT COUNT(*) FROM unique_rows) AS rows_after_dedup,
       COUNT(*) AS rows_valid, COUNT(*) FILTER (WHERE is_cancelled) AS cancelled_flights,
       COUNT(*) FILTER (WHERE is_diverted) AS diverted_flights,
       COUNT(*) FILTER (WHERE arrival_delay_min IS NULL) AS null_arrival_delay,
       (SELECT COUNT(*) FROM rawt) - COUNT(*) AS rows_rejected
FROM clean_rows""")
def transform_stats(spark, folder):
    return raw_known(spark, folder).transform(clean.clean_statistics, ORDER)


@query("hhmm_to_hour", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, scheduled_arrival,
       CASE WHEN scheduled_arrival BETWEEN 0 AND 2359 THEN CAST(scheduled_arrival // 100 AS INT) END AS scheduled_arrival_hour
FROM f""")
def hhmm_to_hour(spark, folder):
    return sample.flights(spark, folder).select(
        *ID, "scheduled_arrival",
        flight.clock_hour(F.col("scheduled_arrival")).alias("scheduled_arrival_hour"))


@query("partition_exists", """
SELECT COUNT(*) AS existing_rows FROM f WHERE "year" = 1998 AND "month" = 3""")
def partition_exists(spark, folder):
    stored = work_folder(spark, "months")
    wh.write_months(sample.flights(spark, folder).select("year", "month", "flight_date", "route"),
                    stored)
    return wh.rows_of_month(spark.read.parquet(stored), 1998, 3)


@query("period_target", raw_sql="""
SELECT o_orderkey, CAST(year(CAST(o_orderdate AS DATE) - 35) AS INT) AS target_year,
       CAST(month(CAST(o_orderdate AS DATE) - 35) AS INT) AS target_month
FROM orders""")
def period_target(spark, folder):
    year, month = flight.target_period(F.col("o_orderdate").cast("date"))
    return spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_orderkey", year.alias("target_year"), month.alias("target_month"))


# --- aggregates -----------------------------------------------------------------------------

@query("agg_count_filter", """
SELECT carrier_code, COUNT(*) AS flights, COUNT(*) FILTER (WHERE is_cancelled) AS cancelled,
       COUNT(*) FILTER (WHERE arrival_delay_min >= 60) AS hour_late,
       COUNT(*) FILTER (WHERE cancellation_code = 'B') AS weather_cancelled
FROM f GROUP BY carrier_code""")
def agg_count_filter(spark, folder):
    return sample.flights(spark, folder).groupBy("carrier_code").agg(
        F.count("*").alias("flights"),
        m.count_where(F.col("is_cancelled")).alias("cancelled"),
        m.count_where(F.col("arrival_delay_min") >= 60).alias("hour_late"),
        m.count_where(F.col("cancellation_code") == "B").alias("weather_cancelled"))


@query("agg_avg_filter", f"""
SELECT carrier_code, "year", {avg('arrival_delay_min', 'NOT is_cancelled')} AS avg_arrival_delay,
       {avg('weather_delay_min', 'weather_delay_min > 0')} AS avg_weather_delay
FROM f GROUP BY carrier_code, "year" """)
def agg_avg_filter(spark, folder):
    flown, rained = ~F.col("is_cancelled"), F.col("weather_delay_min") > 0
    return sample.flights(spark, folder).groupBy("carrier_code", "year").agg(
        m.mean(m.total_where(F.col("arrival_delay_min"), flown),
               m.present_where(F.col("arrival_delay_min"), flown)).alias("avg_arrival_delay"),
        m.mean(m.total_where(F.col("weather_delay_min"), rained),
               m.present_where(F.col("weather_delay_min"), rained)).alias("avg_weather_delay"))


@query("agg_guarded_pct", f"""
SELECT route, {pct("cancellation_code = 'B'", 'is_cancelled')} AS pct_weather,
       {pct('is_delayed', 'NOT is_cancelled')} AS pct_delayed
FROM f GROUP BY route""")
def agg_guarded_pct(spark, folder):
    return sample.flights(spark, folder).groupBy("route").agg(
        m.percent(m.count_where(F.col("cancellation_code") == "B"),
                  m.count_where(F.col("is_cancelled"))).alias("pct_weather"),
        m.percent(m.count_where(F.col("is_delayed")),
                  m.count_where(~F.col("is_cancelled"))).alias("pct_delayed"))


@query("agg_percentiles", f"""
SELECT route, {rnd('percentile_cont(0.5) WITHIN GROUP (ORDER BY arrival_delay_min)')} AS median_delay,
       {rnd('percentile_cont(0.9) WITHIN GROUP (ORDER BY arrival_delay_min)')} AS p90_delay
FROM f GROUP BY route""")
def agg_percentiles(spark, folder):
    return sample.flights(spark, folder).groupBy("route").agg(
        m.percentiles(F.col("arrival_delay_min"), [0.5, 0.9]).alias("delays"),
    ).select("route", m.rounded(F.col("delays")[0], 2).alias("median_delay"),
             m.rounded(F.col("delays")[1], 2).alias("p90_delay"))


@query("agg_count_distinct", """
SELECT carrier_code, COUNT(DISTINCT route) AS routes, COUNT(DISTINCT origin_airport) AS origins
FROM f GROUP BY carrier_code""")
def agg_count_distinct(spark, folder):
    pairs = sample.flights(spark, folder).select(
        "carrier_code", "route", "origin_airport").distinct()
    return pairs.groupBy("carrier_code").agg(
        F.count_distinct("route").alias("routes"),
        F.count_distinct("origin_airport").alias("origins"))


# --- data quality ---------------------------------------------------------------------------

def expected(name, kind, column, checked, good, threshold, details, extra="1 AS x", table="f",
             empty="0.0"):
    """SELECT giving one check row; `checked`, `good` and `extra` are aggregates over the table."""
    rate = f"COALESCE(CAST(ok AS DOUBLE) / NULLIF(n, 0), {empty})"
    return f"""
SELECT '{name}' AS check_name, '{kind}' AS check_type, '{column}' AS column_name, n AS rows_checked,
       n - ok AS rows_failed, {rnd(rate, 4)} AS pass_rate, CAST({threshold} AS DOUBLE) AS threshold,
       {rate} >= {threshold} AS passed, {details} AS details
FROM (SELECT CAST({checked} AS BIGINT) AS n, CAST({good} AS BIGINT) AS ok, {extra} FROM {table})"""


def expected_not_null(column, threshold, table="f"):
    return expected(
        f"not_null::{column}", "completeness", column, "COUNT(*)", f"COUNT({column})", threshold,
        """'{"not_null_count":' || ok || ',"null_count":' || (n - ok) || '}'""", table=table)


def expected_range(column, low, high, threshold, table="f"):
    return expected(
        f"value_range::{column}", "validity", column, f"COUNT({column})",
        f"COUNT(*) FILTER (WHERE {column} BETWEEN {low} AND {high})", threshold,
        f"""'{{"min_val":{float(low)},"max_val":{float(high)},"actual_min":' || lo || ',"actual_max":' || hi"""
        """ || ',"outlier_count":' || (n - ok) || '}'""",
        extra=f"MIN({column}) AS lo, MAX({column}) AS hi", table=table)


def expected_future(table="f"):
    return expected(
        "no_future_dates::flight_date", "validity", "flight_date", "COUNT(flight_date)",
        f"COUNT(*) FILTER (WHERE flight_date <= DATE '{AS_OF}')", 1.0,
        """'{"min_date":"' || lo || '","max_date":"' || hi || '"}'""",
        extra="MIN(flight_date) AS lo, MAX(flight_date) AS hi", table=table)


def expected_unique(table="f"):
    keys = ", ".join(schema.FLIGHT_KEY)
    name = "+".join(schema.FLIGHT_KEY)
    return expected(
        f"unique::{name}", "uniqueness", name, "COALESCE(SUM(copies), 0)", "COUNT(*)", 0.999,
        """'{"duplicate_count":' || (n - ok) || '}'""",
        table=f"(SELECT COUNT(*) AS copies FROM {table} GROUP BY {keys})")


def expected_consistency(threshold, table="f"):
    gap = f"abs({' + '.join(schema.DELAY_COMPONENTS)} - arrival_delay_min)"
    return expected(
        "delay_consistency", "consistency", "delay_components", "COUNT(gap)",
        "COUNT(*) FILTER (WHERE gap <= 5)", threshold,
        f"""'{{"mean_difference_min":' || {rnd('mean_gap')} || ',"max_difference_min":' || max_gap || '}}'""",
        extra="AVG(gap) AS mean_gap, MAX(gap) AS max_gap",
        table=f"(SELECT {gap} AS gap FROM {table})", empty="1.0")


SUITE = "\nUNION ALL\n".join([
    expected_not_null("flight_date", 1.0), expected_not_null("carrier_code", 1.0),
    expected_not_null("origin_airport", 1.0), expected_not_null("dest_airport", 1.0),
    expected_not_null("distance_miles", 0.99), expected_not_null("arrival_delay_min", 0.80),
    expected_range("distance_miles", 1, 6000, 0.99),
    expected_range("departure_delay_min", -120, 1500, 0.99),
    expected_range("arrival_delay_min", -120, 1500, 0.99),
    expected_future(), expected_unique(), expected_consistency(0.90),
])


@query("dq_not_null", expected_not_null("arrival_delay_min", 0.99))
def dq_not_null(spark, folder):
    return quality.evaluate(sample.flights(spark, folder), [quality.not_null("arrival_delay_min")])


@query("dq_value_range", expected_range("arrival_delay_min", -30, 200, 0.99))
def dq_value_range(spark, folder):
    return quality.evaluate(sample.flights(spark, folder),
                            [quality.value_range("arrival_delay_min", -30, 200)])


@query("dq_no_future", expected_future())
def dq_no_future(spark, folder):
    return quality.evaluate(sample.flights(spark, folder), [quality.no_future_dates(as_of=AS_OF)])


@query("dq_unique", expected_unique("arrivals"))
def dq_unique(spark, folder):
    return quality.check_unique(sample.arrivals(spark, folder), schema.FLIGHT_KEY)


@query("dq_delay_consistency", expected_consistency(0.95))
def dq_delay_consistency(spark, folder):
    flights = sample.flights(spark, folder)
    return quality.evaluate(flights, [quality.delay_consistency(flights.columns)])


OFFERED = ["AX", "BX", "CX", "DX", "EX"]
OFFERED_SQL = ", ".join(f"'{c}'" for c in OFFERED)
TOP_INVALID = f"""SELECT carrier_code AS "value", COUNT(*) AS occurrences FROM f
  WHERE carrier_code NOT IN ({OFFERED_SQL}) GROUP BY carrier_code
  ORDER BY occurrences DESC, "value" LIMIT 10"""


@query("dq_invalid_top10", TOP_INVALID)
def dq_invalid_top10(spark, folder):
    return quality.invalid_values(sample.flights(spark, folder), "carrier_code", OFFERED)


@query("dq_invalid_rare_values", """
SELECT CAST(l_orderkey AS VARCHAR) AS "value", COUNT(*) AS occurrences FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def dq_invalid_rare_values(spark, folder):
    """Values that hardly repeat: a number for every few rows, none of them allowed."""
    return quality.invalid_values(
        sample.flights(spark, folder).withColumn("reference", F.col("l_orderkey").cast("string")), "reference", [])


@query("dq_values_in_set", expected(
    "values_in_set::carrier_code", "validity", "carrier_code", "COUNT(*)",
    f"COUNT(*) FILTER (WHERE carrier_code IN ({OFFERED_SQL}))", 0.99,
    f"""'{{"invalid_top10":[' || (SELECT string_agg('{{"value":"' || "value" || '","n":' || occurrences || '}}', ','
      ORDER BY occurrences DESC, "value") FROM ({TOP_INVALID})) || ']}}'"""))
def dq_values_in_set(spark, folder):
    return quality.check_values_in_set(sample.flights(spark, folder), "carrier_code", OFFERED)


@query("dq_cancellation_codes", expected(
    "values_in_set::cancellation_code", "validity", "cancellation_code", "COUNT(*)",
    "COUNT(*) FILTER (WHERE cancellation_code IS NULL OR cancellation_code IN ('A', 'B', 'C', 'D'))",
    0.99, """'{"invalid_top10":[]}'"""))
def dq_cancellation_codes(spark, folder):
    return quality.check_values_in_set(sample.flights(spark, folder), "cancellation_code",
                                       schema.CANCELLATION_CODES)


@query("dq_ref_integrity", expected(
    "referential_integrity::dest_airport", "consistency", "dest_airport", "COUNT(*)",
    "COUNT(*) FILTER (WHERE dest_airport IN (SELECT iata_code FROM airports))", 0.99,
    """'{"invalid_values_sample":["' || (SELECT string_agg(DISTINCT dest_airport, '","' ORDER BY dest_airport) FROM f
      WHERE dest_airport NOT IN (SELECT iata_code FROM airports)) || '"]}'"""))
def dq_ref_integrity(spark, folder):
    return quality.check_referential_integrity(
        sample.flights(spark, folder), "dest_airport", sample.airports(spark, folder), "iata_code")


@query("dq_suite", SUITE)
def dq_suite(spark, folder):
    return quality.run_all_checks(sample.flights(spark, folder), AS_OF)


@query("dq_report", f"""
SELECT check_name, printf('[%s] %-45s %.1f%% (threshold: %.0f%%)', CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END,
       check_name, pass_rate * 100, threshold * 100) AS line
FROM ({SUITE})
UNION ALL SELECT 'Result', printf('Result: %d/%d checks passed', COUNT(*) FILTER (WHERE passed), COUNT(*)) FROM ({SUITE})""")
def dq_report(spark, folder):
    results = work_folder(spark, "checks")
    quality.run_all_checks(sample.flights(spark, folder), AS_OF).write.parquet(results)
    return quality.report_lines(spark.read.parquet(results))


@query("dq_results_table", f"""
SELECT 7 AS run_id, check_name, check_type, 'fact_flights' AS table_name, column_name, rows_checked, rows_failed,
       pass_rate, threshold, passed, details FROM ({SUITE})""")
def dq_results_table(spark, folder):
    stored = wh.Warehouse(spark, work_folder(spark, "audit"))
    results = quality.run_all_checks(sample.flights(spark, folder), AS_OF)
    stored.append(load.quality_rows(results, 7), "data_quality_results")
    return stored.read("data_quality_results").drop("checked_at").withColumn(
        "run_id", F.col("run_id").cast("int"))


# --- dimensions -----------------------------------------------------------------------------

def dense_ids(codes, key, id_column, start):
    """SQL giving ids above `start` in (hash bucket, key) order."""
    return (f"SELECT {key}, {start} + row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key}) AS {id_column}"
            f" FROM ({codes})")


CARRIER_IDS = dense_ids("SELECT carrier_code FROM carriers", "carrier_code", "carrier_id", 0)
AIRPORT_IDS = dense_ids("SELECT iata_code FROM airports", "iata_code", "airport_id", 0)
BOTH_ENDS = "SELECT origin_airport AS iata_code FROM f UNION SELECT dest_airport FROM f"


@query("dim_carrier_codes", "SELECT DISTINCT carrier_code FROM f")
def dim_carrier_codes(spark, folder):
    return dimensions.carrier_codes(sample.flights(spark, folder))


@query("dim_airport_codes", BOTH_ENDS)
def dim_airport_codes(spark, folder):
    return dimensions.airport_codes(sample.flights(spark, folder))


@query("dim_carrier_new_rows", """
SELECT DISTINCT carrier_code FROM f WHERE carrier_code NOT IN (SELECT carrier_code FROM carriers)""")
def dim_carrier_new_rows(spark, folder):
    return dimensions.unseen(dimensions.carrier_codes(sample.flights(spark, folder)),
                             sample.carriers(spark, folder), "carrier_code")


@query("dim_airport_new_rows", f"""
SELECT iata_code FROM ({BOTH_ENDS}) WHERE iata_code NOT IN (SELECT iata_code FROM airports)""")
def dim_airport_new_rows(spark, folder):
    return dimensions.unseen(dimensions.airport_codes(sample.flights(spark, folder)),
                             sample.airports(spark, folder), "iata_code")


@query("dim_ids", dense_ids("SELECT DISTINCT route FROM f", "route", "route_id", 100))
def dim_ids(spark, folder):
    routes = sample.flights(spark, folder).select("route").distinct()
    return dimensions.number_rows(routes, "route", "route_id", 100)


def _upserted(spark, folder, table):
    """The dimension table after two loads of the same flights onto the sample dimension."""
    store = wh.Warehouse(spark, work_folder(spark, "dimensions"))
    seed = {"dim_carriers": sample.numbered_carriers, "dim_airports": sample.numbered_airports}
    target = {"dim_carriers": schema.DIM_CARRIER, "dim_airports": schema.DIM_AIRPORT}
    for name, build in seed.items():
        rows = build(spark, folder)
        store.append(rows.select([
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target[name].fields
        ]), name)
    flights = sample.flights(spark, folder)
    for _ in range(2):
        load.upsert_dimensions(store, flights)
    return store.read(table, target[table])


@query("dim_carrier_upsert", f"""
SELECT carrier_code, carrier_id, carrier_name, CAST(NULL AS BOOLEAN) AS is_active FROM carriers JOIN ({CARRIER_IDS}) USING (carrier_code)
UNION ALL SELECT carrier_code, carrier_id, NULL, TRUE FROM (""" + dense_ids(
    "SELECT DISTINCT carrier_code FROM f WHERE carrier_code NOT IN (SELECT carrier_code FROM carriers)",
    "carrier_code", "carrier_id", "(SELECT COUNT(*) FROM carriers)") + ")")
def dim_carrier_upsert(spark, folder):
    return _upserted(spark, folder, "dim_carriers").select(
        "carrier_code", "carrier_id", "carrier_name", "is_active")


@query("dim_airport_upsert", f"""
SELECT iata_code, airport_id, airport_name, CAST(NULL AS VARCHAR) AS country_code FROM airports JOIN ({AIRPORT_IDS}) USING (iata_code)
UNION ALL SELECT iata_code, airport_id, NULL, 'US' FROM (""" + dense_ids(
    f"SELECT iata_code FROM ({BOTH_ENDS}) WHERE iata_code NOT IN (SELECT iata_code FROM airports)",
    "iata_code", "airport_id", "(SELECT COUNT(*) FROM airports)") + ")")
def dim_airport_upsert(spark, folder):
    return _upserted(spark, folder, "dim_airports").select(
        "iata_code", "airport_id", "airport_name", "country_code")


ENRICHED_SQL = """
SELECT iata_code, CASE WHEN n_nationkey IS NULL THEN airport_name ELSE COALESCE(ref_name, airport_name) END AS airport_name,
       city, CASE WHEN n_nationkey IS NULL THEN NULL ELSE 'US' END AS country_code,
       CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS DOUBLE) END AS latitude
FROM airports LEFT JOIN (
  SELECT s_nationkey AS n_nationkey, 'O' || chr(65 + s_nationkey) || 'Z' AS iata_code,
         MAX(s_name) AS ref_name FROM supplier GROUP BY s_nationkey) USING (iata_code)"""


def airport_reference(spark, folder):
    return spark.read.parquet(f"{folder}/supplier.parquet").select(
        F.expr("'O' || chr(65 + s_nationkey) || 'Z'").alias("iata_code"),
        F.col("s_name").alias("airport_name"),
        F.lit("").alias("city"),
        F.lit("US").alias("country_code"),
        F.when(F.col("s_nationkey") % 2 == 0, F.col("s_nationkey")).cast("decimal(9,6)")
        .alias("latitude"),
    )


@query("dim_airport_enriched", ENRICHED_SQL)
def dim_airport_enriched(spark, folder):
    reference = airport_reference(spark, folder)
    rows = sample.airports(spark, folder).withColumns({
        "country_code": F.lit(None).cast("string"),
        "latitude": F.lit(None).cast("decimal(9,6)"),
        "updated_at": F.lit(None).cast("timestamp"),
    })
    return dimensions.enrich(
        rows, reference, "iata_code", ["airport_name", "city", "country_code", "latitude"],
    ).select("iata_code", "airport_name", "city", "country_code", "latitude")


@query("dim_airport_enrich_stored", ENRICHED_SQL)
def dim_airport_enrich_stored(spark, folder):
    """The stored dimension, read back after two runs of the enrichment."""
    store = wh.Warehouse(spark, work_folder(spark, "warehouse"))
    known = sample.numbered_airports(spark, folder)
    store.append(known.select([
        (F.col(f.name) if f.name in known.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.DIM_AIRPORT]), "dim_airports")
    reference = airport_reference(spark, folder).withColumns({
        c: F.lit(None).cast("double") for c in ("longitude", "utc_offset_hrs")})
    for _ in range(2):
        load.enrich_dimensions(store, reference)
    return store.airports().select("iata_code", "airport_name", "city", "country_code", "latitude")


@query("fact_with_keys", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, carrier_code, carrier_id,
       o.airport_id AS origin_airport_id, d.airport_id AS dest_airport_id
FROM f LEFT JOIN ({CARRIER_IDS}) USING (carrier_code)
LEFT JOIN ({AIRPORT_IDS}) o ON o.iata_code = origin_airport
LEFT JOIN ({AIRPORT_IDS}) d ON d.iata_code = dest_airport""")
def fact_with_keys(spark, folder):
    return sample.flights(spark, folder).transform(
        dimensions.with_dimension_keys, sample.numbered_carriers(spark, folder),
        sample.numbered_airports(spark, folder),
    ).select(*ID, "carrier_code", "carrier_id", "origin_airport_id", "dest_airport_id")


YEARS_SQL = """, days AS (
  SELECT d FROM (SELECT unnest(generate_series(CAST(date_trunc('year', MIN(flight_date)) AS TIMESTAMP),
    CAST(date_trunc('year', MAX(flight_date)) AS TIMESTAMP) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM f))"""
CALENDAR_SQL = "SELECT * FROM (" + CALENDAR + " FROM days)"


@query("dim_date", raw_sql=with_flights("").rstrip() + YEARS_SQL + CALENDAR_SQL)
def dim_date(spark, folder):
    return dimensions.calendar(dimensions.days_between(sample.calendar_bounds(spark, folder)))


@query("dim_date_holidays", raw_sql=with_flights("").rstrip() + YEARS_SQL + f"""
SELECT date_id, holiday_name IS NOT NULL AS is_holiday, holiday_name FROM (
  SELECT date_id, CASE WHEN "month" = 1 AND day_of_month = 1 THEN 'New Year''s Day'
    WHEN "month" = 7 AND day_of_month = 4 THEN 'Independence Day'
    WHEN "month" = 12 AND day_of_month = 25 THEN 'Christmas Day'
    WHEN "month" = 12 AND day_of_month = 24 THEN 'Christmas Eve'
    WHEN "month" = 12 AND day_of_month = 31 THEN 'New Year''s Eve' END AS holiday_name
  FROM ({CALENDAR_SQL}))""")
def dim_date_holidays(spark, folder):
    days = dimensions.days_between(sample.calendar_bounds(spark, folder))
    return dimensions.mark_holidays(dimensions.calendar(days)).select(
        "date_id", "is_holiday", "holiday_name")
