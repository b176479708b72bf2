"""Queries for summary tables and reports."""

from pyspark.sql import functions as F

from tarmac.plans import reports, summaries
from tarmac.sources import sample_flights as sample
from verification.registry import query
from verification.sql_text import avg, pct, rnd

YEAR = 1998
MIN_ROUTE_FLIGHTS = 10
MIN_HUB_DEPARTURES = 100

DELAYED = "is_delayed AND NOT is_cancelled"
FLOWN = "NOT is_cancelled"

MONTHLY_SQL = f"""
SELECT f."year", f."month", d.month_name, d.season, carrier_code, COUNT(*) AS total_flights,
       COUNT(*) FILTER (WHERE is_cancelled) AS cancelled_count,
       COUNT(*) FILTER (WHERE {DELAYED}) AS delayed_count,
       COUNT(*) FILTER (WHERE NOT is_delayed AND NOT is_cancelled) AS ontime_count,
       {avg('arrival_delay_min', FLOWN)} AS avg_arrival_delay,
       {avg('departure_delay_min', FLOWN)} AS avg_departure_delay,
       {pct(DELAYED, FLOWN)} AS delayed_rate_pct,
       {pct('NOT is_delayed AND NOT is_cancelled', FLOWN)} AS ontime_rate_pct,
       {avg('distance_miles')} AS avg_distance_miles
FROM f JOIN dim_date d USING (date_id)
GROUP BY f."year", f."month", d.month_name, d.season, carrier_code"""

CARRIER_SQL = f"""
SELECT carrier_code, carrier_name, "year", COUNT(*) AS total_flights,
       {pct('NOT is_delayed AND NOT is_cancelled', FLOWN)} AS ontime_pct,
       {avg('arrival_delay_min', FLOWN)} AS avg_delay_min,
       {pct('is_cancelled', 'TRUE')} AS cancellation_pct,
       COUNT(DISTINCT route) AS routes_served, COUNT(DISTINCT origin_airport) AS airports_served
FROM f LEFT JOIN carriers USING (carrier_code)
GROUP BY carrier_code, carrier_name, "year" """

ROUTE_SQL = f"""
SELECT route, origin_airport, dest_airport, oa.city AS origin_city, oa.state_code AS origin_state,
       da.city AS dest_city, da.state_code AS dest_state, "year", COUNT(*) AS total_flights,
       {avg('arrival_delay_min', FLOWN)} AS avg_delay_min,
       {rnd('percentile_cont(0.5) WITHIN GROUP (ORDER BY arrival_delay_min)')} AS median_delay_min,
       {rnd('percentile_cont(0.9) WITHIN GROUP (ORDER BY arrival_delay_min)')} AS p90_delay_min,
       {avg('distance_miles', digits=0)} AS avg_distance_miles,
       COUNT(DISTINCT carrier_code) AS carrier_count
FROM f LEFT JOIN airports oa ON oa.iata_code = origin_airport
LEFT JOIN airports da ON da.iata_code = dest_airport
GROUP BY route, origin_airport, dest_airport, oa.city, oa.state_code, da.city, da.state_code, "year"
HAVING COUNT(*) >= {MIN_ROUTE_FLIGHTS}"""


@query("mv_monthly_summary", MONTHLY_SQL)
def mv_monthly_summary(spark, folder):
    return summaries.monthly_summary(sample.flights(spark, folder), sample.dim_date(spark))


@query("mv_carrier_performance", CARRIER_SQL)
def mv_carrier_performance(spark, folder):
    return summaries.carrier_performance(sample.flights(spark, folder),
                                         sample.carriers(spark, folder))


@query("mv_route_analysis", ROUTE_SQL)
def mv_route_analysis(spark, folder):
    return summaries.route_analysis(sample.flights(spark, folder), sample.airports(spark, folder),
                                    MIN_ROUTE_FLIGHTS)


@query("rep_carrier_ranking", f"""
SELECT carrier_code, carrier_name, COUNT(*) AS total_flights,
       COUNT(*) FILTER (WHERE is_cancelled) AS cancelled_flights,
       {avg('arrival_delay_min', FLOWN)} AS avg_arrival_delay_min,
       {pct(DELAYED, FLOWN)} AS pct_delayed, {pct('is_cancelled', 'TRUE')} AS pct_cancelled,
       {avg('weather_delay_min', 'weather_delay_min > 0')} AS avg_weather_delay,
       {avg('carrier_delay_min', 'carrier_delay_min > 0')} AS avg_carrier_delay
FROM f LEFT JOIN carriers USING (carrier_code) WHERE "year" = {YEAR}
GROUP BY carrier_code, carrier_name ORDER BY pct_delayed NULLS LAST, carrier_code""")
def rep_carrier_ranking(spark, folder):
    return reports.carrier_ranking(sample.flights(spark, folder, YEAR),
                                   sample.carriers(spark, folder), YEAR)


@query("rep_monthly_trend", f"""
SELECT f."year", f."month", month_name, COUNT(*) AS total_flights,
       {avg('arrival_delay_min', FLOWN)} AS avg_delay_min, {pct('is_delayed', FLOWN)} AS pct_delayed,
       COUNT(*) FILTER (WHERE cancellation_code = 'B') AS weather_cancellations,
       COUNT(*) FILTER (WHERE cancellation_code = 'A') AS carrier_cancellations
FROM f JOIN dim_date d USING (date_id)
GROUP BY f."year", f."month", month_name ORDER BY 1, 2""")
def rep_monthly_trend(spark, folder):
    return reports.monthly_trend(sample.flights(spark, folder), sample.dim_date(spark))


@query("rep_worst_routes", f"""
SELECT route, origin_airport, dest_airport, oa.city AS origin_city, da.city AS dest_city,
       COUNT(*) AS total_flights, {avg('arrival_delay_min')} AS avg_delay_min,
       {rnd('percentile_cont(0.9) WITHIN GROUP (ORDER BY arrival_delay_min)')} AS p90_delay_min,
       {pct('is_delayed', 'TRUE')} AS pct_delayed
FROM f LEFT JOIN airports oa ON oa.iata_code = origin_airport
LEFT JOIN airports da ON da.iata_code = dest_airport
WHERE "year" = {YEAR} AND NOT is_cancelled
GROUP BY route, origin_airport, dest_airport, oa.city, da.city
HAVING COUNT(*) >= {MIN_ROUTE_FLIGHTS} ORDER BY avg_delay_min DESC NULLS FIRST, route LIMIT 20""")
def rep_worst_routes(spark, folder):
    return reports.worst_routes(sample.flights(spark, folder, YEAR),
                                sample.airports(spark, folder), YEAR, MIN_ROUTE_FLIGHTS)


@query("rep_day_of_week", f"""
SELECT day_of_week, day_name, COUNT(*) AS total_flights,
       {avg('departure_delay_min', FLOWN)} AS avg_dep_delay_min,
       {avg('arrival_delay_min', FLOWN)} AS avg_arr_delay_min, {pct('is_delayed', FLOWN)} AS pct_delayed
FROM f JOIN dim_date d USING (date_id) WHERE f."year" = {YEAR}
GROUP BY day_of_week, day_name ORDER BY day_of_week""")
def rep_day_of_week(spark, folder):
    return reports.day_of_week(sample.flights(spark, folder, YEAR), sample.dim_date(spark), YEAR)


def _nonzero_avg(column):
    return rnd(f"AVG(NULLIF({column}, 0))")


@query("rep_delay_causes", f"""
SELECT carrier_code, {_nonzero_avg('carrier_delay_min')} AS avg_carrier_delay,
       {_nonzero_avg('weather_delay_min')} AS avg_weather_delay, {_nonzero_avg('nas_delay_min')} AS avg_nas_delay,
       {_nonzero_avg('security_delay_min')} AS avg_security_delay,
       {_nonzero_avg('late_aircraft_delay_min')} AS avg_late_aircraft_delay,
       {rnd('''100.0::DOUBLE * SUM(COALESCE(carrier_delay_min, 0)) / NULLIF(SUM(COALESCE(carrier_delay_min, 0)
         + COALESCE(weather_delay_min, 0) + COALESCE(nas_delay_min, 0) + COALESCE(late_aircraft_delay_min, 0)), 0)''', 1)}
         AS pct_carrier_caused
FROM f WHERE "year" = {YEAR} AND arrival_delay_min >= 15
GROUP BY carrier_code ORDER BY avg_carrier_delay DESC NULLS FIRST, carrier_code""")
def rep_delay_causes(spark, folder):
    return reports.delay_causes(sample.flights(spark, folder, YEAR), YEAR)


@query("rep_running_delay", f"""
SELECT "year", "month", carrier_code, COUNT(*) AS monthly_flights, {avg('arrival_delay_min')} AS avg_delay,
       {rnd('''AVG(AVG(arrival_delay_min)) OVER (PARTITION BY carrier_code ORDER BY "year", "month"
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''')} AS cumulative_avg_delay,
       CAST(RANK() OVER (PARTITION BY "year", "month" ORDER BY AVG(arrival_delay_min) ASC NULLS LAST) AS BIGINT) AS monthly_rank
FROM f WHERE NOT is_cancelled GROUP BY "year", "month", carrier_code
ORDER BY "year", "month", monthly_rank, carrier_code""")
def rep_running_delay(spark, folder):
    return reports.running_delay(sample.flights(spark, folder))


@query("rep_hubs", f"""
SELECT origin_airport AS airport, airport_name, city, state_code, COUNT(*) AS total_departures,
       {avg('departure_delay_min', FLOWN)} AS avg_dep_delay, {pct('is_cancelled', 'TRUE')} AS cancellation_rate_pct,
       COUNT(DISTINCT carrier_code) AS carrier_count
FROM f LEFT JOIN airports ON iata_code = origin_airport WHERE "year" = {YEAR}
GROUP BY origin_airport, airport_name, city, state_code HAVING COUNT(*) >= {MIN_HUB_DEPARTURES}
ORDER BY total_departures DESC, airport LIMIT 25""")
def rep_hubs(spark, folder):
    return reports.hubs(sample.flights(spark, folder, YEAR), sample.airports(spark, folder), YEAR,
                        MIN_HUB_DEPARTURES)


@query("v_run_health", raw_sql=f"""
SELECT o_orderkey AS run_id, CAST(year(o_orderdate) AS INT) AS "year", CAST(month(o_orderdate) AS INT) AS "month",
       CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'success' END AS status,
       o_orderkey % 7 * 1000 AS rows_extracted, o_orderkey % 7 * 1000 - o_orderkey % 7 * (o_custkey % 30) AS rows_loaded,
       o_orderkey % 7 * (o_custkey % 30) AS rows_rejected,
       {rnd('100.0::DOUBLE * (o_orderkey % 7 * (o_custkey % 30)) / NULLIF(o_orderkey % 7 * 1000, 0)')} AS rejection_rate_pct,
       CAST((o_custkey % 5000) / 10 AS DOUBLE) AS duration_sec, CAST(o_orderdate AS DATE) AS started_on,
       CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 7 > 0 AND o_custkey % 30 < 10 THEN 'healthy'
            WHEN o_orderstatus <> 'F' THEN 'warning' ELSE 'failed' END AS health_status
FROM orders""")
def v_run_health(spark, folder):
    """Orders stand in for runs."""
    thousands = F.col("o_orderkey") % 7
    rejected = thousands * (F.col("o_custkey") % 30)
    runs = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("run_id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("status"),
        (thousands * 1000).alias("rows_extracted"),
        (thousands * 1000 - rejected).alias("rows_loaded"),
        rejected.alias("rows_rejected"),
        ((F.col("o_custkey") % 5000) / 10).cast("decimal(10,2)").alias("duration_sec"),
        F.col("o_orderdate").alias("started_at"),
    )
    health = summaries.run_health(runs)
    return health.withColumn("started_on", F.col("started_at").cast("date")).drop("started_at")
