"""Pieces of DuckDB SQL shared by the expected results."""

CTE = """
f0 AS (
  SELECT CAST(l_shipdate AS DATE) AS flight_date,
         chr(CAST(65 + l_suppkey % 18 AS INT)) || 'X' AS carrier_code,
         CAST(1 + l_orderkey % 4000 AS VARCHAR) AS flight_number,
         'O' || chr(CAST(65 + l_partkey % 25 AS INT)) || 'Z' AS origin_airport,
         CASE WHEN l_orderkey % 97 = 0 THEN '12Z'
              ELSE 'O' || chr(CAST(65 + (l_orderkey * 7 + l_linenumber * 3) % 25 AS INT)) || 'Z' END AS dest_airport,
         CAST(((l_orderkey * 5) % 24) * 100 + l_partkey % 60 AS INT) AS scheduled_departure,
         CASE WHEN l_orderkey % 53 <> 0 THEN CAST(((l_orderkey * 5 + 1) % 24) * 100 + l_partkey % 60 AS INT) END AS actual_departure,
         CAST(((l_orderkey * 7 + 3) % 25) * 100 + l_partkey % 60 AS INT) AS scheduled_arrival,
         CASE WHEN l_orderkey % 53 <> 0 AND l_orderkey % 211 <> 0
              THEN CAST(((l_orderkey * 7 + 4) % 24) * 100 + l_partkey % 60 AS INT) END AS actual_arrival,
         CASE WHEN l_orderkey % 53 <> 0 THEN CAST((l_orderkey * 11 + l_partkey * 3) % 200 - 30 AS DOUBLE) END AS departure_delay_min,
         CASE WHEN l_orderkey % 53 <> 0 AND l_orderkey % 211 <> 0
              THEN CAST((l_orderkey * 7 + l_partkey * 13 + l_linenumber * 31) % 260 - 40 AS DOUBLE) END AS arrival_delay_min,
         l_orderkey % 53 = 0 AS is_cancelled,
         CASE WHEN l_orderkey % 53 = 0 THEN substr('ABCD', CAST(1 + l_partkey % 4 AS INT), 1) END AS cancellation_code,
         l_orderkey % 211 = 0 AS is_diverted,
         CAST(60 + l_partkey % 240 AS DOUBLE) AS scheduled_duration_min,
         CASE WHEN l_orderkey % 53 <> 0 AND l_orderkey % 211 <> 0 THEN CAST(70 + l_partkey % 240 AS DOUBLE) END AS actual_duration_min,
         CASE WHEN l_orderkey % 53 <> 0 AND l_orderkey % 211 <> 0 THEN CAST(50 + l_partkey % 240 AS DOUBLE) END AS air_time_min,
         CAST(100 + ((l_partkey % 25) * 37 + ((l_orderkey * 7 + l_linenumber * 3) % 25) * 91) % 2500 AS DOUBLE) AS distance_miles,
         CAST(EXTRACT(YEAR FROM l_shipdate) AS INT) AS "year",
         CAST(EXTRACT(MONTH FROM l_shipdate) AS INT) AS "month",
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag
  FROM lineitem),
sent AS (
  SELECT f0.*, 0 AS resent FROM f0
  UNION ALL SELECT f0.* REPLACE (arrival_delay_min + 1 AS arrival_delay_min), 1 AS resent FROM f0 WHERE l_returnflag = 'R'),
causes AS (
  SELECT *, arrival_delay_min - resent AS first_delay FROM sent),
arrivals AS (
  SELECT * EXCLUDE (first_delay),
    CASE WHEN first_delay >= 15 THEN CASE l_partkey % 5 WHEN 0 THEN first_delay WHEN 1 THEN first_delay - 10 ELSE 0 END END AS carrier_delay_min,
    CASE WHEN first_delay >= 15 THEN CASE l_partkey % 5 WHEN 1 THEN 10 WHEN 2 THEN first_delay ELSE 0 END END AS weather_delay_min,
    CASE WHEN first_delay >= 15 THEN CASE l_partkey % 5 WHEN 3 THEN first_delay ELSE 0 END END AS nas_delay_min,
    CASE WHEN first_delay >= 15 THEN CASE l_partkey % 100 WHEN 4 THEN CAST(5 AS DOUBLE) ELSE 0 END END AS security_delay_min,
    CASE WHEN first_delay >= 15 THEN
      CASE l_partkey % 5 WHEN 4 THEN first_delay - CASE l_partkey % 100 WHEN 4 THEN 5 ELSE 0 END ELSE 0 END
      + CASE WHEN l_linenumber = 7 AND l_partkey % 2 = 0 THEN 8 ELSE 0 END END AS late_aircraft_delay_min
  FROM causes),
f AS (
  SELECT * EXCLUDE (resent, l_returnflag),
         arrival_delay_min IS NOT NULL AND arrival_delay_min >= 15 AS is_delayed,
         {category} AS delay_category,
         origin_airport || '-' || dest_airport AS route,
         CAST(strftime(flight_date, '%Y%m%d') AS INT) AS date_id
  FROM arrivals WHERE resent = 0),
carriers AS (
  SELECT DISTINCT chr(CAST(65 + s_suppkey % 18 AS INT)) || 'X' AS carrier_code,
         'Carrier ' || chr(CAST(65 + s_suppkey % 18 AS INT)) || 'X' AS carrier_name
  FROM supplier WHERE s_suppkey % 18 <> 17),
airports AS (
  SELECT 'O' || chr(65 + n_nationkey) || 'Z' AS iata_code, n_name AS airport_name, n_name AS city,
         'R' || CAST(n_regionkey AS VARCHAR) AS state_code
  FROM nation WHERE n_nationkey <> 24),
dim_date AS ({calendar}
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2000-12-31', INTERVAL 1 DAY) AS g(d)),
rawt AS (
  SELECT CASE WHEN l_partkey % 41 = 0 THEN 'not-a-date' ELSE CAST(flight_date AS VARCHAR) END AS "FlightDate",
         carrier_code AS "IATA_CODE_Reporting_Airline",
         lpad(flight_number, 4, '0') AS "Flight_Number_Reporting_Airline",
         origin_airport AS "Origin", dest_airport AS "Dest",
         lpad(CAST(scheduled_departure AS VARCHAR), 4, '0') AS "CRSDepTime",
         lpad(CAST(actual_departure AS VARCHAR), 4, '0') AS "DepTime",
         CASE WHEN l_partkey % 37 = 0 THEN 'late' ELSE CAST(CAST(departure_delay_min AS INT) AS VARCHAR) || '.00' END AS "DepDelay",
         CASE WHEN l_partkey % 71 = 0 THEN 'n/a' ELSE lpad(CAST(scheduled_arrival AS VARCHAR), 4, '0') END AS "CRSArrTime",
         lpad(CAST(actual_arrival AS VARCHAR), 4, '0') AS "ArrTime",
         CASE WHEN l_partkey % 43 = 0 THEN 'NA' WHEN l_partkey % 47 = 0 THEN ' '
              ELSE CAST(CAST(arrival_delay_min AS INT) AS VARCHAR) || '.00' END AS "ArrDelay",
         CASE WHEN l_partkey % 61 = 0 THEN '.' WHEN is_cancelled THEN '1.00' ELSE '0.00' END AS "Cancelled",
         CASE WHEN l_partkey % 59 = 0 THEN 'True' WHEN is_diverted THEN '1.00' ELSE '0.00' END AS "Diverted",
         cancellation_code AS "CancellationCode",
         CASE WHEN l_partkey % 67 = 0 THEN 'NaN' ELSE CAST(CAST(distance_miles AS INT) AS VARCHAR) || '.00' END AS "Distance",
         CAST("year" AS VARCHAR) AS "Year", CAST("month" AS VARCHAR) || '.0' AS "Month",
         CAST(EXTRACT(DAY FROM flight_date) AS VARCHAR) AS "DayofMonth",
         CAST(isodow(flight_date) AS VARCHAR) AS "DayOfWeek",
         "year" AS y, "month" AS m, * EXCLUDE (l_returnflag, "year", "month")
  FROM arrivals),
cast_rows AS (
  SELECT TRY_CAST("FlightDate" AS DATE) AS flight_date, carrier_code, flight_number, origin_airport, dest_airport,
         scheduled_departure, actual_departure,
         CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE scheduled_arrival END AS scheduled_arrival, actual_arrival,
         TRY_CAST("DepDelay" AS DOUBLE) AS departure_delay_min, TRY_CAST("ArrDelay" AS DOUBLE) AS arrival_delay_min,
         carrier_delay_min, weather_delay_min, nas_delay_min, security_delay_min, late_aircraft_delay_min,
         COALESCE(TRY_CAST("Cancelled" AS DOUBLE) <> 0, FALSE) AS is_cancelled, cancellation_code,
         COALESCE(TRY_CAST("Diverted" AS DOUBLE) <> 0, FALSE) AS is_diverted,
         scheduled_duration_min, actual_duration_min, air_time_min,
         CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE TRY_CAST("Distance" AS DOUBLE) END AS distance_miles,
         y AS "year", m AS "month", CAST("DayofMonth" AS INT) AS day_of_month, CAST("DayOfWeek" AS INT) AS day_of_week,
         resent, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM rawt),
unique_rows AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_date, carrier_code, flight_number, origin_airport, dest_airport
      ORDER BY resent DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM cast_rows)
  WHERE rn = 1),
clean_rows AS (
  SELECT *, arrival_delay_min IS NOT NULL AND arrival_delay_min >= 15 AS is_delayed,
         {category} AS delay_category, origin_airport || '-' || dest_airport AS route,
         CAST(strftime(flight_date, '%Y%m%d') AS INT) AS date_id
  FROM unique_rows
  WHERE regexp_matches(origin_airport, '^[A-Z]{{3}}$') AND regexp_matches(dest_airport, '^[A-Z]{{3}}$'))
"""

CATEGORY = (
    "CASE WHEN is_cancelled THEN 'Cancelled' WHEN arrival_delay_min IS NULL THEN 'Unknown'"
    " WHEN arrival_delay_min < 0 THEN 'Early' WHEN arrival_delay_min < 15 THEN 'On Time'"
    " WHEN arrival_delay_min < 60 THEN 'Minor Delay' WHEN arrival_delay_min < 180 THEN 'Major Delay'"
    " ELSE 'Severe Delay' END"
)

CALENDAR = """
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS INT) AS "year", CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS "month",
         monthname(d) AS month_name, CAST(weekofyear(d) AS INT) AS week_of_year,
         CAST(day(d) AS INT) AS day_of_month, CAST(isodow(d) AS INT) AS day_of_week,
         dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend,
         CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
              WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
"""


def with_flights(select):
    """A statement over the derived flights, dimensions, raw text and cleaned rows."""
    return "WITH " + CTE.format(category=CATEGORY, calendar=CALENDAR) + "\n" + select


def rnd(expression, digits=2):
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,12)), {digits}) AS DOUBLE)"


def avg(column, condition="TRUE", digits=2):
    return rnd(f"AVG({column}) FILTER (WHERE {condition})", digits)


def pct(part, whole, digits=2):
    """Percent of two counts, given as filter conditions."""
    return rnd(
        f"100.0::DOUBLE * COUNT(*) FILTER (WHERE {part}) / NULLIF(COUNT(*) FILTER (WHERE {whole}), 0)",
        digits,
    )
