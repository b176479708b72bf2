"""Column names, types and fixed domain values of the flight warehouse."""

from pyspark.sql import types as T

# --- fixed values: raw monthly file column -> warehouse column -------------------------------
RAW_TO_CANONICAL = {
    "FlightDate": "flight_date",
    "IATA_CODE_Reporting_Airline": "carrier_code",
    "Flight_Number_Reporting_Airline": "flight_number",
    "Origin": "origin_airport",
    "Dest": "dest_airport",
    "CRSDepTime": "scheduled_departure",
    "DepTime": "actual_departure",
    "DepDelay": "departure_delay_min",
    "CRSArrTime": "scheduled_arrival",
    "ArrTime": "actual_arrival",
    "ArrDelay": "arrival_delay_min",
    "Cancelled": "is_cancelled",
    "CancellationCode": "cancellation_code",
    "Diverted": "is_diverted",
    "CRSElapsedTime": "scheduled_duration_min",
    "ActualElapsedTime": "actual_duration_min",
    "AirTime": "air_time_min",
    "Distance": "distance_miles",
    "CarrierDelay": "carrier_delay_min",
    "WeatherDelay": "weather_delay_min",
    "NASDelay": "nas_delay_min",
    "SecurityDelay": "security_delay_min",
    "LateAircraftDelay": "late_aircraft_delay_min",
    "Year": "year",
    "Month": "month",
    "DayofMonth": "day_of_month",
    "DayOfWeek": "day_of_week",
}

# --- fixed values: columns a raw file must carry ----------------------------------------------
REQUIRED_RAW_COLUMNS = [
    "FlightDate",
    "IATA_CODE_Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "Origin",
    "Dest",
    "DepDelay",
    "ArrDelay",
    "Cancelled",
    "Distance",
]

# --- fixed values: raw columns the training path reads ----------------------------------------
TRAINING_RAW_COLUMNS = [
    "FlightDate",
    "IATA_CODE_Reporting_Airline",
    "Origin",
    "Dest",
    "CRSDepTime",
    "CRSArrTime",
    "ArrDelay",
    "Cancelled",
    "Diverted",
    "Distance",
    "Year",
    "Month",
    "DayofMonth",
    "DayOfWeek",
]

# --- fixed values: texts that mean "no value" in a raw file -----------------------------------
# The last two are particular to these files, the others are the usual CSV spellings.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    " ", ".",
]

FLIGHT_KEY = ["flight_date", "carrier_code", "flight_number", "origin_airport", "dest_airport"]

DELAY_COMPONENTS = [
    "carrier_delay_min",
    "weather_delay_min",
    "nas_delay_min",
    "security_delay_min",
    "late_aircraft_delay_min",
]
DELAY_COLUMNS = ["departure_delay_min", "arrival_delay_min", *DELAY_COMPONENTS]
DURATION_COLUMNS = ["scheduled_duration_min", "actual_duration_min", "air_time_min"]
MEASURE_COLUMNS = [*DELAY_COLUMNS, *DURATION_COLUMNS, "distance_miles"]
CLOCK_COLUMNS = ["scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival"]
FLAG_COLUMNS = ["is_cancelled", "is_diverted"]
CALENDAR_COLUMNS = ["year", "month", "day_of_month", "day_of_week"]

# Cleaning keeps measures wide, so that out-of-range values reach the quality checks instead of
# turning into nulls; the warehouse types below are enforced when facts are written.
CLEAN_MEASURE = T.DecimalType(18, 6)
MINUTES = T.DecimalType(7, 2)
MILES = T.DecimalType(8, 2)

# --- fixed values: fact columns in write order ------------------------------------------------
FACT_TYPES = {
    "flight_date": T.DateType(),
    "date_id": T.IntegerType(),
    "carrier_code": T.StringType(),
    "flight_number": T.StringType(),
    "origin_airport": T.StringType(),
    "dest_airport": T.StringType(),
    "scheduled_departure": T.IntegerType(),
    "actual_departure": T.IntegerType(),
    "scheduled_arrival": T.IntegerType(),
    "actual_arrival": T.IntegerType(),
    "departure_delay_min": MINUTES,
    "arrival_delay_min": MINUTES,
    "carrier_delay_min": MINUTES,
    "weather_delay_min": MINUTES,
    "nas_delay_min": MINUTES,
    "security_delay_min": MINUTES,
    "late_aircraft_delay_min": MINUTES,
    "is_cancelled": T.BooleanType(),
    "cancellation_code": T.StringType(),
    "is_diverted": T.BooleanType(),
    "scheduled_duration_min": MINUTES,
    "actual_duration_min": MINUTES,
    "air_time_min": MINUTES,
    "distance_miles": MILES,
    "is_delayed": T.BooleanType(),
    "delay_category": T.StringType(),
    "route": T.StringType(),
    "year": T.ShortType(),
    "month": T.ShortType(),
    "source_file": T.StringType(),
}
FACT_COLUMNS = list(FACT_TYPES)
FACT_NOT_NULL = ["flight_date", "carrier_code", "origin_airport", "dest_airport", "year", "month"]

FEATURE_CATEGORIES = ["carrier_code", "origin_airport", "dest_airport"]
FEATURE_NUMBERS = [
    "month",
    "day_of_week",
    "scheduled_departure_hour",
    "scheduled_arrival_hour",
    "distance_miles",
]
FEATURE_COLUMNS = FEATURE_CATEGORIES + FEATURE_NUMBERS
LABEL = "is_delayed"

# --- fixed values: domain constants -----------------------------------------------------------
DELAY_THRESHOLD_MIN = 15
AIRPORT_PATTERN = "^[A-Z]{3}$"
CANCELLATION_CODES = ["A", "B", "C", "D", None]
DAYS_OF_WEEK = [1, 2, 3, 4, 5, 6, 7]
MAJOR_CARRIERS = [
    "AA", "DL", "UA", "WN", "AS", "B6", "F9", "NK", "G4", "SY", "HA", "VX", "OO", "YX", "MQ",
]
CALENDAR_START = "2018-01-01"
CALENDAR_END = "2030-12-31"
HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (7, 4, "Independence Day"),
    (12, 25, "Christmas Day"),
    (12, 24, "Christmas Eve"),
    (12, 31, "New Year's Eve"),
]
HIGH_RISK = 0.65
MEDIUM_RISK = 0.40
PUBLICATION_LAG_DAYS = 35

DIM_CARRIER = T.StructType([
    T.StructField("carrier_id", T.LongType()),
    T.StructField("carrier_code", T.StringType()),
    T.StructField("carrier_name", T.StringType()),
    T.StructField("carrier_group", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

DIM_AIRPORT = T.StructType([
    T.StructField("airport_id", T.LongType()),
    T.StructField("iata_code", T.StringType()),
    T.StructField("airport_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("state_name", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("latitude", T.DecimalType(9, 6)),
    T.StructField("longitude", T.DecimalType(9, 6)),
    T.StructField("utc_offset_hrs", T.DecimalType(4, 1)),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

RUN = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("dag_id", T.StringType()),
    T.StructField("run_type", T.StringType()),
    T.StructField("year", T.ShortType()),
    T.StructField("month", T.ShortType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_extracted", T.LongType()),
    T.StructField("rows_validated", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("duration_sec", T.DecimalType(10, 2)),
    T.StructField("error_message", T.StringType()),
    T.StructField("notes", T.StringType()),
])

CHECK_RESULT_COLUMNS = [
    "check_name",
    "check_type",
    "column_name",
    "rows_checked",
    "rows_failed",
    "pass_rate",
    "threshold",
    "passed",
    "details",
]
