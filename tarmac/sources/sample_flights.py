"""Flights derived from the sample order tables, for checks and benchmarks.

The sample tables hold no flights. Each `lineitem` row becomes one flight, so the derived fact is a
scan of one table, as the warehouse fact is; carriers come from `supplier` and airports from
`nation`. All measures are whole numbers. On purpose there are cancelled and diverted flights,
invalid airports (`12Z`), a carrier (`RX`) and an airport (`OYZ`) missing from the dimensions, delay
components that do not add up, and days outside the calendar.
"""

from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import flight
from tarmac.operators import dimensions

ROW_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ARRIVAL_ORDER = ["resent", *ROW_ID]
CALENDAR = ("1995-01-01", "2000-12-31")

_ORIGIN = "(l_partkey % 25)"
_DEST = "((l_orderkey * 7 + l_linenumber * 3) % 25)"
_FLOWN = "l_orderkey % 53 <> 0"
_LANDED = "l_orderkey % 53 <> 0 AND l_orderkey % 211 <> 0"

_FLIGHT = {
    "flight_date": "CAST(l_shipdate AS DATE)",
    "carrier_code": "chr(65 + l_suppkey % 18) || 'X'",
    "flight_number": "CAST(1 + l_orderkey % 4000 AS STRING)",
    "origin_airport": f"'O' || chr(65 + {_ORIGIN}) || 'Z'",
    "dest_airport": f"CASE WHEN l_orderkey % 97 = 0 THEN '12Z' ELSE 'O' || chr(65 + {_DEST}) || 'Z' END",
    "scheduled_departure": "CAST(((l_orderkey * 5) % 24) * 100 + l_partkey % 60 AS INT)",
    "actual_departure":
        f"CASE WHEN {_FLOWN} THEN CAST(((l_orderkey * 5 + 1) % 24) * 100 + l_partkey % 60 AS INT) END",
    "scheduled_arrival": "CAST(((l_orderkey * 7 + 3) % 25) * 100 + l_partkey % 60 AS INT)",
    "actual_arrival":
        f"CASE WHEN {_LANDED} THEN CAST(((l_orderkey * 7 + 4) % 24) * 100 + l_partkey % 60 AS INT) END",
    "departure_delay_min":
        f"CASE WHEN {_FLOWN} THEN CAST((l_orderkey * 11 + l_partkey * 3) % 200 - 30 AS DECIMAL(7,2)) END",
    "arrival_delay_min":
        f"CASE WHEN {_LANDED} THEN CAST((l_orderkey * 7 + l_partkey * 13 + l_linenumber * 31) % 260 - 40"
        " AS DECIMAL(7,2)) END",
    "is_cancelled": "l_orderkey % 53 = 0",
    "cancellation_code":
        "CASE WHEN l_orderkey % 53 = 0 THEN substr('ABCD', CAST(1 + l_partkey % 4 AS INT), 1) END",
    "is_diverted": "l_orderkey % 211 = 0",
    "scheduled_duration_min": "CAST(60 + l_partkey % 240 AS DECIMAL(7,2))",
    "actual_duration_min": f"CASE WHEN {_LANDED} THEN CAST(70 + l_partkey % 240 AS DECIMAL(7,2)) END",
    "air_time_min": f"CASE WHEN {_LANDED} THEN CAST(50 + l_partkey % 240 AS DECIMAL(7,2)) END",
    "distance_miles": f"CAST(100 + ({_ORIGIN} * 37 + {_DEST} * 91) % 2500 AS DECIMAL(8,2))",
    "year": "CAST(year(l_shipdate) AS SMALLINT)",
    "month": "CAST(month(l_shipdate) AS SMALLINT)",
}

# How a late flight's delay splits into causes.
_CAUSES = {
    "carrier_delay_min":
        "CASE l_partkey % 5 WHEN 0 THEN arrival_delay_min WHEN 1 THEN arrival_delay_min - 10 ELSE 0 END",
    "weather_delay_min": "CASE l_partkey % 5 WHEN 1 THEN 10 WHEN 2 THEN arrival_delay_min ELSE 0 END",
    "nas_delay_min": "CASE l_partkey % 5 WHEN 3 THEN arrival_delay_min ELSE 0 END",
    "security_delay_min": "CASE l_partkey % 100 WHEN 4 THEN 5 ELSE 0 END",
    "late_aircraft_delay_min":
        "CASE l_partkey % 5 WHEN 4 THEN arrival_delay_min - CASE l_partkey % 100 WHEN 4 THEN 5 ELSE 0 END"
        " ELSE 0 END + CASE WHEN l_linenumber = 7 AND l_partkey % 2 = 0 THEN 8 ELSE 0 END",
}


def _lineitem(spark, folder, year=None):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet")
    if year is not None:
        # The sample fact is not partitioned by year; a range reaches the Parquet scan instead.
        rows = rows.filter(
            (F.col("l_shipdate") >= F.lit(f"{year}-01-01").cast("timestamp"))
            & (F.col("l_shipdate") < F.lit(f"{year + 1}-01-01").cast("timestamp"))
        )
    return rows


def _as_flights(rows, *extra):
    base = rows.select(
        *[F.expr(text).alias(name) for name, text in _FLIGHT.items()], *ROW_ID, *extra
    )
    causes = {
        name: F.expr(f"CASE WHEN arrival_delay_min >= 15 THEN CAST({text} AS DECIMAL(7,2)) END")
        for name, text in _CAUSES.items()
    }
    return base.withColumns(causes)


def _derived(flights):
    delay = F.col("arrival_delay_min")
    return flights.withColumns({
        "is_delayed": flight.is_delayed(delay),
        "delay_category": flight.delay_category(delay, F.col("is_cancelled")),
        "route": flight.route(F.col("origin_airport"), F.col("dest_airport")),
        "date_id": flight.date_id(F.col("flight_date")),
    })


def flights(spark, folder, year=None):
    """Cleaned, fact-shaped flights, each row of `lineitem` once."""
    return _derived(_as_flights(_lineitem(spark, folder, year)))


def arrivals(spark, folder):
    """Flights as they come in: those of returned items are sent again, a minute later, in a
    correction that is greater by `ARRIVAL_ORDER`."""
    copies = F.when(F.col("l_returnflag") == "R", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    sent = _lineitem(spark, folder).withColumn("resent", F.explode(copies))
    return _as_flights(sent, "resent").withColumn(
        "arrival_delay_min",
        (F.col("arrival_delay_min") + F.col("resent")).cast(schema.MINUTES),
    )


def raw_text(spark, folder, dirty=True):
    """Arrivals as raw text columns, and the row order. `dirty` adds unreadable values."""
    names = {canonical: raw for raw, canonical in schema.RAW_TO_CANONICAL.items()}
    rows = arrivals(spark, folder).withColumns({
        "day_of_month": F.dayofmonth("flight_date"),
        "day_of_week": F.weekday("flight_date") + 1,
    })
    text = {c: "CAST({c} AS STRING)" for c in names}
    text.update({c: "lpad(CAST({c} AS STRING), 4, '0')" for c in schema.CLOCK_COLUMNS})
    text.update({c: "CASE WHEN {c} THEN '1.00' ELSE '0.00' END" for c in schema.FLAG_COLUMNS})
    text["flight_number"] = "lpad({c}, 4, '0')"
    text["month"] = "CAST({c} AS STRING) || '.0'"
    if dirty:
        for column, bad in {
            "flight_date": "l_partkey % 41 = 0 THEN 'not-a-date'",
            "arrival_delay_min": "l_partkey % 43 = 0 THEN 'NA' WHEN l_partkey % 47 = 0 THEN ' '",
            "departure_delay_min": "l_partkey % 37 = 0 THEN 'late'",
            "is_diverted": "l_partkey % 59 = 0 THEN 'True'",
            "is_cancelled": "l_partkey % 61 = 0 THEN '.'",
            "distance_miles": "l_partkey % 67 = 0 THEN 'NaN'",
            "scheduled_arrival": "l_partkey % 71 = 0 THEN 'n/a'",
        }.items():
            text[column] = f"CASE WHEN {bad} ELSE {text[column]} END"
    return rows.select(
        *[F.expr(t.format(c=c)).alias(names[c]) for c, t in text.items()], *ARRIVAL_ORDER
    )


def carriers(spark, folder):
    codes = (
        spark.read.parquet(f"{folder}/supplier.parquet")
        .select(F.expr("chr(65 + s_suppkey % 18) || 'X'").alias("carrier_code"))
        .filter(F.col("carrier_code") != "RX")
        .distinct()
    )
    return codes.withColumn("carrier_name", F.concat(F.lit("Carrier "), "carrier_code"))


def airports(spark, folder):
    return spark.read.parquet(f"{folder}/nation.parquet").select(
        F.expr("'O' || chr(65 + n_nationkey) || 'Z'").alias("iata_code"),
        F.col("n_name").alias("airport_name"),
        F.col("n_name").alias("city"),
        F.expr("'R' || CAST(n_regionkey AS STRING)").alias("state_code"),
    ).filter(F.col("iata_code") != "OYZ")


def numbered_carriers(spark, folder):
    return dimensions.number_rows(carriers(spark, folder), "carrier_code", "carrier_id", 0)


def numbered_airports(spark, folder):
    return dimensions.number_rows(airports(spark, folder), "iata_code", "airport_id", 0)


def dim_date(spark):
    return dimensions.build_dim_date(spark, *CALENDAR)


def calendar_bounds(spark, folder):
    """First and last day of the years flights fall in."""
    day = F.col("l_shipdate").cast("date")
    return _lineitem(spark, folder).agg(
        F.trunc(F.min(day), "year").alias("first_day"),
        F.last_day(F.add_months(F.trunc(F.max(day), "year"), 11)).alias("last_day"),
    )
