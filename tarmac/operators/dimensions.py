"""Calendar, carrier and airport dimensions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import flight


# --- calendar -------------------------------------------------------------------------------

def calendar(days, day_column="full_date"):
    """Calendar attributes of each day of a table of days. Weeks and weekdays are ISO."""
    day = F.col(day_column)
    weekday = F.weekday(day) + 1
    return days.select(
        flight.date_id(day).alias("date_id"),
        day.alias("full_date"),
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        weekday.cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
        flight.season(F.month(day)).alias("season"),
    )


def days_between(bounds, first="first_day", last="last_day"):
    """One row per day of the period in a one-row table of bounds."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("full_date"))


def calendar_bounds(spark, first=schema.CALENDAR_START, last=schema.CALENDAR_END):
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )


def mark_holidays(dates):
    name = flight.holiday_name(F.col("month"), F.col("day_of_month"))
    return dates.withColumns({"is_holiday": name.isNotNull(), "holiday_name": name})


def build_dim_date(spark, first=schema.CALENDAR_START, last=schema.CALENDAR_END):
    return mark_holidays(calendar(days_between(calendar_bounds(spark, first, last))))


# --- codes found in flights -----------------------------------------------------------------

def carrier_codes(flights):
    return flights.select("carrier_code").distinct()


def airport_codes(flights):
    """Codes at either end. Pairs are reduced first, so unpivoting touches routes, not rows."""
    pairs = flights.select("origin_airport", "dest_airport").distinct()
    return pairs.select(
        F.explode(F.array("origin_airport", "dest_airport")).alias("iata_code")
    ).distinct()


def unseen(codes, dimension, key):
    """Codes the dimension does not hold yet."""
    return codes.dropna(subset=[key]).join(dimension.select(key), key, "left_anti")


# --- surrogate ids --------------------------------------------------------------------------

def number_rows(df, key, id_column, start):
    """Dense ids above `start` for distinct keys, in order of (hash bucket, key).

    Ranks are taken inside 4096 hash buckets and shifted by the sizes of the buckets before, so no
    task has to see all the keys.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("binary")), 1, 3))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_bucket").orderBy(key)
    return (
        bucketed.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(shifts), "_bucket")  # at most 4096 rows
        .withColumn(id_column, F.lit(start) + F.col("_shift") + F.col("_rank"))
        .drop("_bucket", "_rank", "_shift")
    )


def _next_rows(codes, dimension, key, id_column, target, now, defaults):
    start = dimension.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("m")).first()["m"]
    numbered = number_rows(unseen(codes, dimension, key), key, id_column, start)
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    values = {"is_active": F.lit(True), "created_at": stamp, "updated_at": stamp, **defaults}
    return numbered.select([
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in (key, id_column)
        else values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ])


def new_carrier_rows(flights, dim_carriers, now=None):
    """Rows to append for carriers seen for the first time; known ones stay as they are."""
    return _next_rows(carrier_codes(flights), dim_carriers, "carrier_code", "carrier_id",
                      schema.DIM_CARRIER, now, {})


def new_airport_rows(flights, dim_airports, now=None):
    return _next_rows(airport_codes(flights), dim_airports, "iata_code", "airport_id",
                      schema.DIM_AIRPORT, now, {"country_code": F.lit("US")})


def enrich(dimension, reference, key, columns, now=None):
    """Fill dimension columns from reference documents, where these have a value."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    one_per_code = (
        reference.groupBy(key)
        .agg(F.max(F.struct(*columns)).alias("_ref"))
        .withColumn("_found", F.lit(True))
    )
    kinds = dict(dimension.dtypes)

    def filled(name):
        if name == "updated_at":
            return F.when(F.col("_found"), stamp).otherwise(F.col(name)).alias(name)
        if name not in columns:
            return F.col(name)
        value = F.col(f"_ref.{name}")
        value = F.nullif(value, F.lit("")) if kinds[name] == "string" else value
        return F.coalesce(value, F.col(name)).cast(kinds[name]).alias(name)

    return dimension.join(one_per_code, key, "left").select([filled(c) for c in dimension.columns])


def with_dimension_keys(flights, carriers, airports):
    """Fill the declared foreign keys from the natural keys; unknown codes keep null.

    The dimensions are stored tables of known size, so Spark chooses between broadcast and shuffle.
    """
    by_code = carriers.select("carrier_code", "carrier_id")
    ids = airports.select("iata_code", "airport_id")
    origin = ids.toDF("origin_airport", "origin_airport_id")
    dest = ids.toDF("dest_airport", "dest_airport_id")
    return (
        flights.join(by_code, "carrier_code", "left")
        .join(origin, "origin_airport", "left")
        .join(dest, "dest_airport", "left")
    )
