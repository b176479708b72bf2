"""Cleaning of raw flight rows: names, types, duplicates, airport codes, derived columns."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import flight


def require_raw_columns(df):
    missing = [c for c in schema.REQUIRED_RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"raw file lacks columns: {missing}")
    return df


def rename_columns(df):
    """Raw names to warehouse names, for the columns present."""
    return df.withColumnsRenamed(schema.RAW_TO_CANONICAL)


#: Formats of dates, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd",)


def parse_date(text, formats=DATE_FORMATS):
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


#: Every text that casts to a whole number is of this form; Spark trims blanks and control characters.
_WHOLE_NUMBER = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"


def _number(col):
    # Through a decimal, not a double: it rejects NaN, infinities and spellings such as `15d`.
    return col.try_cast(schema.CLEAN_MEASURE)


def cast_columns(df, date_formats=DATE_FORMATS):
    """Types for the columns present; what cannot be read becomes null, a flag becomes false."""
    kinds = dict(df.dtypes)
    typed = {}
    if kinds.get("flight_date") == "string":
        typed["flight_date"] = parse_date(F.col("flight_date"), date_formats)
    if kinds.get("flight_number") == "string":
        # Only what may be a number is cast: each cast that fails raises an exception inside Spark.
        number = F.col("flight_number")
        typed["flight_number"] = F.when(
            number.rlike(_WHOLE_NUMBER), F.coalesce(number.try_cast("bigint").cast("string"), number)).otherwise(number)
    for c in schema.MEASURE_COLUMNS:
        if c in kinds:
            typed[c] = _number(F.col(c))
    for c in schema.CLOCK_COLUMNS:
        if c in kinds:
            typed[c] = _number(F.col(c)).try_cast("int")
    for c in schema.FLAG_COLUMNS:
        if c in kinds and kinds[c] != "boolean":
            typed[c] = F.coalesce(_number(F.col(c)) != 0, F.lit(False))
    for c in schema.CALENDAR_COLUMNS:
        if c in kinds:
            typed[c] = _number(F.col(c)).try_cast("smallint")
    return df.withColumns(typed)


def null_profile(df):
    """Rows seen and, per delay column, nulls among flights that were not cancelled."""
    flown = ~F.col("is_cancelled")
    return df.agg(
        F.count("*").alias("rows_raw"),
        *[F.count_if(flown & F.col(c).isNull()).alias(c) for c in schema.DELAY_COLUMNS
          if c in df.columns],
    )


def keep_last(df, keys, order):
    """One row per key, the greatest by `order`; null key parts equal each other.

    Filtering a row number lets Spark cut each group to one row before the shuffle as well, so a
    key that repeats in every task still arrives as one row per task.
    """
    by_recency = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_recency", F.row_number().over(by_recency))
        .filter(F.col("_recency") == 1)
        .drop("_recency")
    )


def remove_duplicates(df, order=("input_order",)):
    return keep_last(df, [c for c in schema.FLIGHT_KEY if c in df.columns], order)


def airports_valid():
    return flight.is_airport_code(F.col("origin_airport")) & flight.is_airport_code(
        F.col("dest_airport")
    )


def keep_valid_airports(df):
    if "origin_airport" not in df.columns or "dest_airport" not in df.columns:
        return df
    return df.filter(airports_valid())


def derive_columns(df):
    columns = df.columns
    delay = F.col("arrival_delay_min")
    cancelled = F.col("is_cancelled") if "is_cancelled" in columns else F.lit(False)
    derived = {
        "is_delayed": flight.is_delayed(delay),
        "delay_category": flight.delay_category(delay, cancelled),
    }
    if "origin_airport" in columns and "dest_airport" in columns:
        derived["route"] = flight.route(F.col("origin_airport"), F.col("dest_airport"))
    if "flight_date" in columns:
        derived["date_id"] = flight.date_id(F.col("flight_date"))
    return df.withColumns(derived)


def standardise(raw, date_formats=DATE_FORMATS):
    """Names and types only: every raw row is still there."""
    return raw.transform(require_raw_columns).transform(rename_columns).transform(cast_columns, date_formats)


def clean_flights(raw, order=("input_order",), date_formats=DATE_FORMATS):
    """The whole cleaning chain. Duplicates go before invalid airports."""
    return (
        raw.transform(standardise, date_formats)
        .transform(remove_duplicates, order)
        .transform(keep_valid_airports)
        .transform(derive_columns)
    )


def clean_statistics(raw, order=("input_order",), date_formats=DATE_FORMATS):
    """Row counts along the chain as one row.

    One pass: each flight key keeps its number of rows and what is counted of its last one.
    """
    typed = raw.transform(standardise, date_formats)
    keys = [c for c in schema.FLIGHT_KEY if c in typed.columns]
    counted = [c for c in ("is_cancelled", "is_diverted", "arrival_delay_min") if c in typed.columns]
    last = F.max(F.struct(
        F.struct(*order).alias("_order"), F.struct(*counted).alias("_row"))).alias("_last")
    unique = typed.groupBy(*keys).agg(F.count("*").alias("_copies"), last).select(
        *keys, "_copies", "_last._row.*")
    valid = airports_valid()
    return unique.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_raw"),
        F.count("*").alias("rows_after_dedup"),
        F.count_if(valid).alias("rows_valid"),
        *outcome_counts(valid),
    ).withColumn("rows_rejected", F.col("rows_raw") - F.col("rows_valid"))


def outcome_counts(valid):
    return [
        F.count_if(valid & F.col("is_cancelled")).alias("cancelled_flights"),
        F.count_if(valid & F.col("is_diverted")).alias("diverted_flights"),
        F.count_if(valid & F.col("arrival_delay_min").isNull()).alias("null_arrival_delay"),
    ]
