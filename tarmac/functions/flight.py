"""Column expressions with the meaning of single flight attributes."""

from pyspark.sql import functions as F

from tarmac import schema


def is_delayed(arrival_delay):
    """At least 15 minutes late; an unknown delay is not a delay."""
    return F.coalesce(arrival_delay >= schema.DELAY_THRESHOLD_MIN, F.lit(False))


def delay_category(arrival_delay, cancelled):
    return (
        F.when(cancelled, "Cancelled")
        .when(arrival_delay.isNull(), "Unknown")
        .when(arrival_delay < 0, "Early")
        .when(arrival_delay < 15, "On Time")
        .when(arrival_delay < 60, "Minor Delay")
        .when(arrival_delay < 180, "Major Delay")
        .otherwise("Severe Delay")
    )


def route(origin, dest):
    """`JFK-LAX`; null when either end is null."""
    return F.concat(F.trim(origin), F.lit("-"), F.trim(dest))


def date_id(day):
    """The date as a YYYYMMDD integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def is_airport_code(code):
    """Three capital letters; null is not a code."""
    return F.coalesce(code.rlike(schema.AIRPORT_PATTERN), F.lit(False))


def clock_hour(hhmm):
    """Hour of an HHMM time; null outside 0..2359."""
    return F.when(hhmm.between(0, 2359), F.floor(hhmm / 100).cast("int"))


def risk_band(probability):
    return (
        F.when(probability >= schema.HIGH_RISK, "High delay risk")
        .when(probability >= schema.MEDIUM_RISK, "Medium delay risk")
        .otherwise("Low delay risk")
    )


def delay_label(prediction):
    return F.when(prediction == 1, "Delayed").otherwise("Not delayed")


def season(month):
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def holiday_name(month, day):
    name = F.lit(None).cast("string")
    for m, d, text in schema.HOLIDAYS:
        name = F.when((month == m) & (day == d), text).otherwise(name)
    return name


def target_period(run_date):
    """(year, month) a run on `run_date` processes: files appear about a month after month end."""
    day = F.date_sub(run_date, schema.PUBLICATION_LAG_DAYS)
    return F.year(day), F.month(day)
