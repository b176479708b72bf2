import datetime
from decimal import Decimal

import pytest
from flight_rows import raw_row
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import flight
from tarmac.operators import clean


def test_missing_columns_are_named(raw):
    with pytest.raises(ValueError, match="ArrDelay"):
        clean.require_raw_columns(raw(raw_row()).drop("ArrDelay"))


def test_rename_keeps_unknown_columns(raw):
    df = raw(raw_row()).withColumn("Other", F.lit(1)).drop("DayOfWeek")
    renamed = clean.rename_columns(df)
    assert "flight_date" in renamed.columns and "Other" in renamed.columns
    assert "day_of_week" not in renamed.columns and renamed.count() == 1


def test_casts(raw):
    rows = raw(
        raw_row(),
        raw_row(FlightDate="not-a-date", Cancelled="1.00", Diverted="True", ArrDelay="inf",
                Month="1.0"),
        raw_row(FlightDate="2023-13-01", Cancelled="", ArrDelay="15d", Distance="abc",
                Flight_Number_Reporting_Airline="12B", CRSDepTime="0005"),
    ).transform(clean.standardise).orderBy("input_order").collect()
    assert [r.flight_date for r in rows] == [datetime.date(2023, 1, 15), None, None]
    assert [r.is_cancelled for r in rows] == [False, True, False]
    assert [r.is_diverted for r in rows] == [False, False, False]
    assert [r.arrival_delay_min for r in rows] == [Decimal(20), None, None]
    assert [r.flight_number for r in rows] == ["100", "100", "12B"]
    assert [r.month for r in rows] == [1, 1, 1]
    assert [r.scheduled_departure for r in rows] == [800, 800, 5]
    assert rows[2].distance_miles is None


def test_typed_flags_pass_through(spark):
    df = spark.createDataFrame([(True, False)], "is_cancelled boolean, is_diverted boolean")
    assert tuple(clean.cast_columns(df).first()) == (True, False)


def test_extra_date_formats(spark):
    df = spark.createDataFrame([("1/15/2023",), ("2023-01-15",)], "flight_date string")
    got = clean.cast_columns(df, ("yyyy-MM-dd", "M/d/yyyy")).collect()
    assert {r.flight_date for r in got} == {datetime.date(2023, 1, 15)}


@pytest.mark.parametrize("delay, cancelled, category, delayed", [
    (-0.01, False, "Early", False), (0, False, "On Time", False), (14.99, False, "On Time", False),
    (15, False, "Minor Delay", True), (59.99, False, "Minor Delay", True),
    (60, False, "Major Delay", True), (179.99, False, "Major Delay", True),
    (180, False, "Severe Delay", True), (None, False, "Unknown", False),
    (200, True, "Cancelled", True), (None, True, "Cancelled", False),
])
def test_categories(spark, delay, cancelled, category, delayed):
    df = spark.createDataFrame([(None if delay is None else float(delay), cancelled)],
                               "arrival_delay_min double, is_cancelled boolean")
    row = clean.derive_columns(df).first()
    assert (row.delay_category, row.is_delayed) == (category, delayed)


def test_route_and_date_id(spark):
    row = spark.sql("select ' JFK' o, 'LAX ' d, date'2023-01-15' t, cast(null as string) n").select(
        flight.route(F.col("o"), F.col("d")), flight.route(F.col("o"), F.col("n")),
        flight.date_id(F.col("t"))).first()
    assert tuple(row) == ("JFK-LAX", None, 20230115)


def test_clock_hour(spark):
    df = spark.createDataFrame([(t,) for t in (-1, 0, 59, 2359, 2400, None)], "t int")
    got = [r.h for r in df.select(flight.clock_hour(F.col("t")).alias("h")).collect()]
    assert got == [None, 0, 0, 23, None, None]


def test_keep_last_with_null_keys(raw):
    rows = raw(
        raw_row(ArrDelay="1.00"), raw_row(ArrDelay="2.00"),
        raw_row(FlightDate="", ArrDelay="3.00"), raw_row(FlightDate="", ArrDelay="4.00"),
        raw_row(Dest="SFO", ArrDelay="5.00"),
    )
    kept = rows.transform(clean.standardise).transform(clean.remove_duplicates).collect()
    assert sorted(int(r.arrival_delay_min) for r in kept) == [2, 4, 5]


def test_only_present_keys_count(spark):
    df = spark.createDataFrame([("AA", 1, 1), ("AA", 1, 2), ("DL", 1, 3)],
                               "carrier_code string, flight_number int, input_order int")
    assert sorted(r.input_order for r in clean.remove_duplicates(df).collect()) == [2, 3]


def test_valid_airports(spark):
    df = spark.createDataFrame(
        [("JFK", "LAX"), ("LAX", "SFO"), ("123", "LAX"), ("", "LAX"), ("jfk", "LAX"),
         ("JFKX", "LAX"), (None, "LAX"), ("JFK", None)],
        "origin_airport string, dest_airport string")
    assert clean.keep_valid_airports(df).count() == 2
    assert clean.keep_valid_airports(df.drop("dest_airport")).count() == 8


def test_null_profile_skips_cancelled(raw):
    rows = raw(raw_row(ArrDelay="", Cancelled="1.00"), raw_row(ArrDelay=""), raw_row())
    got = rows.transform(clean.standardise).transform(clean.null_profile).first()
    assert (got.rows_raw, got.arrival_delay_min, got.departure_delay_min) == (3, 1, 0)


def test_statistics(raw):
    rows = raw(
        raw_row(), raw_row(), raw_row(Origin="12Z"),
        raw_row(Dest="SFO", Cancelled="1.00", ArrDelay=""), raw_row(Dest="ORD", Diverted="1.00"),
    )
    got = clean.clean_statistics(rows).first().asDict()
    assert got == {"rows_raw": 5, "rows_after_dedup": 4, "rows_valid": 3, "rows_rejected": 2,
                   "cancelled_flights": 1, "diverted_flights": 1, "null_arrival_delay": 1}


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of the rows share one key; each task sends one of them."""
    n = 30_000
    df = spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string"))
        .alias("carrier_code"),
        F.col("id").alias("input_order"),
    )
    kept = clean.remove_duplicates(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert kept.count() == n - n // 3 + 1
    assert kept.filter("carrier_code = 'HOT'").first().input_order == n - 3


def test_clean_measures_stay_wide(raw):
    row = raw(raw_row(Distance="99999999.5")).transform(clean.clean_flights).first()
    assert row.distance_miles == Decimal("99999999.5")
    assert dict(raw(raw_row()).transform(clean.clean_flights).dtypes)["distance_miles"] == (
        schema.CLEAN_MEASURE.simpleString())


def test_only_texts_that_may_be_whole_numbers_are_cast(spark):
    """A failing cast costs an exception; the guard before it lets every text through that casts."""
    texts = ["0100", " 7", "+5", "-3", "\t8\n", "\x7f9", "12B", "12-3", "1.5", "1e3", "", "+", "٣", "9" * 30, "5 6", None]
    df = spark.createDataFrame([(t,) for t in texts], "flight_number string")
    number = F.col("flight_number")
    want = df.select(number.alias("t"), F.coalesce(number.try_cast("bigint").cast("string"), number).alias("n"))
    got = clean.cast_columns(df.withColumn("t", number))
    assert {r.t: r.flight_number for r in got.collect()} == {r.t: r.n for r in want.collect()}
    assert "RLIKE" in got._jdf.queryExecution().optimizedPlan().toString()
