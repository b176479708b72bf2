import json

import pytest
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import quality

FLIGHT = ("flight_date date, carrier_code string, flight_number string, origin_airport string,"
          " dest_airport string, departure_delay_min double, arrival_delay_min double,"
          " distance_miles double")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.fixture
def flights(spark):
    return spark.sql("""
        select date'2023-01-15' flight_date, 'AA' carrier_code, cast(id as string) flight_number,
               'JFK' origin_airport, 'LAX' dest_airport, 5.0 departure_delay_min,
               20.0 arrival_delay_min, 2475.0 distance_miles from range(3)""")


def test_not_null(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (None,)], "x int")
    row = one(quality.evaluate(df, [quality.not_null("x")]))
    assert (row.pass_rate, row.passed, row.rows_checked, row.rows_failed) == (0.25, False, 4, 3)
    assert json.loads(row.details) == {"not_null_count": 1, "null_count": 3}
    assert row.check_name == "not_null::x" and row.check_type == "completeness"


def test_range(spark):
    df = spark.createDataFrame([(100.0,), (200.0,), (99999.0,), (300.0,), (None,), (float("nan"),)],
                               "x double")
    row = one(quality.evaluate(df, [quality.value_range("x", 0, 6000)]))
    assert (row.rows_checked, row.rows_failed, row.passed) == (4, 1, False)
    assert json.loads(row.details)["actual_max"] == 99999.0


def test_unique_counts_null_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1), ("b", 1)], "k string, v int")
    row = one(quality.check_unique(df, ["k", "v"]))
    assert (row.rows_checked, row.rows_failed, row.passed) == (4, 1, False)
    assert one(quality.check_unique(df.distinct(), ["k", "v"])).passed


def test_future(spark):
    df = spark.sql("select date'2099-01-01' flight_date union all select date'2020-01-01'")
    row = one(quality.evaluate(df, [quality.no_future_dates()]))
    assert (row.passed, row.rows_failed) == (False, 1)
    assert json.loads(row.details) == {"min_date": "2020-01-01", "max_date": "2099-01-01"}


def test_future_without_any_date(spark):
    df = spark.sql("select cast(null as date) flight_date")
    row = one(quality.evaluate(df, [quality.no_future_dates()]))
    assert (row.passed, row.rows_checked) == (False, 0)
    assert json.loads(row.details) == {"min_date": None, "max_date": None}


def test_values_in_set(spark):
    df = spark.createDataFrame([("A",), ("Z",), ("Z",), ("Y",), (None,)], "c string")
    row = one(quality.check_values_in_set(df, "c", schema.CANCELLATION_CODES))
    assert (row.rows_checked, row.rows_failed, row.pass_rate) == (5, 3, 0.4)
    assert json.loads(row.details) == {
        "invalid_top10": [{"value": "Z", "n": 2}, {"value": "Y", "n": 1}]}
    strict = one(quality.check_values_in_set(df, "c", ["A", "Z", "Y"]))
    assert strict.rows_failed == 1


def frequent(df, allowed=(), n=10):
    return [(r.value, r.occurrences) for r in quality.invalid_values(df, "c", list(allowed), n).collect()]


@pytest.mark.parametrize("slots, fullest", [(2 ** 16, 64), (8, 2), (1, 1)])
def test_frequent_values_are_exact(spark, monkeypatch, slots, fullest):
    """Whatever the counters are shared by, and with ties across the last place."""
    monkeypatch.setattr(quality, "SLOTS", slots)
    monkeypatch.setattr(quality, "FULLEST", fullest)
    df = spark.range(3000).select(F.expr(
        "case when id % 10 = 0 then null when id % 3 = 0 then 'hot' when id < 900 then concat('v', id % 40)"
        " else concat('u', id) end").alias("c")).cache()
    counts = {}
    for r in df.collect():
        if r.c is not None and r.c != "v7":
            counts[r.c] = counts.get(r.c, 0) + 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    for n in (1, 10, 60):
        assert frequent(df, ["v7"], n) == want[:n]


def test_frequent_values_of_few_rows(spark):
    empty = spark.createDataFrame([], "c string")
    assert frequent(empty) == [] == frequent(spark.createDataFrame([(None,), ("A",)], "c string"), ["A"])
    assert frequent(spark.createDataFrame([("b",), ("a",), ("b",)], "c string")) == [("b", 2), ("a", 1)]
    assert one(quality.check_values_in_set(empty, "c", ["A"])).rows_checked == 0


def test_rare_values_are_left_out_before_they_are_shuffled(spark):
    """Twenty values are frequent; nearly all of the 200,000 single ones cannot be, and leave by their counters."""
    df = spark.range(300_000).select(F.expr(
        "case when id < 100000 then concat('h', id % 20) else concat('u', id) end").alias("value"))
    left = quality.possible_values(df, 10).groupBy().agg(
        F.count("*").alias("n"), F.count_distinct("value").alias("values")).first()
    assert left["n"] >= 100_000 and left["values"] < 500


def test_numbers_in_set(spark):
    df = spark.createDataFrame([(1,), (7,), (8,)], "d int")
    assert one(quality.check_values_in_set(df, "d", schema.DAYS_OF_WEEK)).rows_failed == 1


def test_reference(spark):
    df = spark.createDataFrame([("JFK",), ("LAX",), ("XXX",), (None,)], "a string")
    known = spark.createDataFrame([("JFK",), ("LAX",), ("LAX",)], "code string")
    row = one(quality.check_referential_integrity(df, "a", known, "code"))
    assert (row.rows_checked, row.rows_failed) == (4, 2)
    assert json.loads(row.details) == {"invalid_values_sample": ["XXX"]}


def test_consistency(spark):
    parts = schema.DELAY_COMPONENTS
    df = spark.createDataFrame(
        [(30.0, 30.0, 0.0, 0.0, 0.0, 0.0), (30.0, 20.0, 0.0, 0.0, 0.0, 0.0),
         (30.0, None, 0.0, 0.0, 0.0, 0.0), (None, 1.0, 0.0, 0.0, 0.0, 0.0)],
        ", ".join(f"{c} double" for c in ["arrival_delay_min", *parts]))
    row = one(quality.evaluate(df, [quality.delay_consistency(df.columns)]))
    assert (row.rows_checked, row.rows_failed, row.passed) == (2, 1, False)
    assert json.loads(row.details) == {"mean_difference_min": 5.0, "max_difference_min": 10.0}


def test_consistency_has_nothing_to_check(spark):
    few = spark.createDataFrame([(1.0, 1.0)], "arrival_delay_min double, carrier_delay_min double")
    row = one(quality.evaluate(few, [quality.delay_consistency(few.columns)]))
    assert row.passed and row.pass_rate == 1.0
    empty = spark.createDataFrame(
        [], ", ".join(f"{c} double" for c in ["arrival_delay_min", *schema.DELAY_COMPONENTS]))
    row = one(quality.evaluate(empty, [quality.delay_consistency(empty.columns)]))
    assert row.passed and "No rows" in row.details


def test_empty_input_fails(spark):
    empty = spark.createDataFrame([], FLIGHT)
    rows = quality.run_all_checks(empty).collect()
    assert len(rows) == 12
    assert {r.check_name for r in rows if r.passed} == {"delay_consistency"}
    assert {r.pass_rate for r in rows if not r.passed} == {0.0}
    assert not one(quality.check_values_in_set(empty, "carrier_code", ["AA"])).passed


def test_suite(flights):
    rows = quality.run_all_checks(flights).collect()
    assert len(rows) == 12 and all(r.passed for r in rows)
    without_key = quality.run_all_checks(flights.drop("flight_number", "x")).collect()
    assert len(without_key) == 12  # four key columns are enough
    fewer = [c for c in flights.columns if c != "flight_number"]
    assert quality.run_all_checks(flights.select(fewer)).filter(
        F.col("check_type") == "uniqueness").first().rows_failed == 2


def test_gate(flights):
    good = quality.run_all_checks(flights)
    assert quality.gate(good) == []
    bad = quality.run_all_checks(flights.withColumn("distance_miles", F.lit(0.0)))
    with pytest.raises(quality.QualityGateError, match="value_range::distance_miles"):
        quality.gate(bad)
    assert quality.gate(bad, fail=False) == ["value_range::distance_miles"]


def test_report(flights):
    lines = [r.line for r in quality.report_lines(quality.run_all_checks(flights)).collect()]
    assert f"[PASS] {'not_null::flight_date':<45} 100.0% (threshold: 100%)" in lines
    assert lines[-1] == "Result: 12/12 checks passed"
