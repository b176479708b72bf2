import datetime

import pytest
from flight_rows import RAW_HEADER, raw_row, write_csv
from pyspark.sql import functions as F

from tarmac import jobs, schema
from tarmac.operators import clean, dimensions, quality
from tarmac.plans import load
from tarmac.plans import warehouse as wh
from tarmac.sources import raw as src
from tarmac.streaming import ingest


@pytest.fixture
def january(raw):
    """Three cleaned flights of January 2023."""
    return raw(
        raw_row(), raw_row(Origin="LAX", Dest="SFO"),
        raw_row(IATA_CODE_Reporting_Airline="DL", Origin="LAX", Dest="JFK", ArrDelay="-3.00"),
    ).transform(clean.clean_flights).withColumn("source_file", F.lit("jan.csv"))


def test_projection(january):
    facts = january.withColumn("unexpected_col", F.lit("ignored")).transform(wh.to_facts)
    assert facts.columns == schema.FACT_COLUMNS and facts.count() == 3
    assert len(schema.FACT_COLUMNS) == 30
    assert dict(facts.dtypes)["arrival_delay_min"] == "decimal(7,2)"


def test_overflow_is_an_error(january):
    huge = january.withColumn("arrival_delay_min", F.lit(1234567.0).cast(schema.CLEAN_MEASURE))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        huge.transform(wh.to_facts).collect()


def test_load_then_skip_then_replace(warehouse, january):
    first = load.load_month(warehouse, january, "jan.csv", 2023, 1)
    assert (first["status"], first["rows_loaded"]) == ("success", 3)
    assert load.load_month(warehouse, january, "jan.csv", 2023, 1) == {
        "skipped": True, "existing_rows": 3}
    later = january.filter("carrier_code = 'AA'")
    load.load_month(warehouse, later, "jan2.csv", 2023, 1, overwrite=True)
    load.load_month(warehouse, later, "jan2.csv", 2023, 1, overwrite=True)
    facts = warehouse.facts()
    assert facts.count() == 2
    assert facts.select("flight_id").distinct().count() == 2
    assert facts.filter("carrier_id is null or origin_airport_id is null").count() == 0
    runs = [r.status for r in warehouse.runs().orderBy("started_at").collect()]
    assert runs == ["success", "skipped", "success", "success"]
    carriers = warehouse.carriers()
    assert sorted(r.carrier_code for r in carriers.collect()) == ["AA", "DL"]
    assert sorted(r.carrier_id for r in carriers.collect()) == [1, 2]
    airports = warehouse.airports().collect()
    assert sorted(r.iata_code for r in airports) == ["JFK", "LAX", "SFO"]
    assert {r.country_code for r in airports} == {"US"}


def test_other_month_is_refused_and_leaves_data_alone(warehouse, january):
    load.load_month(warehouse, january, "jan.csv", 2023, 1)
    with pytest.raises(ValueError, match="outside 2023-02"):
        load.load_month(warehouse, january, "jan.csv", 2023, 2)
    assert warehouse.facts().count() == 3
    failed = warehouse.runs().filter("status = 'failed'").first()
    assert (failed.month, failed.rows_loaded) == (2, 0) and "outside" in failed.error_message


def test_row_ids_of_months_differ(warehouse, january):
    february = january.withColumns({
        "flight_date": F.add_months("flight_date", 1), "month": F.lit(2).cast("smallint")})
    load.load_month(warehouse, january, "jan.csv", 2023, 1)
    load.load_month(warehouse, february, "feb.csv", 2023, 2)
    facts = warehouse.facts()
    assert facts.count() == 6 == facts.select("flight_id").distinct().count()
    assert facts.filter("flight_id <= 0").count() == 0


def test_month_read_is_pruned(warehouse, january):
    load.load_month(warehouse, january, "jan.csv", 2023, 1)
    plan = wh.rows_of_month(warehouse.facts(), 2023, 1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month#" in plan.split(
        "PartitionFilters")[1]


def test_run_month(spark, warehouse, tmp_path):
    path = write_csv(tmp_path / "flights_2023_01.csv", [
        raw_row(), raw_row(ArrDelay="22.00"), raw_row(Dest="12Z"), raw_row(Dest="SFO"),
        raw_row(Dest="ORD", Cancelled="1.00", ArrDelay="", CancellationCode="B"),
        *[raw_row(Flight_Number_Reporting_Airline=str(n)) for n in range(200, 210)],
    ])
    load.ensure_calendar(warehouse)
    raw_rows = src.read_flight_files(spark, path)
    stats = load.run_month(warehouse, raw_rows, 2023, 1, source_file=path)
    assert stats["steps_completed"] == ["transform", "quality", "load", "refresh"]
    assert (stats["rows_raw"], stats["rows_after_dedup"], stats["rows_valid"]) == (15, 14, 13)
    assert (stats["rows_rejected"], stats["rows_loaded"]) == (2, 13)
    assert stats["quality_passed"] and len(stats["quality_results"]) == 12
    assert stats["refresh_problems"] == {}
    run = warehouse.runs().first()
    assert (run.status, run.rows_extracted, run.rows_rejected) == ("success", 15, 2)
    checks = warehouse.read("data_quality_results")
    assert checks.filter(F.col("run_id") == run.run_id).count() == 12
    summary = warehouse.read("mv_monthly_summary").first()
    assert (summary.total_flights, summary.month_name, summary.season) == (13, "January", "Winter")
    again = load.run_month(warehouse, raw_rows, 2023, 1, source_file=path)
    assert again["status"] == "skipped" and warehouse.facts().count() == 13


def test_gate_stops_the_load(spark, warehouse, tmp_path):
    path = write_csv(tmp_path / "f.csv", [raw_row(FlightDate="not-a-date"), raw_row()])
    raw_rows = src.read_flight_files(spark, path)
    with pytest.raises(quality.QualityGateError):
        load.run_month(warehouse, raw_rows, 2023, 1)
    assert warehouse.facts().count() == 0
    assert warehouse.runs().first().status == "failed"
    assert warehouse.read("data_quality_results").count() == 12


def test_gate_override_and_skip(spark, warehouse, tmp_path):
    load.ensure_calendar(warehouse)
    path = write_csv(tmp_path / "f.csv", [raw_row(Distance="0.00"), raw_row(Dest="SFO")])
    raw_rows = src.read_flight_files(spark, path)
    stats = load.run_month(warehouse, raw_rows, 2023, 1, fail_on_quality=False)
    assert not stats["quality_passed"] and stats["rows_loaded"] == 2
    stats = load.run_month(warehouse, raw_rows, 2023, 1, skip_quality=True, overwrite=True)
    assert "quality" not in stats["steps_completed"] and stats["rows_loaded"] == 2


def test_refresh_empties_a_summary_and_survives_a_missing_table(warehouse, january):
    many = january.crossJoin(january.sparkSession.range(60)).drop("id")
    load.load_month(warehouse, many, "jan.csv", 2023, 1)
    problems = load.refresh_summaries(warehouse, [2023])
    assert set(problems) == {"mv_monthly_summary"}  # no calendar stored
    routes = warehouse.read("mv_route_analysis")
    assert routes.count() == 3
    load.load_month(warehouse, january, "jan.csv", 2023, 1, overwrite=True)
    load.refresh_summaries(warehouse, [2023])
    assert warehouse.read("mv_carrier_performance").count() == 2
    assert warehouse.read("mv_route_analysis", routes.schema).count() == 0


def test_calendar_is_whole_and_appended_once(warehouse):
    load.ensure_calendar(warehouse)
    load.ensure_calendar(warehouse)
    dates = warehouse.read("dim_date")
    assert dates.count() == 4748 == dates.select("date_id").distinct().count()
    row = dates.filter("date_id = 20210103").first()
    assert (row.week_of_year, row.day_of_week, row.day_name, row.is_weekend) == (
        53, 7, "Sunday", True)
    names = {(r.month, r.day_of_month): r.holiday_name for r in
             dates.filter("is_holiday and year = 2023").collect()}
    assert names == {(m, d): n for m, d, n in schema.HOLIDAYS}


def test_dense_ids(spark):
    codes = spark.range(5000).select(F.concat(F.lit("K"), "id").alias("code"))
    got = dimensions.number_rows(codes, "code", "n", 10)
    row = got.agg(F.min("n").alias("lo"), F.max("n").alias("hi"),
                  F.count_distinct("n").alias("d")).first()
    assert tuple(row) == (11, 5010, 5000)


def test_enrichment_keeps_what_it_knows(spark):
    dim = spark.createDataFrame(
        [("JFK", None, "old", None), ("LAX", "Los Angeles", None, None)],
        "iata_code string, airport_name string, city string, updated_at timestamp")
    ref = spark.createDataFrame([("JFK", "Kennedy", ""), ("JFK", "Kennedy", ""), ("XXX", "X", "X")],
                                "iata_code string, airport_name string, city string")
    got = dimensions.enrich(dim, ref, "iata_code", ["airport_name", "city"],
                            now=datetime.datetime(2024, 1, 1)).orderBy("iata_code").collect()
    assert [tuple(r)[:3] for r in got] == [("JFK", "Kennedy", "old"), ("LAX", "Los Angeles", None)]
    assert got[0].updated_at.year == 2024 and got[1].updated_at is None


def test_staged_rows(raw):
    row = wh.staged_rows(raw(raw_row()).drop("ArrDelay"), source_file="a.csv").first()
    assert (row.carrier_code, row.distance, row.arrival_delay) == ("AA", "2475.00", None)
    assert '"Origin":"JFK"' in row.raw_data and not row.is_processed


def test_stream_merges_new_files_once(spark, warehouse, tmp_path):
    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    landing.mkdir()
    write_csv(landing / "a.csv", [raw_row(), raw_row(Dest="SFO", ArrDelay="18.00")])
    ingest.ingest_stream(warehouse, str(landing), progress)
    assert warehouse.facts().count() == 2
    before = warehouse.read("data_quality_results").count()
    ingest.ingest_stream(warehouse, str(landing), progress)
    assert warehouse.read("data_quality_results").count() == before  # nothing was processed
    write_csv(landing / "b.csv", [raw_row(Dest="SFO", ArrDelay="23.00"),
                                  raw_row(FlightDate="2023-02-01", Month="2")])
    ingest.ingest_stream(warehouse, str(landing), progress)
    facts = warehouse.facts()
    got = {(r.dest_airport, r.month): float(r.arrival_delay_min) for r in facts.collect()}
    assert got == {("LAX", 1): 20.0, ("SFO", 1): 23.0, ("LAX", 2): 20.0}
    assert facts.select("flight_id").distinct().count() == 3
    runs = warehouse.runs().orderBy("started_at").collect()
    assert [(r.status, r.rows_extracted, r.rows_loaded, r.notes) for r in runs] == [
        ("success", 2, 2, "2023-01"), ("success", 2, 2, "2023-01, 2023-02")]


def test_stream_keeps_trying_a_bad_file(spark, warehouse, tmp_path):
    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    landing.mkdir()
    write_csv(landing / "a.csv", [raw_row(FlightDate="bad")])
    with pytest.raises(Exception, match="data quality checks failed"):
        ingest.ingest_stream(warehouse, str(landing), progress)
    assert warehouse.facts().count() == 0
    assert warehouse.runs().first().status == "failed"


def test_stream_of_an_empty_folder_does_nothing(spark, warehouse, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    ingest.ingest_stream(warehouse, str(landing), str(tmp_path / "progress"))
    assert warehouse.runs().count() == 0 and warehouse.facts().count() == 0


def test_stream_takes_other_layouts_and_refreshes_summaries(spark, warehouse, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_csv(landing / "a.csv", [raw_row()])
    write_csv(landing / "b.csv", [raw_row(Dest="SFO")], header=RAW_HEADER[:-1][::-1])
    ingest.ingest_stream(warehouse, str(landing), str(tmp_path / "progress"))
    assert {r.dest_airport for r in warehouse.facts().collect()} == {"LAX", "SFO"}
    assert warehouse.read("mv_monthly_summary").first().total_flights == 2


def test_reference_names_are_stored(spark, warehouse, january, tmp_path):
    load.load_month(warehouse, january, "jan.csv", 2023, 1)
    airports, airlines = tmp_path / "airports.json", tmp_path / "airlines.json"
    airports.write_text('[{"iata_code": "JFK", "airport_name": "Kennedy", "city": "NYC"}]')
    airlines.write_text('[{"carrier_code": "AA", "carrier_name": "American", "is_active": true}]')
    for _ in range(2):
        jobs.run(spark, jobs.arguments(["reference", "--warehouse", warehouse.root, "--airports",
                                        str(airports), "--airlines", str(airlines)]))
    assert {r.iata_code: (r.airport_name, r.city) for r in warehouse.airports().collect()} == {
        "JFK": ("Kennedy", "NYC"), "LAX": (None, None), "SFO": (None, None)}
    assert {r.carrier_code: r.carrier_name for r in warehouse.carriers().collect()} == {
        "AA": "American", "DL": None}


def test_a_delivery_of_many_months_leaves_few_files(spark, warehouse, tmp_path, monkeypatch):
    """Tasks that read the delivered facts back hold a few months each: without that, each one writes every month."""
    landing = tmp_path / "landing"
    landing.mkdir()
    write_csv(landing / "a.csv", [
        raw_row(FlightDate=f"2023-{month:02d}-{day:02d}", Month=str(month), DayofMonth=str(day))
        for month in range(1, 13) for day in range(1, 21)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest.ingest_stream(warehouse, str(landing), str(tmp_path / "progress"), refresh=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    facts = warehouse.facts()
    assert {(r.month, r.n) for r in facts.groupBy("month").agg(F.count("*").alias("n")).collect()} == {
        (month, 20) for month in range(1, 13)}
    assert facts.select("flight_id").distinct().count() == 240
    assert len(facts.inputFiles()) == 12


@pytest.mark.parametrize("few", [1 << 20, 0])
def test_rows_without_a_duplicate_are_not_shuffled(spark, raw, tmp_path, monkeypatch, few):
    from tarmac.operators import clean
    monkeypatch.setattr(load, "FEW_AGAIN", few)

    def stored(name, *rows):
        raw(*rows).transform(clean.standardise).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    once = stored("once", raw_row(), raw_row(Dest="SFO"), raw_row(FlightDate=""))
    plan = load._without_duplicates(once, ["input_order"], str(tmp_path / "a"))._jdf.queryExecution().toString()
    assert "Window" not in plan and "Exchange" not in plan
    twice = stored("twice", raw_row(), raw_row(ArrDelay="22.00"), raw_row(Dest="SFO"), raw_row(FlightDate="", ArrDelay="1"),
                   raw_row(FlightDate="", ArrDelay="2"), raw_row(Origin="", Dest="SFO"))
    got = load._without_duplicates(twice, ["input_order"], str(tmp_path / "b"))
    want = twice.transform(clean.remove_duplicates)
    assert got.count() == 4 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_deliveries_of_the_queries_land_compressed(spark, tmp_path):
    """As plain text they were the largest part of what an ingest had on disk."""
    from verification import jobs as queries
    for _ in range(2):
        queries._land(spark.range(3).selectExpr("cast(id as string) as a"), str(tmp_path / "landing"))
    files = [p.name for p in (tmp_path / "landing").iterdir() if p.name.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert spark.read.csv(str(tmp_path / "landing"), header=True).count() == 6
