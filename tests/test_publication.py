"""Publishing in one step, audit rows by transaction, and states of months."""

import pytest
from flight_rows import raw_row, write_csv
from pyspark.sql import functions as F

from tarmac.operators import clean
from tarmac.plans import load, states, summaries
from tarmac.plans import warehouse as wh
from tarmac.streaming import ingest


@pytest.fixture
def january(raw):
    return raw(
        raw_row(), raw_row(Origin="LAX", Dest="SFO", ArrDelay="31.00"),
        raw_row(IATA_CODE_Reporting_Airline="DL", Origin="LAX", Dest="JFK", ArrDelay="-3.00"),
    ).transform(clean.clean_flights).withColumn("source_file", F.lit("jan.csv"))


def months(january, *numbers):
    out = None
    for n in numbers:
        one = january.withColumns({"flight_date": F.add_months("flight_date", n - 1), "month": F.lit(n).cast("smallint"),
                                   "date_id": F.lit(20230015 + 100 * n)})
        out = one if out is None else out.unionByName(one)
    return out


def breaking(df, column):
    """Fails in the task that writes it."""
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.raise_error(F.lit("lost"))).cast(df.schema[column].dataType))


def test_a_failed_write_leaves_the_old_month(warehouse, january):
    load.load_month(warehouse, january, "jan.csv", 2023, 1)
    with pytest.raises(Exception, match="lost"):
        warehouse.publish(warehouse.written_months(breaking(warehouse.facts(), "route"), 2023, 1))
    assert warehouse.facts().count() == 3 and warehouse.facts().agg(F.max("arrival_delay_min")).first()[0] == 31


def test_a_failed_enrichment_leaves_the_old_dimension(spark, warehouse, january):
    load.load_month(warehouse, january, "jan.csv", 2023, 1)
    names = spark.createDataFrame([("AA", "American", True), ("DL", "Delta", True)],
                                  "carrier_code string, carrier_name string, is_active boolean")
    load.enrich_dimensions(warehouse, airlines=names.limit(1))
    with pytest.raises(Exception, match="lost"):
        load.enrich_dimensions(warehouse, airlines=breaking(names, "carrier_name"))
    assert {r.carrier_code: r.carrier_name for r in warehouse.carriers().collect()} == {"AA": "American", "DL": None}
    # What is added later stands beside the published rows, and the next enrichment takes all of them.
    load.load_month(warehouse, months(january, 2).withColumn("carrier_code", F.lit("ZZ")), "feb.csv", 2023, 2)
    load.enrich_dimensions(warehouse, airlines=names)
    assert {r.carrier_code: r.carrier_name for r in warehouse.carriers().collect()} == {
        "AA": "American", "DL": "Delta", "ZZ": None}
    assert sorted(r.carrier_id for r in warehouse.carriers().collect()) == [1, 2, 3]


def test_units_published_together_appear_together(spark, warehouse, january, monkeypatch):
    load.load_month(warehouse, january, "jan.csv", 2023, 1)
    load.ensure_calendar(warehouse)
    assert load.refresh_summaries(warehouse, [2023]) == {}
    before = warehouse.read("mv_carrier_performance").collect()
    load.load_month(warehouse, january.filter("carrier_code = 'AA'"), "jan.csv", 2023, 1, overwrite=True)
    publish = type(warehouse).publish
    monkeypatch.setattr(type(warehouse), "publish", lambda self, rows: (
        publish(self, rows) if not any(r[0].startswith("mv_") for r in rows) else (_ for _ in ()).throw(OSError("lost"))))
    with pytest.raises(OSError):
        load.refresh_summaries(warehouse, [2023])
    assert warehouse.read("mv_carrier_performance").collect() == before
    monkeypatch.undo()
    load.refresh_summaries(warehouse, [2023])
    assert {r.carrier_code for r in warehouse.read("mv_carrier_performance").collect()} == {"AA"}


def test_superseded_folders_can_be_dropped(warehouse, january, tmp_path):
    for _ in range(3):
        load.load_month(warehouse, january, "jan.csv", 2023, 1, overwrite=True)
    folders = tmp_path / "warehouse" / "fact_flights"
    assert len(list(folders.glob("version=*/year=2023/month=1/*.parquet"))) >= 3
    before = sorted(map(tuple, warehouse.facts().collect()))
    warehouse.drop_superseded("fact_flights")
    assert len({p.parent for p in folders.glob("version=*/year=2023/month=1/*.parquet")}) == 1
    assert sorted(map(tuple, warehouse.facts().collect())) == before


def test_a_batch_run_again_leaves_one_run(spark, warehouse, tmp_path):
    landing, progress = tmp_path / "landing", tmp_path / "progress"
    landing.mkdir()
    write_csv(landing / "a.csv", [raw_row(), raw_row(Dest="SFO", ArrDelay="18.00")])
    ingest.ingest_stream(warehouse, str(landing), str(progress))
    facts = sorted((r.dest_airport, r.arrival_delay_min) for r in warehouse.facts().collect())
    (run,) = warehouse.runs().collect()
    # As after a crash between the merge and the commit of the batch.
    for name in ("0", ".0.crc"):
        (progress / "commits" / name).unlink(missing_ok=True)
    ingest.ingest_stream(warehouse, str(landing), str(progress))
    (again,) = warehouse.runs().collect()
    assert again.run_id == run.run_id and again.started_at > run.started_at and again.status == "success"
    checks = warehouse.read("data_quality_results")
    assert checks.count() == 12 == checks.filter(F.col("run_id") == run.run_id).count()
    assert sorted((r.dest_airport, r.arrival_delay_min) for r in warehouse.facts().collect()) == facts


def late(january, spark, tmp_path):
    """A correction of one stored flight and a flight without number, stored as a delivery is."""
    rows = january.filter("carrier_code = 'DL'").withColumn("arrival_delay_min", F.lit(99).cast("decimal(18,6)"))
    rows.unionByName(rows.withColumn("flight_number", F.lit(None).cast("string"))).write.parquet(str(tmp_path / "late"))
    return spark.read.parquet(str(tmp_path / "late"))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_late_flights_replace_stored_ones(spark, warehouse, january, tmp_path, threshold):
    """The same rows whether the keys are broadcast or shuffled, and when the delivery is merged again."""
    warehouse.replace_months(months(january, 1, 2).transform(wh.with_flight_id))
    fresh = late(january, spark, tmp_path)
    february = sorted(map(tuple, warehouse.facts().filter("month = 2").collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for _ in range(2):
            assert warehouse.merge_months(fresh) == [(2023, 1)]
            rows = warehouse.facts().filter("month = 1").collect()
            assert sorted((r.carrier_code, r.flight_number is None, int(r.arrival_delay_min)) for r in rows) == sorted(
                [(r.carrier_code, False, int(r.arrival_delay_min)) for r in january.filter("carrier_code <> 'DL'").collect()]
                + [("DL", False, 99), ("DL", True, 99)])
            assert len({r.flight_id for r in rows}) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, warehouse.facts().filter("month = 2").collect())) == february


def test_stored_rows_are_not_shuffled_for_a_small_delivery(spark, warehouse, january, tmp_path):
    warehouse.replace_months(months(january, 1, 2))
    both = wh.merged(warehouse.facts(only=["year=2023/month=1"]), late(january, spark, tmp_path))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_a_month_without_stored_rows_takes_a_delivery(spark, warehouse, january, tmp_path):
    assert warehouse.merge_months(late(january, spark, tmp_path)) == [(2023, 1)]
    assert warehouse.facts().count() == 2


def test_run_ids_differ_and_ascend():
    ids = [load.new_run_id() for _ in range(500)]
    assert len(set(ids)) > 490 and max(ids) < 2 ** 63 and ids[0] >> 12 <= ids[-1] >> 12


def test_only_changed_months_are_read(warehouse, january):
    load.ensure_calendar(warehouse)
    warehouse.replace_months(months(january, 1, 2, 3))
    load.refresh_summaries(warehouse, [2023])
    first = {name: warehouse.units(name) for name in states.STATES}
    warehouse.replace_months(months(january, 2).filter("carrier_code = 'AA'"))
    read = []
    facts = warehouse.facts
    warehouse.facts = lambda only=None: read.append(only) or facts(only)
    load.refresh_summaries(warehouse, [2023])
    warehouse.facts = facts
    assert [o for o in read if o] == [["year=2023/month=2"]]
    for name in states.STATES:
        now = warehouse.units(name)
        assert {u for u in now if now[u] != first[name][u]} == {"year=2023/month=2"}
    read.clear()
    load.refresh_summaries(warehouse, [2023])
    assert [o for o in read if o] == []


def test_summaries_from_states_equal_those_of_the_facts(spark, warehouse, january):
    load.ensure_calendar(warehouse)
    many = months(january, 1, 2, 12).crossJoin(spark.range(40)).withColumn(
        "arrival_delay_min", F.when(F.col("id") % 7 != 0, F.col("arrival_delay_min") + F.col("id"))).drop("id")
    nameless = many.limit(60).withColumn("route", F.lit(None).cast("string"))
    warehouse.replace_months(many.unionByName(nameless).withColumn("carrier_id", F.lit(1)))
    assert load.refresh_summaries(warehouse, [2023], sketches=True) == {}
    facts = warehouse.facts()
    for table, want in (("mv_carrier_performance", summaries.carrier_performance(facts, warehouse.carriers())),
                        ("mv_route_analysis", summaries.route_analysis(facts, warehouse.airports())),
                        ("mv_monthly_summary", summaries.monthly_summary(facts, warehouse.read("dim_date")))):
        names = want.columns
        assert sorted(map(str, warehouse.read(table).select(names).collect())) == sorted(map(str, want.collect())), table
    sketch = {r.carrier_code: r for r in warehouse.read("mv_sketches").collect()}
    assert {c: r.total_flights for c, r in sketch.items()} == {
        r.carrier_code: r["n"] for r in facts.groupBy("carrier_code").agg(F.count("*").alias("n")).collect()}


def test_a_year_without_flights_and_months_without_delays(warehouse, january):
    load.ensure_calendar(warehouse)
    warehouse.replace_months(january.withColumn("arrival_delay_min", F.lit(None).cast("decimal(7,2)")))
    assert load.refresh_summaries(warehouse, [2022, 2023], sketches=True) == {}
    assert {r.year for r in warehouse.read("mv_carrier_performance").collect()} == {2023}
    assert warehouse.read("mv_carrier_performance").filter("avg_delay_min is not null").count() == 0


def test_months_are_merged_some_at_a_time(spark, warehouse, january, tmp_path, monkeypatch):
    """However many months a delivery touches, the rows of some of them are shuffled at once; all appear together."""
    warehouse.replace_months(months(january, 1, 2, 3).transform(wh.with_flight_id))
    fresh = months(late(january, spark, tmp_path), 1, 2, 3, 4)
    want = sorted((r.month, r.flight_number, r.arrival_delay_min) for r in wh.merged(warehouse.facts(), fresh).collect()
                  if r.flight_number is not None)
    assert warehouse._at_once([(2023, m) for m in range(1, 5)]) == [[(2023, m) for m in range(1, 5)]]
    monkeypatch.setattr(wh, "MERGED_AT_ONCE", 1)
    # Nothing is stored of the fourth month.
    assert warehouse._at_once([(2023, m) for m in range(1, 5)]) == [[(2023, 1)], [(2023, 2)], [(2023, 3)], [(2023, 4)]]
    before = spark.read.parquet(warehouse.path("_published")).count()
    assert warehouse.merge_months(fresh) == [(2023, m) for m in range(1, 5)]
    assert sorted((r.month, r.flight_number, r.arrival_delay_min) for r in warehouse.facts().collect()
                  if r.flight_number is not None) == want
    assert spark.read.parquet(warehouse.path("_published")).groupBy("seq").count().count() == 2
    assert spark.read.parquet(warehouse.path("_published")).count() == before + 4
    assert warehouse.facts().select("flight_id").distinct().count() == warehouse.facts().count()
