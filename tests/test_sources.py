import hashlib
import json

import pytest
from flight_rows import RAW_HEADER, raw_row, write_csv
from pyspark.sql import functions as F

from tarmac.functions import periods
from tarmac.operators import clean
from tarmac.sources import raw as src


def test_tokens_and_blank_column(spark, tmp_path):
    tokens = ["", " ", "NA", "N/A", ".", "NaN", "null", "12"]
    path = write_csv(tmp_path / "a.csv", [raw_row(ArrDelay=t) for t in tokens])
    rows = src.read_flight_files(spark, path)
    assert set(RAW_HEADER) < set(rows.columns)
    assert not [c for c in rows.columns if c.startswith("_c")]
    got = [r.ArrDelay for r in rows.orderBy("input_order").collect()]
    assert got == [None] * 7 + ["12"]


def test_files_are_read_by_their_own_header(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [raw_row()])
    write_csv(tmp_path / "b.csv", [raw_row(Origin="SFO")], header=RAW_HEADER[:-1][::-1])
    (tmp_path / "empty.csv").write_text("")
    rows = src.read_flight_files(spark, [str(tmp_path / f"{x}.csv") for x in ("a", "b", "empty")])
    got = rows.orderBy("Origin").select("Origin", "Dest", "ArrDelay", "DayOfWeek").collect()
    assert [tuple(r) for r in got] == [("JFK", "LAX", "20.00", "7"), ("SFO", "LAX", "20.00", None)]
    with pytest.raises(ValueError, match="no flight files"):
        src.read_flight_files(spark, str(tmp_path / "empty.csv"))


def test_later_row_of_a_file_is_greater(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv",
                     [raw_row(ArrDelay="1.00"), raw_row(ArrDelay="2.00")])
    kept = src.read_flight_files(spark, path).transform(clean.clean_flights).collect()
    assert [float(r.arrival_delay_min) for r in kept] == [2.0]


def test_first_rows_per_file_over_many_blocks(spark, tmp_path):
    for name, n in (("a", 300), ("b", 120), ("c", 5)):
        write_csv(tmp_path / f"{name}.csv",
                  [raw_row(Flight_Number_Reporting_Airline=str(i)) for i in range(n)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = src.read_flight_files(spark, str(tmp_path))
        assert rows.select(F.col("input_order.block")).distinct().count() > 3
        first = src.first_rows_per_csv_file(rows, 100)
        got = (
            first.groupBy(F.element_at(F.split("source_file", "/"), -1).alias("f"))
            .agg(F.count("*").alias("n"),
                 F.max(F.col("Flight_Number_Reporting_Airline").cast("int")).alias("last"))
            .orderBy("f").collect()
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in got] == [("a.csv", 100, 99), ("b.csv", 100, 99), ("c.csv", 5, 4)]


def test_first_rows_of_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(500).coalesce(1).write.parquet(path)
    got = src.first_rows_per_parquet_file(spark, path, ["id"], 7).collect()
    assert sorted(r.id for r in got) == list(range(7))


def test_airport_and_airline_documents(spark, tmp_path):
    airports = tmp_path / "airports.json"
    airports.write_text(json.dumps([
        {"iata_code": "JFK", "airport_name": "Kennedy", "city_iata_code": "NYC",
         "country_iso2": "US", "latitude": "40.64", "longitude": "-73.78", "gmt": "-5"},
        {"iata_code": "LAX"},
    ], indent=2))
    got = src.read_airport_reference(spark, str(airports)).orderBy("iata_code").collect()
    assert (got[0].city, float(got[0].latitude), float(got[0].utc_offset_hrs)) == ("NYC", 40.64, -5)
    assert (got[1].airport_name, got[1].country_code, got[1].latitude) == ("", "US", None)

    airlines = tmp_path / "airlines.json"
    airlines.write_text(json.dumps([
        {"iata_code": "AA", "airline_name": "American", "status": "ACTIVE"},
        {"iata_code": "PA", "airline_name": "Pan Am", "status": "defunct"}, {"iata_code": "ZZ"},
    ]))
    got = src.read_airline_reference(spark, str(airlines)).orderBy("carrier_code").collect()
    assert [r.is_active for r in got] == [True, False, False]


def test_manifest(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [raw_row()])
    row = src.file_manifest(spark, str(tmp_path), "*.csv").first()
    content = open(path, "rb").read()
    assert (row.file_bytes, row.md5) == (len(content), hashlib.md5(content).hexdigest())


def test_manifest_of_a_file_beyond_two_gigabytes(spark, tmp_path):
    size = 2_600_000_000  # a sparse file: no bytes on disk
    with open(tmp_path / "large one.csv", "wb") as file:
        file.truncate(size)
    (tmp_path / "empty.csv").write_bytes(b"")
    want, block = hashlib.md5(), bytes(1 << 24)
    for start in range(0, size, len(block)):
        want.update(block[:min(len(block), size - start)])
    got = {r.source_file.rsplit("/")[-1]: (r.file_bytes, r.md5) for r in src.file_manifest(spark, str(tmp_path)).collect()}
    assert got == {"large one.csv": (size, want.hexdigest())}


def test_manifest_of_a_path_that_tasks_cannot_open(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "a.csv", [raw_row()])
    by_path = src.file_manifest(spark, str(tmp_path)).collect()
    monkeypatch.setattr(src.files, "openable", lambda path: False)
    assert src.file_manifest(spark, str(tmp_path)).collect() == by_path
    assert list(src.layouts(spark, str(tmp_path)).values()) == [[by_path[0].source_file]]


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_layouts_take_as_many_jobs_for_many_files(spark, tmp_path):
    import gzip
    for n in (4, 40):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            header = [RAW_HEADER, RAW_HEADER[:-1][::-1]][i % 2]
            write_csv(folder / f"{i} é.csv", [raw_row()], header=header)
    zipped = (tmp_path / "4" / "0 é.csv").read_bytes()
    (tmp_path / "40" / "z.csv.gz").write_bytes(gzip.compress(zipped))
    (tmp_path / "40" / "blank.csv").write_text("\n \n" + zipped.decode())
    few, jobs_for_few = jobs_of(spark, "few", lambda: src.layouts(spark, str(tmp_path / "4")))
    many, jobs_for_many = jobs_of(spark, "many", lambda: src.layouts(spark, str(tmp_path / "40")))
    assert sorted(map(len, few.values())) == [2, 2] and sorted(map(len, many.values())) == [20, 22]
    # The file with blank lines has its header in another line, not another layout.
    assert jobs_for_many <= jobs_for_few + 2
    assert src.read_flight_files(spark, str(tmp_path / "40")).count() == 42


def test_periods():
    assert periods.month_list(all_months=True) == list(range(1, 13))
    assert periods.month_list(months="3-5") == [3, 4, 5]
    assert periods.month_list(months="1,3,6") == [1, 3, 6]
    assert periods.month_list(month=7) == [7]
    with pytest.raises(ValueError):
        periods.month_list()
    with pytest.raises(ValueError):
        periods.month_list(months="0-2")
    assert periods.monthly_paths("/x", 2023, 4) == "/x/2023/flights_2023_04.csv"
    assert periods.monthly_paths("/x", 2023) == "/x/2023/flights_2023_*.csv"


def test_reference_documents_in_every_form(spark, tmp_path):
    import json

    from tarmac.sources import raw
    service = {"iata_code": "YYZ", "airport_name": "Pearson", "city_iata_code": "YTO", "country_iso2": "CA", "gmt": "-5"}
    saved = {"iata_code": "YYZ", "airport_name": "Pearson", "city": "YTO", "country_code": "CA", "utc_offset_hrs": "-5"}
    for k, document in enumerate(([service], [saved], {"data": [service]})):
        path = tmp_path / f"airports{k}.json"
        path.write_text(json.dumps(document, indent=2))
        row = raw.read_airport_reference(spark, str(path)).collect()
        assert [(r["iata_code"], r["city"], r["country_code"], int(r["utc_offset_hrs"])) for r in row] == [
            ("YYZ", "YTO", "CA", -5)]
    line = {"carrier_code": "AA", "carrier_name": "American", "country_code": "US", "is_active": True}
    path = tmp_path / "airlines.json"
    path.write_text(json.dumps([line, {"iata_code": "ZZ", "airline_name": "Z", "status": "Active"}]))
    got = raw.read_airline_reference(spark, str(path)).collect()
    assert [(r["carrier_code"], r["carrier_name"], r["is_active"]) for r in got] == [
        ("AA", "American", True), ("ZZ", "Z", True)]
