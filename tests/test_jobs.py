import json

import pytest
from flight_rows import raw_row, write_csv

from tarmac import jobs
from tarmac.operators import model
from tarmac.plans import training


def flights(n, month=1):
    """Evening flights are late."""
    rows = []
    for i in range(n):
        hour = i % 24
        late = hour > 11
        rows.append(raw_row(
            FlightDate=f"2023-{month:02d}-{i % 28 + 1:02d}", Month=str(month),
            Flight_Number_Reporting_Airline=str(i), CRSDepTime=f"{hour:02d}15",
            ArrDelay="40.00" if late else "-4.00", CarrierDelay="40.00" if late else "",
            Dest=["LAX", "SFO", "ORD"][i % 3]))
    return rows


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing" / "2023"
    folder.mkdir(parents=True)
    for month in (1, 2):
        write_csv(folder / f"flights_2023_{month:02d}.csv", flights(600, month))
    return tmp_path / "landing"


def test_load_months(spark, tmp_path, landing):
    args = jobs.arguments(["load", "--warehouse", str(tmp_path / "w"), "--landing", str(landing),
                           "--year", "2023", "--months", "1-2", "--run-type", "backfill"])
    first = jobs.run(spark, args)
    assert [s["rows_loaded"] for s in first] == [600, 600]
    assert [s["status"] for s in jobs.run(spark, args)] == ["skipped", "skipped"]


def test_sample_per_file_is_split_and_trained(spark, tmp_path, landing):
    files = [str(p) for p in sorted((landing / "2023").glob("*.csv"))]
    frame = training.training_frame(spark, files, 500)
    assert frame.count() == 1000 == frame.select("row_id").distinct().count()
    jobs.run(spark, jobs.arguments(
        ["train", *files, "--output", str(tmp_path / "m"), "--max-rows-per-file", "500"]))
    part = next((tmp_path / "m" / "metrics").glob("part-*.json"))
    metrics = json.loads(part.read_text())
    assert (metrics["rows_total"], metrics["rows_test"]) == (1000, 200)
    assert metrics["roc_auc"] > 0.9
    assert "distance_miles" in metrics["features"] and metrics["trained_at"]
    frame.limit(50).drop("is_delayed").write.parquet(str(tmp_path / "in"))
    jobs.run(spark, jobs.arguments(["score", "--model", str(tmp_path / "m"), "--input",
                                    str(tmp_path / "in"), "--output", str(tmp_path / "out")]))
    assert spark.read.parquet(str(tmp_path / "out" / "scored")).count() == 50
    assert spark.read.parquet(str(tmp_path / "out" / "rejected")).count() == 0


def test_parquet_and_csv_together(spark, tmp_path, landing):
    from tarmac.operators import clean
    from tarmac.sources.raw import read_flight_files
    files = [str(p) for p in sorted((landing / "2023").glob("*.csv"))]
    cleaned = str(tmp_path / "clean.parquet")
    read_flight_files(spark, files[0]).transform(clean.clean_flights).write.parquet(cleaned)
    frame = training.training_frame(spark, [cleaned, files[1]])
    assert frame.count() == 1200 == frame.select("row_id").distinct().count()
    assert training.training_frame(spark, [cleaned], 10).count() <= 40
    with pytest.raises(ValueError):
        training.training_frame(spark, [])


def test_one_label_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "f.csv", [r for r in flights(100) if r["ArrDelay"] != "40.00"])
    with pytest.raises(ValueError, match="both delayed"):
        training.train_classifier(spark, [path], str(tmp_path / "m"))
    assert not model.both_labels_present(training.training_frame(spark, [path]))
