"""Training the delay classifier from monthly files."""

from functools import reduce

from pyspark.sql import functions as F

from tarmac import schema
from tarmac.operators import model
from tarmac.session import work_folder
from tarmac.sources import raw as src


def training_frame(spark, paths, max_rows_per_file=None):
    """Features of all files, raw CSV or cleaned Parquet, with a `row_id` that tells rows with
    equal features apart. The row limit holds for each file."""
    parquet = [p for p in paths if p.rstrip("/").endswith(".parquet")]
    text = [p for p in paths if p not in parquet]
    frames = []
    if text:
        rows = src.read_flight_files(spark, text, schema.TRAINING_RAW_COLUMNS)
        if max_rows_per_file:
            rows = src.first_rows_per_csv_file(rows, max_rows_per_file)
        at = F.col("input_order")
        place = F.concat_ws(":", at["file"], at["block"], at["position"])
        frames.append(model.features(rows.withColumn("row_id", place), keep=["row_id"]))
    if parquet:
        rows = spark.read.parquet(*parquet)
        columns = rows.columns
        index = F.col("_metadata.row_index")
        if max_rows_per_file:
            rows = rows.filter(index < max_rows_per_file)
        place = F.concat_ws(":", F.col("_metadata.file_path"), index)
        rows = rows.select(*columns, place.alias("row_id"))
        frames.append(model.features(rows, keep=["row_id"]))
    if not frames:
        raise ValueError("no training files")
    return reduce(lambda a, b: a.unionByName(b), frames)


def train_classifier(spark, paths, folder, max_rows_per_file=None, test_share=0.2, seed=42,
                     **forest):
    """Train on all files and store model and metrics in `folder`; returns both."""
    stored = work_folder(spark, "features")
    training_frame(spark, paths, max_rows_per_file).write.parquet(stored)
    frame = spark.read.parquet(stored)
    if not model.both_labels_present(frame):
        raise ValueError("training needs both delayed and punctual flights")
    classifier, report = model.train_and_evaluate(frame, ["row_id"], test_share, seed, **forest)
    model.save(classifier, report, folder)
    return classifier, report
