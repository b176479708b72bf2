"""Places of rows within groups of any size, without gathering a group in one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm.common import stored


def sorted_rows(df, group, order):
    """Rows stored in ranges of (`group`, `order`), each with `at`: number of its range and row."""
    by = [F.col(c) for c in (group, *order)]
    return stored(df.repartitionByRange(*by).sortWithinPartitions(*by)
                  .withColumn("at", F.monotonically_increasing_id()), "sorted")


def runs(rows, group):
    """(`group`, range, first, before, total) of every group in every range.

    There are at most as many rows as ranges and groups together, and a group has at most one in each range.
    """
    found = rows.groupBy(group, F.shiftright("at", 33).alias("range")).agg(
        F.min("at").alias("first"), F.count("*").alias("here"))
    own = Window.partitionBy(group)
    before = F.sum("here").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    return stored(found.select(group, "range", "first", F.coalesce(before, F.lit(0)).alias("before"),
                               F.sum("here").over(own).alias("total")), "runs")


def placed(rows, runs_, group, added=()):
    """`rows` with `idx`, the place in its group from 0, `total`, and columns added to the runs."""
    runs_ = runs_.select(F.col(group).alias("run_group"), F.col("range").alias("run_range"),
                         "first", "before", "total", *added)
    on = (F.col(group).eqNullSafe(F.col("run_group"))
          & (F.shiftright("at", 33) == F.col("run_range")))
    return rows.join(runs_, on).withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop(
        "run_group", "run_range", "first", "before", "at")
