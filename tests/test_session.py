"""Settings that jobs and registered queries make for themselves."""

from flight_rows import SAMPLE

from __spark_entry__ import queries
from tarmac.session import COMPILED, METHOD_LIMIT


def test_queries_keep_methods_short_enough_to_be_compiled(spark):
    before = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.set(METHOD_LIMIT, "65535")  # Spark's default
        rows = queries()["ml_impute"](spark, SAMPLE)
        assert int(spark.conf.get(METHOD_LIMIT)) == COMPILED
        spark.conf.set(METHOD_LIMIT, "4000")
        assert queries()["ml_impute"](spark, SAMPLE).count() == rows.count()
        assert spark.conf.get(METHOD_LIMIT) == "4000"  # a lower one stays
    finally:
        spark.conf.set(METHOD_LIMIT, before)
