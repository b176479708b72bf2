import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flight_rows import RAW_HEADER  # noqa: E402
from tarmac.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    from tarmac.plans.warehouse import Warehouse
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def raw(spark):
    def build(*rows):
        from pyspark.sql import functions as F
        from pyspark.sql import types as T
        layout = T.StructType(
            [T.StructField(c, T.StringType()) for c in RAW_HEADER]
            + [T.StructField("position", T.LongType())])
        data = [tuple(r[c] or None for c in RAW_HEADER) + (i,) for i, r in enumerate(rows)]
        return spark.createDataFrame(data, layout).select(
            *RAW_HEADER, F.struct("position").alias("input_order"))
    return build
