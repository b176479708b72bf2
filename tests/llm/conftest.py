import pytest
from pyspark.sql import types as T

from tarmac.llm.common import ship_code

SHAPE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                      T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType())])


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang, source); a last column clashes with names the operators add."""
    ship_code(spark)

    def build(*rows):
        full = [(r[0], r[1], *(list(r[2:]) + ["en", "s"][len(r) - 2:])) for r in rows]
        return spark.createDataFrame(
            [(*r, len(r[1]) if r[1] is not None else None, "x") for r in full], SHAPE)
    return build
