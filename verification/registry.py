"""Register a query together with the SQL that gives its expected result."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.session import keep_methods_compiled
from verification.sql_text import with_flights

QUERIES = {}
EXPECTED = {}


def query(name, sql=None, raw_sql=None):
    """`sql` is a SELECT over the derived flights, `raw_sql` a whole statement."""
    def register(build):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: run(build, spark, folder)
        if sql or raw_sql:
            EXPECTED[name] = raw_sql or with_flights(sql)
        return build
    return register


def run(build, spark, folder):
    keep_methods_compiled(spark)
    return plain(build(spark, folder))


def plain(df):
    """Decimals as double and small integers as int, as the SQL side returns them."""
    def simple(field):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.ShortType):
            return F.col(field.name).cast("int").alias(field.name)
        return F.col(field.name)

    kinds = {type(f.dataType) for f in df.schema.fields}
    if kinds & {T.DecimalType, T.ShortType}:
        return df.select([simple(f) for f in df.schema.fields])
    return df
