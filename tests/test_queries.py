"""Every registered query against its SQL on DuckDB, and the shape of its plan."""

import pytest
from flight_rows import SAMPLE

from __spark_entry__ import entry
from verification.compare import database, difference
from verification.registry import EXPECTED, QUERIES



def queries():
    """The reference's own operators; those of the corpus have their tests in tests/llm."""
    return QUERIES


def oracle_sql():
    return EXPECTED


SLOW = {"ml_train", "ml_score"}  # 120 trees; the classifier has its own tests


@pytest.fixture(scope="module")
def db():
    return database(SAMPLE)


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(set(queries()) - SLOW))
def test_query(spark, db, name):
    df = queries()[name](spark, SAMPLE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # No Python worker but for digests of files, which are read as streams.
    assert name == "ingest_manifest" or not any(w in plan for w in ("Python", "MapInArrow", "InPandas"))
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, db, sql) is None


def test_only_queries_without_a_fixed_result_lack_sql():
    assert set(queries()) - set(oracle_sql()) == SLOW | {"ingest_manifest"}


def test_report_scans_only_what_it_needs(spark):
    plan = queries()["rep_hubs"](spark, SAMPLE)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in plan
    assert "l_extendedprice" not in plan.split("Physical Plan")[1]


def test_facts_are_reduced_before_they_are_joined(spark):
    for name in ("rep_carrier_ranking", "rep_worst_routes", "rep_hubs", "mv_carrier_performance"):
        plan = queries()[name](spark, SAMPLE)._jdf.queryExecution().optimizedPlan().toString()
        below_join = plan.split("Join LeftOuter", 1)[1]
        assert "Aggregate" in below_join, name


def test_work_folder_is_the_shared_one(spark):
    from tarmac.session import work_folder
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared is None or work_folder(spark, "x").startswith(shared.rstrip("/"))


def test_skewed_tables_give_whole_results(spark, tmp_path):
    """A third of the flights are copies of one row."""
    import duckdb
    db = duckdb.connect()
    for name in ("lineitem", "supplier", "nation"):
        db.execute(f"CREATE VIEW src_{name} AS SELECT * FROM read_parquet('{SAMPLE}/{name}.parquet')")
        rows = f"SELECT * FROM src_{name}"
        if name == "lineitem":
            rows += """ UNION ALL SELECT one.* FROM (SELECT * FROM src_lineitem LIMIT 1) one,
                (SELECT 1 FROM src_lineitem LIMIT 3000)"""
        db.execute(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    skewed = database(tmp_path)
    for name in ("dedup_keep_last", "dq_unique", "transform_stats", "mv_route_analysis",
                 "mv_carrier_performance", "rep_hubs", "dim_airport_codes", "dq_ref_integrity"):
        assert difference(queries()[name](spark, str(tmp_path)), skewed, oracle_sql()[name]) is None
