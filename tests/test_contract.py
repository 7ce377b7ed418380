"""Queries against their SQL on the smallest tables, and the size checks of joins."""

import duckdb
import pytest

import __spark_entry__ as contract
import oracle
from footfall.operators import cleaning
from footfall.plans import catalogue
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()
# The slow ones run in tools/check.py only.
CHECKED = [
    "events_typed", "clean", "top_pages", "bounce_rate", "funnel", "product_gap", "nav_paths",
    "device_country", "anomalies", "validate_verdicts", "quarantine_records", "ingest_summary",
    "metric_rollup_5m", "entity_validation", "dq_outcomes_lineitem", "referential_check",
    "sessions_summary", "anomalies_ranked", "duplicate_ids",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, db, name):
    frame, result = QUERIES[name](spark, FOLDER), db.sql(SQL[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(result.columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "dt"


def test_lookup_join_is_planned_on_its_real_size(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    events = catalogue._deduped(spark, FOLDER, "event_type", "user_id", "device_type")
    small = cleaning.impute_device(events)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small
    before = spark.conf.get(key)
    spark.conf.set(key, "10")
    try:
        large = cleaning.impute_device(events)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert large.count() == events.count()
    finally:
        spark.conf.set(key, before)
