"""Warehouse load: metric tables through the quality gate into the facts."""

from __future__ import annotations

import argparse
import json
import logging
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from footfall.operators.quality import gate, passing_rows, require_references
from footfall.operators.rulesets import RULE_SETS, rules_for
from footfall.operators.warehouse import (
    FACT_TABLES,
    absent_rows,
    to_fact,
    with_load_stamp,
)
from footfall.session import build_session
from footfall.sources.events import ALL_DAYS
from footfall.sources.jdbc import jdbc_mode, jdbc_options, write_jdbc
from footfall.sources.metric_store import (
    APPEND,
    REPLACE_ALL,
    REPLACE_DAYS,
    read_metric,
    table_path,
    write_days,
)

log = logging.getLogger(__name__)


def load_metric(
    spark: SparkSession,
    metric: str,
    metrics_base: str,
    facts_base: str,
    run_date: str = ALL_DAYS,
    mode: str = REPLACE_DAYS,
    rules=None,
    results: str | None = None,
    dates: DataFrame | None = None,
    exact: bool = False,
    jdbc: dict[str, str] | None = None,
) -> bool:
    """Load one metric; False if it has no rows for the date.

    A failed rule raises before anything is written. With ``jdbc`` the rows go to
    a database table instead of the Parquet facts.
    """
    source = read_metric(spark, metrics_base, metric, run_date)
    if source.isEmpty():
        log.warning("%s: nothing for %s", metric, run_date)
        return False
    rules = rules_for(metric) if rules is None else rules
    fact = gate(to_fact(metric, source, exact), rules, f"dq_{metric}", results)
    if dates is not None:
        fact = require_references(fact, dates, "dt")
    rows = with_load_stamp(passing_rows(fact, rules), metric)
    if jdbc is not None:
        write_jdbc(rows, {**jdbc, "dbtable": FACT_TABLES[metric]}, jdbc_mode(mode))
    else:
        write_days(rows, table_path(facts_base, FACT_TABLES[metric]), mode)
    return True


def load_all(
    spark: SparkSession,
    metrics_base: str,
    facts_base: str,
    only=None,
    rule_set: str = "load",
    **options,
) -> dict:
    """Load every metric, or ``only`` one; the first failure stops the run."""
    names = FACT_TABLES if only in (None, ALL_DAYS) else [only]
    return {
        name: load_metric(
            spark, name, metrics_base, facts_base, rules=rules_for(name, rule_set), **options
        )
        for name in names
    }


def add_missing(new: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows of a dimension that its table does not have yet."""
    spark = new.sparkSession
    empty = spark.createDataFrame([], new.schema)
    try:
        existing = spark.read.schema(new.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = empty
    absent_rows(new, existing, keys).write.mode("append").parquet(path)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--metrics", required=True, help="base folder of the metric tables")
    parser.add_argument("--facts", required=True, help="base folder of the fact tables")
    parser.add_argument("--date", default=ALL_DAYS, help="YYYY-MM-DD, or all")
    parser.add_argument("--metric", default=ALL_DAYS, help="one metric, or all")
    parser.add_argument("--mode", default=REPLACE_DAYS, choices=[REPLACE_DAYS, REPLACE_ALL, APPEND])
    parser.add_argument("--rules", default="load", choices=list(RULE_SETS), help="set of rules")
    parser.add_argument("--results", help="folder for quality results")
    parser.add_argument("--exact", action="store_true", help="warehouse numeric types")
    parser.add_argument("--jdbc-url", help="load into a database instead of the fact folder")
    parser.add_argument("--jdbc-partitions", type=int, help="connections that write at a time")
    args = parser.parse_args(argv)
    jdbc = None
    if args.jdbc_url:
        # credentials stay out of the command line
        user, password = os.environ.get("DB_USER"), os.environ.get("DB_PASSWORD")
        jdbc = jdbc_options(
            args.jdbc_url, "", user, password, partitions=args.jdbc_partitions
        )
    spark = build_session("footfall-load")
    try:
        loaded = load_all(
            spark,
            args.metrics,
            args.facts,
            only=args.metric,
            rule_set=args.rules,
            run_date=args.date,
            mode=args.mode,
            results=args.results,
            exact=args.exact,
            jdbc=jdbc,
        )
    finally:
        spark.stop()
    print(json.dumps(loaded))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
