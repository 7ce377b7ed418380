"""Daily batch: clean the events of a day (or of all days) and write seven metrics."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.cleaning import (
    COPIES,
    Lookups,
    build_lookups,
    count_copies,
    fill_and_normalize,
    with_ids,
)
from footfall.operators.metrics import METRICS
from footfall.schema import METRIC_INPUT_COLUMNS
from footfall.session import build_session
from footfall.sources.events import ALL_DAYS, read_event_days
from footfall.sources.metric_store import table_path, write_days
from footfall.sources.staging import stage, staging_scope

log = logging.getLogger(__name__)


def _write_metric(name: str, deduped: DataFrame, lookups: Lookups, base: str, options) -> int:
    metric = METRICS[name]
    events = fill_and_normalize(deduped, lookups, metric.columns)
    result = metric.compute(events, **options.get(name, {}))
    return write_days(result, table_path(base, name))


def run_daily(
    raw: DataFrame,
    output: str,
    metrics: Iterable[str] = tuple(METRICS),
    options: dict[str, dict] | None = None,
    parallel: int = 4,
) -> dict:
    """Clean ``raw`` once and write the metrics under ``output``.

    The deduplicated events are staged with only the columns metrics read; every
    metric then scans its own columns of that table. Several metrics run at a
    time, so the small last stages of one overlap with another.
    """
    spark = raw.sparkSession
    with staging_scope(spark):
        staged = stage(count_copies(raw.select(*METRIC_INPUT_COLUMNS)), "events", "event_type")
        totals = staged.agg(
            F.coalesce(F.sum(F.abs(COPIES)), F.lit(0)).alias("raw"),
            F.count_if(F.col(COPIES) > 0).alias("clean"),
        ).first()
        if totals["raw"] == 0:
            log.warning("no events")
            return {"events_processed": 0}
        deduped = with_ids(staged)
        lookups = build_lookups(deduped, METRIC_INPUT_COLUMNS)
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            jobs = {
                name: pool.submit(
                    copy_context().run, _write_metric, name, deduped, lookups, output, options or {}
                )
                for name in metrics
            }
            rows = {name: job.result() for name, job in jobs.items()}
    return {"events_raw": totals["raw"], "events_clean": totals["clean"], "metrics": rows}


def run(spark: SparkSession, source: str, output: str, run_date: str | None = None) -> dict:
    """Read the landing zone and run the daily batch over one day or all days."""
    return run_daily(read_event_days(spark, source, run_date), output)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="landing zone with year=/month=/day=")
    parser.add_argument("--output", required=True, help="base folder of the metric tables")
    parser.add_argument("--date", default=ALL_DAYS, help="YYYY-MM-DD, or all")
    parser.add_argument("--log-level", default="INFO")
    args = parser.parse_args(argv)
    logging.basicConfig(level=args.log_level)
    spark = build_session("footfall-daily")
    try:
        summary = run(spark, args.input, args.output, args.date)
    finally:
        spark.stop()
    print(json.dumps(summary))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
