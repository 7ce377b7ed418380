"""Typed scan of JSON-lines events and the date-partitioned landing layout."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schema import EVENT_SCHEMA

ALL_DAYS = "all"
_LAYOUT = ("year", "month", "day")


def with_time_columns(df: DataFrame) -> DataFrame:
    """Add ``event_ts``, ``dt`` and ``hour``; unreadable timestamps give NULL."""
    return (
        df.withColumn("event_ts", F.try_to_timestamp("timestamp"))
        .withColumn("dt", F.to_date("event_ts"))
        .withColumn("hour", F.hour("event_ts"))
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Scan JSON lines with the fixed schema (no inference pass over the data)."""
    return with_time_columns(spark.read.schema(EVENT_SCHEMA).json(path))


def parse_day(run_date: str | None) -> date | None:
    """A calendar day, or None for every day."""
    if run_date in (None, "", ALL_DAYS):
        return None
    return date.fromisoformat(run_date)


def on_day(df: DataFrame, run_date: str | None) -> DataFrame:
    """Keep rows whose own timestamp falls on the day, whatever folder they came from."""
    day = parse_day(run_date)
    return df if day is None else df.filter(F.col("dt") == F.lit(day))


def read_event_days(spark: SparkSession, base: str, run_date: str | None = None) -> DataFrame:
    """Events of one day, or of all days, from ``base/year=/month=/day=``.

    For a day only its own folder is listed; a day without a folder has no events.
    """
    scan = (
        spark.read.schema(EVENT_SCHEMA)
        .option("basePath", base)
        .option("pathGlobFilter", "*.json*")
    )
    day = parse_day(run_date)
    if day is None:
        return with_time_columns(scan.json(base).drop(*_LAYOUT))
    folder = f"{base.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"
    try:
        found = scan.json(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return with_time_columns(spark.createDataFrame([], EVENT_SCHEMA))
    of_day = (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    return on_day(with_time_columns(found.filter(of_day).drop(*_LAYOUT)), run_date)


def with_day_folders(df: DataFrame, day_column: str = "dt") -> DataFrame:
    """Add zero-padded ``year``, ``month``, ``day`` partition columns."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd"}
    return df.withColumns({c: F.date_format(day_column, p) for c, p in patterns.items()})


def write_event_days(df: DataFrame, base: str, mode: str = "overwrite") -> None:
    """Land events as ``base/year=YYYY/month=MM/day=DD/``.

    The rebalance keeps each day together while small and splits a day that is
    larger than Spark's advisory partition size.
    """
    names = [part.split()[0] for part in EVENT_SCHEMA.replace("\n", " ").split(",")]
    days = with_day_folders(df.withColumn("dt", F.to_date(F.try_to_timestamp("timestamp"))))
    (
        days.select(*names, *_LAYOUT)
        .hint("rebalance", *_LAYOUT)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_LAYOUT)
        .json(base)
    )
