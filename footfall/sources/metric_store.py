"""Metric and fact tables as Parquet, partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from footfall.operators.metrics import METRIC_SCHEMAS
from footfall.sources.events import parse_day

REPLACE_DAYS, REPLACE_ALL, APPEND = "replace_days", "replace_all", "append"


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def write_days(df: DataFrame, path: str, mode: str = REPLACE_DAYS) -> int:
    """Write a table partitioned by ``dt``.

    ``replace_days`` overwrites only the days present in ``df``, so running a day
    again is harmless; ``replace_all`` drops every other day; ``append`` adds.
    The rebalance writes one file per small day and splits a day that outgrows a
    partition, instead of sending all rows to one writer.

    Returns the number of rows. They are counted by the tasks that write, after
    the last shuffle, so a repeated stage cannot count a row twice.
    """
    overwrite = {REPLACE_DAYS: "dynamic", REPLACE_ALL: "static", APPEND: "static"}[mode]
    written = Observation()
    (
        df.hint("rebalance", "dt")
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("append" if mode == APPEND else "overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .partitionBy("dt")
        .parquet(path)
    )
    return written.get["rows"]


def read_days(
    spark: SparkSession, path: str, run_date: str | None = None, schema: str | None = None
) -> DataFrame:
    """A table of all days, or of one: the day prunes folders before any read.

    ``dt`` comes from the folder names. With ``schema`` no file is opened for its
    types, and a table that has no row yet reads as empty.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    df = df.withColumn("dt", F.col("dt").cast("date"))
    day = parse_day(run_date)
    return df if day is None else df.filter(F.col("dt") == F.lit(day))


def read_metric(
    spark: SparkSession, base: str, metric: str, run_date: str | None = None
) -> DataFrame:
    """One of the seven metric tables below ``base``."""
    return read_days(spark, table_path(base, metric), run_date, METRIC_SCHEMAS[metric])
