"""Quick looks at raw events and stored metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event


def event_type_counts(events: DataFrame) -> DataFrame:
    """Rows per event type, largest first."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).orderBy(
        F.desc("events"), F.asc("event_type")
    )


def page_view_nulls(events: DataFrame) -> DataFrame:
    """Missing values of the page-view columns that cleaning deals with."""
    columns = {
        "null_country": "country",
        "null_device": "device_type",
        "null_time": "time_on_page_seconds",
        "null_event_id": "event_id",
    }
    return events.filter(is_event("page_view")).agg(
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in columns.items()]
    )


def duplicate_ids(events: DataFrame) -> DataFrame:
    """Number of event ids seen more than once."""
    seen = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    return seen.agg(F.count_if(F.col("copies") > 1).alias("duplicate_ids"))


def metric_row_counts(tables: dict[str, DataFrame], day=None) -> DataFrame:
    """Rows of each metric table, of one day or of all."""
    counts = []
    for name, df in tables.items():
        rows = df if day is None else df.filter(F.col("dt") == F.lit(day).cast("date"))
        counts.append(rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("metric", F.lit(name)))
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out.select("metric", "rows")
