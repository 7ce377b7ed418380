"""Share of one-page sessions by landing page type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event, ratio

COLUMNS = ("event_id", "event_type", "session_id", "event_ts", "dt", "page_type")


def landings(events: DataFrame) -> DataFrame:
    """First page view and number of page views of every session.

    A session is its id alone, so one that runs over midnight counts on the day
    it landed. Landing and count come from one aggregation with map-side combine.
    """
    views = events.filter(is_event("page_view") & F.col("session_id").isNotNull())
    first = F.min(F.struct("event_ts", "event_id", "dt", "page_type"))
    return (
        views.groupBy("session_id")
        .agg(first.alias("landing"), F.count(F.lit(1)).alias("page_views"))
        .select(
            "session_id",
            F.col("landing.dt").alias("dt"),
            F.col("landing.page_type").alias("landing_page_type"),
            "page_views",
        )
    )


def bounce_rate(events: DataFrame) -> DataFrame:
    """Sessions, one-page sessions and their ratio by day and landing page type."""
    return (
        landings(events)
        .groupBy("dt", "landing_page_type")
        .agg(
            F.count(F.lit(1)).alias("total_sessions"),
            F.count_if(F.col("page_views") == 1).alias("bounce_sessions"),
        )
        .withColumn("bounce_rate", ratio(F.col("bounce_sessions"), F.col("total_sessions")))
    )
