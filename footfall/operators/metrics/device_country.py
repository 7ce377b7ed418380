"""Page views, time on page and sessions by device and country, per day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event
from footfall.sources.staging import stage

COLUMNS = ("event_type", "session_id", "dt", "device_type", "country", "time_on_page_seconds")
_KEYS = ("dt", "device_type", "country")


def device_country(events: DataFrame) -> DataFrame:
    """Counts, average and 95th percentile of time, and exact distinct sessions.

    Counting sessions next to a percentile would carry one quantile sketch per
    session through the shuffle. So the counts go through one row per session and
    the sketches through one row per segment, and the two small results are joined.
    The page views are staged first: filling in devices is a join by user, which may
    shuffle, and both branches would repeat it.
    Averages are taken on decimals, where a tie at the second place always rounds up.
    """
    columns = (*_KEYS, "session_id", "time_on_page_seconds")
    views = stage(events.filter(is_event("page_view")).select(*columns), "segments")
    time = F.col("time_on_page_seconds")
    sessions = views.groupBy(*_KEYS, "session_id").agg(
        F.count(F.lit(1)).alias("views"),
        F.sum(time.try_cast("decimal(24,4)")).alias("seconds"),
        F.count(time).alias("timed"),
    )
    average = F.try_divide(
        F.sum("seconds").cast("decimal(34,4)"), F.sum("timed").cast("decimal(20,0)")
    )
    counts = sessions.groupBy(*_KEYS).agg(
        F.sum("views").alias("page_views"),
        F.round(average, 2).cast("double").alias("avg_time_on_page"),
        F.count("session_id").alias("unique_sessions"),
    )
    quantiles = views.groupBy(*_KEYS).agg(
        F.round(F.percentile_approx(time, 0.95), 2).alias("p95_time_on_page")
    )
    c, q = counts.alias("c"), quantiles.alias("q")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"q.{k}")) for k in _KEYS])
    return c.join(q, same).select(
        *[f"c.{k}" for k in _KEYS],
        "page_views",
        "avg_time_on_page",
        "p95_time_on_page",
        "unique_sessions",
    )
