"""Page statistics of any range of days from sketches that are kept per day.

Quantiles and distinct counts of a range cannot be added up from those of its days;
sketches can. A day's events are read once, and a range reads one row per page and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event

COLUMNS = ("event_type", "dt", "page_url", "page_type", "session_id", "time_on_page_seconds")

#: Size parameter of the quantile sketch: ranks are off by at most about 0.1 %, and values
#: are exact while a page has fewer views than this.
QUANTILE_SIZE = 4096
#: Log2 of the values the distinct sketch holds: exact up to 65 536 sessions, then off by
#: about 0.4 % (one standard deviation).
DISTINCT_SIZE = 16


def page_sketches(events: DataFrame) -> DataFrame:
    """Views, and sketches of time and sessions, for every page and day."""
    return (
        events.filter(is_event("page_view"))
        .groupBy("dt", "page_url", "page_type")
        .agg(
            F.count(F.lit(1)).alias("views"),
            F.kll_sketch_agg_double("time_on_page_seconds", QUANTILE_SIZE).alias("times"),
            F.theta_sketch_agg("session_id", DISTINCT_SIZE).alias("sessions"),
        )
    )


def pages_over_days(sketches: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Views, distinct sessions and a quantile of time of each page over all given days.

    The quantile is NULL for a page without any time.
    """
    merged = sketches.groupBy("page_url", "page_type").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("views").alias("views"),
        F.kll_merge_agg_double("times", QUANTILE_SIZE).alias("times"),
        F.theta_union_agg("sessions", DISTINCT_SIZE).alias("sessions"),
    )
    timed = F.kll_sketch_get_n_double("times") > 0
    return merged.select(
        "page_url",
        "page_type",
        "days",
        "views",
        F.theta_sketch_estimate("sessions").alias("unique_sessions"),
        F.when(timed, F.kll_sketch_get_quantile_double("times", F.lit(quantile))).alias(
            "time_quantile"
        ),
    )
