"""Pages with the longest average time, per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event
from footfall.functions.groups import first_rows

COLUMNS = ("event_type", "dt", "page_url", "page_type", "time_on_page_seconds")


def page_statistics(events: DataFrame) -> DataFrame:
    """Views, mean and 95th percentile of time for every page and day."""
    time = "time_on_page_seconds"
    return (
        events.filter(is_event("page_view"))
        .groupBy("dt", "page_url", "page_type")
        .agg(
            F.count(F.lit(1)).alias("views"),
            F.avg(time).alias("avg_time_on_page"),
            F.percentile_approx(time, 0.95).alias("p95_time_on_page"),
        )
    )


def top_pages(events: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` pages of each day by average time; ties by views, url and type."""
    order = [
        F.desc_nulls_last("avg_time_on_page"),
        F.desc("views"),
        F.asc("page_url"),
        F.asc("page_type"),
    ]
    return first_rows(page_statistics(events), ["dt"], order, top_n)
