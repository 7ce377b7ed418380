"""Most frequent navigation paths, per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event
from footfall.functions.groups import first_rows

COLUMNS = ("event_type", "session_id", "event_ts", "dt", "page_type")


def session_paths(events: DataFrame, max_path_length: int = 10) -> DataFrame:
    """Path of page types of each session and day, cut at ``max_path_length`` steps.

    Only the first steps of a session reach the shuffle and the list, however
    many page views it has.
    """
    steps = first_rows(
        events.filter(is_event("page_view")).select("dt", "session_id", "event_ts", "page_type"),
        ["dt", "session_id"],
        [F.asc("event_ts"), F.asc("page_type")],
        max_path_length,
    )
    ordered = F.sort_array(F.collect_list(F.struct("event_ts", "page_type")))
    pages = F.transform("steps", lambda step: step["page_type"])
    return (
        steps.groupBy("dt", "session_id")
        .agg(ordered.alias("steps"))
        .select(
            "dt",
            "session_id",
            F.concat_ws("->", pages).alias("path"),
            F.size("steps").alias("path_length"),
        )
    )


def nav_paths(events: DataFrame, top_n: int = 10, max_path_length: int = 10) -> DataFrame:
    """The ``top_n`` paths of each day by number of sessions; ties by path."""
    paths = (
        session_paths(events, max_path_length)
        .groupBy("dt", "path")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.round(F.avg("path_length"), 2).alias("avg_path_length"),
        )
    )
    return first_rows(paths, ["dt"], [F.desc("sessions"), F.asc("path")], top_n)
