"""Sessions reaching each stage of the conversion funnel, per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event, ratio

COLUMNS = ("event_type", "session_id", "dt", "page_type", "action")

# fixed values: stage names in funnel order
STAGES = ("page_view", "product_view", "cart_event", "purchase")


def stage_counts(events: DataFrame) -> DataFrame:
    """One row per day with the number of sessions that reached each stage.

    Stages are independent of each other and of time order inside the session.
    """
    reached = {
        "page_view": is_event("page_view"),
        "product_view": is_event("product_view"),
        "cart_event": is_event("cart_event") & (F.col("action") == "add"),
        "purchase": is_event("page_view") & (F.col("page_type") == "checkout"),
    }
    sessions = events.groupBy("dt", "session_id").agg(
        *[F.bool_or(reached[s]).alias(s) for s in STAGES]
    )
    return sessions.groupBy("dt").agg(*[F.count_if(F.col(s)).alias(s) for s in STAGES])


def funnel(events: DataFrame) -> DataFrame:
    """Long form: four rows per day with overall and step conversion.

    The stage before is a column of the same row, so neither a self join nor a
    window is needed to compare with it. An empty stage before gives NULL.
    """
    previous = [None, *STAGES[:-1]]
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("stage"),
                    F.col(name).alias("sessions"),
                    (F.col(before) if before else F.lit(None).cast("bigint")).alias("before"),
                    F.when(F.col("dt").isNotNull(), F.col(STAGES[0])).alias("base"),
                )
                for name, before in zip(STAGES, previous)
            ]
        )
    )
    step = F.when(
        F.col("r.before").isNotNull(), ratio(F.col("r.sessions"), F.col("r.before"))
    ).otherwise(F.lit(1.0))
    return stage_counts(events).select("dt", rows.alias("r")).select(
        "dt",
        "r.stage",
        "r.sessions",
        ratio(F.col("r.sessions"), F.col("r.base")).alias("conversion_rate_overall"),
        step.alias("conversion_rate_from_previous"),
    )
