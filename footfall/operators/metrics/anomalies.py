"""Sessions that stand out from their day by z-score or interquartile range."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import computed_once, is_event, whole_seconds
from footfall.sources.staging import stage

COLUMNS = ("event_type", "session_id", "user_id", "event_ts", "dt", "page_url")

# fixed values: features, thresholds and the label each feature gives, first match wins
FEATURES = ("total_events", "session_duration_seconds", "unique_pages", "events_per_minute")
Z_LIMIT = 3.0
IQR_FACTOR = 1.5
MIN_FLAGS = 2
LABELS = {
    "events_per_minute": "high_velocity",
    "session_duration_seconds": "extreme_duration",
    "total_events": "high_volume",
    "unique_pages": "extreme_breadth",
}
OTHER_LABEL = "other"


def session_features(events: DataFrame) -> DataFrame:
    """Four indicators of every (day, session, user)."""
    page = F.when(is_event("page_view"), F.col("page_url"))
    span = whole_seconds(F.max("event_ts")) - whole_seconds(F.min("event_ts"))
    pace = F.try_divide(F.col("total_events") * 60.0, F.col("session_duration_seconds"))
    return (
        events.groupBy("dt", "session_id", "user_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct(page).alias("unique_pages"),
            span.cast("double").alias("session_duration_seconds"),
        )
        .withColumn(
            "events_per_minute",
            F.when(F.col("session_duration_seconds") > 0, pace).otherwise(F.lit(0.0)),
        )
    )


def _moments() -> list[Column]:
    return [
        *[F.avg(f).alias(f"mean_{f}") for f in FEATURES],
        *[F.stddev_samp(f).alias(f"std_{f}") for f in FEATURES],
    ]


def _quartiles() -> list[Column]:
    return [F.percentile_approx(f, [0.25, 0.75]).alias(f"quartiles_{f}") for f in FEATURES]


def day_moments(features: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of each indicator, one row per day."""
    return features.groupBy("dt").agg(*_moments())


def day_quartiles(features: DataFrame) -> DataFrame:
    """First and third quartile of each indicator, one row per day."""
    return features.groupBy("dt").agg(*_quartiles())


def _with_day(features: DataFrame, statistics: DataFrame) -> DataFrame:
    # The statistics hold one row per day and are staged, so their size is known
    # when the join is planned: broadcast when small, shuffled otherwise.
    return features.join(statistics, "dt", "left")


def _z_columns(df: DataFrame) -> DataFrame:
    scores = {}
    for f in FEATURES:
        mean, std = F.col(f"mean_{f}"), F.col(f"std_{f}")
        score = F.when(std > 0, F.try_divide(F.col(f) - mean, std)).otherwise(F.lit(0.0))
        scores[f"z_{f}"] = F.round(score, 3)
    # The test uses the rounded score. Rounding is costly, so each score is worked
    # out once and not again in every flag, sum and label built on it.
    flags = {f"flag_z_{f}": (F.abs(f"z_{f}") > Z_LIMIT).cast("int") for f in FEATURES}
    return computed_once(computed_once(df, **scores), **flags)


def _outside(feature: str) -> Column:
    low, high = F.col(f"quartiles_{feature}")[0], F.col(f"quartiles_{feature}")[1]
    reach = F.lit(IQR_FACTOR) * (high - low)
    return (F.col(feature) < low - reach) | (F.col(feature) > high + reach)


def _iqr_columns(df: DataFrame) -> DataFrame:
    return computed_once(df, **{f"flag_iqr_{f}": _outside(f).cast("int") for f in FEATURES})


def zscore_flags(features: DataFrame, moments: DataFrame | None = None) -> DataFrame:
    """Add ``z_*`` (three places) and ``flag_z_*`` for every indicator."""
    if moments is None:
        moments = stage(day_moments(features), "moments")
    flagged = _z_columns(_with_day(features, moments))
    return flagged.drop(*[c for c in moments.columns if c != "dt"])


def iqr_flags(features: DataFrame, quartiles: DataFrame | None = None) -> DataFrame:
    """Add ``flag_iqr_*`` for every indicator; a value on the fence is inside."""
    if quartiles is None:
        quartiles = stage(day_quartiles(features), "quartiles")
    flagged = _iqr_columns(_with_day(features, quartiles))
    return flagged.drop(*[c for c in quartiles.columns if c != "dt"])


def label_anomalies(flagged: DataFrame) -> DataFrame:
    """Keep sessions with at least two flags and name the first indicator that fired."""
    flags = [f"flag_{method}_{f}" for method in ("z", "iqr") for f in FEATURES]
    label = reduce(
        lambda chain, f: chain.when(
            F.col(f"flag_z_{f}") + F.col(f"flag_iqr_{f}") > 0, F.lit(LABELS[f])
        ),
        LABELS,
        F,
    ).otherwise(F.lit(OTHER_LABEL))
    return (
        flagged.withColumn("total_flags", reduce(add, [F.col(c) for c in flags]))
        .filter(F.col("total_flags") >= MIN_FLAGS)
        .withColumn("anomaly_type", label)
        .select(
            "dt",
            "session_id",
            "user_id",
            *FEATURES,
            *[f"z_{f}" for f in FEATURES],
            "total_flags",
            "anomaly_type",
        )
    )


def anomalies(events: DataFrame) -> DataFrame:
    """Anomalous sessions of every day.

    Features are staged: one pass gives the day statistics, a second compares
    every session with them, and neither gathers a day in one task.
    """
    features = stage(session_features(events), "features")
    by_day = features.groupBy("dt").agg(*_moments(), *_quartiles())
    statistics = stage(by_day, "day_statistics")
    return label_anomalies(_iqr_columns(_z_columns(_with_day(features, statistics))))
