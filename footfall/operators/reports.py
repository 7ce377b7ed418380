"""Parameterised questions over the fact tables.

Arguments are checked before a plan is built; every report filters one ``dt``,
which is the partition column of the facts.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.metrics.anomalies import FEATURES
from footfall.schema import DEVICE_TYPES

# fixed values: page rankings and limits (default, smallest, largest)
PAGE_RANKINGS = ("time_on_page", "bounce_rate")
PAGE_LIMIT = (10, 1, 100)
ANOMALY_LIMIT = (100, 1, 1000)


class ArgumentError(ValueError):
    """A report argument is missing or malformed."""


class NoDataError(LookupError):
    """A report found nothing for its arguments."""


def check_date(value: str | date | None, name: str = "date", required: bool = True):
    if isinstance(value, date):
        return value
    if not value:
        if required:
            raise ArgumentError(f"'{name}' is required as YYYY-MM-DD")
        return None
    try:
        return datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError:
        raise ArgumentError(f"'{name}' must look like YYYY-MM-DD: {value!r}") from None


def check_choice(value: str | None, allowed, name: str, required: bool = True) -> str | None:
    if not value and not required:
        return None
    if value not in allowed:
        raise ArgumentError(f"'{name}' must be one of {', '.join(sorted(allowed))}: {value!r}")
    return value


def check_limit(value: str | int | None, limits: tuple[int, int, int], name: str = "limit") -> int:
    default, low, high = limits
    if value is None or value == "":
        return default
    try:
        number = int(value)
    except ValueError:
        raise ArgumentError(f"'{name}' must be a whole number: {value!r}") from None
    if not low <= number <= high:
        raise ArgumentError(f"'{name}' must be within {low}..{high}: {number}")
    return number


def check_country(value: str | None, required: bool = False) -> str | None:
    code = (value or "").strip().upper()
    if not value and not required:
        return None
    if len(code) != 2 or not code.isalpha():
        raise ArgumentError(f"'country' must be a two-letter code: {value!r}")
    return code


def require_data(report: DataFrame) -> DataFrame:
    """Return the report, or raise ``NoDataError`` if it has no row."""
    if report.isEmpty():
        raise NoDataError("no data for these arguments")
    return report


def _on(facts: DataFrame, day: date) -> DataFrame:
    return facts.filter(F.col("dt") == F.lit(day))


def top_pages_by_time(top_pages: DataFrame, day, limit=None) -> DataFrame:
    """Pages of a day by average time, longest first."""
    rows = _on(top_pages, check_date(day)).select(
        "page_url", "page_type", "views", "avg_time_on_page", "p95_time_on_page"
    )
    order = [F.desc_nulls_last("avg_time_on_page"), F.asc("page_url"), F.asc("page_type")]
    return rows.orderBy(*order).limit(check_limit(limit, PAGE_LIMIT))


def top_pages_by_bounce(bounce_rate: DataFrame, day, limit=None) -> DataFrame:
    """Landing page types of a day by bounce rate, highest first."""
    rows = _on(bounce_rate, check_date(day)).select(
        "landing_page_type", "total_sessions", "bounce_sessions", "bounce_rate"
    )
    order = [F.desc("bounce_rate"), F.asc("landing_page_type")]
    return rows.orderBy(*order).limit(check_limit(limit, PAGE_LIMIT))


def top_pages(ranking, top_pages_facts: DataFrame, bounce_facts: DataFrame, day, limit=None):
    """One of the two page rankings, chosen by name."""
    if check_choice(ranking, PAGE_RANKINGS, "metric") == "time_on_page":
        return top_pages_by_time(top_pages_facts, day, limit)
    return top_pages_by_bounce(bounce_facts, day, limit)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.try_divide(part.cast("double"), whole.cast("double")))


def overall_bounce_rate(bounce_rate: DataFrame, day) -> DataFrame:
    """Bounce rate over all landing types of a day: always one row."""
    rows = _on(bounce_rate, check_date(day))
    rate = _share(F.sum("bounce_sessions"), F.sum("total_sessions"))
    return rows.agg(rate.alias("overall_bounce_rate"))


def session_summary(
    device_country: DataFrame, bounce_rate: DataFrame, day, country=None, device=None
) -> DataFrame:
    """Totals of a day, optionally for one country and device; one row, or none without data.

    The overall bounce rate covers the whole day whatever the filters. Sessions
    seen in two segments count in both.
    """
    day, country = check_date(day), check_country(country)
    device = check_choice(device, DEVICE_TYPES, "device", required=False)
    rows = _on(device_country, day)
    if country:
        rows = rows.filter(F.col("country") == country)
    if device:
        rows = rows.filter(F.col("device_type") == device)
    # segments and bounces meet in one aggregation, so two totals need no join
    both = rows.select(
        "unique_sessions", "page_views", "avg_time_on_page", F.lit(True).alias("is_segment")
    ).unionByName(
        _on(bounce_rate, day).select("bounce_sessions", "total_sessions"), allowMissingColumns=True
    )
    views, bounced, landed = F.sum("page_views"), F.sum("bounce_sessions"), F.sum("total_sessions")
    weighted = F.sum(F.col("avg_time_on_page") * F.col("page_views"))
    return both.agg(
        F.coalesce(F.sum("unique_sessions"), F.lit(0)).alias("total_sessions"),
        F.coalesce(views, F.lit(0)).alias("total_page_views"),
        F.when(views > 0, F.try_divide(weighted, views)).alias("avg_time_on_page"),
        _share(bounced, landed).alias("overall_bounce_rate"),
        F.count("is_segment").alias("segments"),
    ).filter(F.col("segments") > 0).select(
        F.lit(day).alias("date"),
        F.lit(country).cast("string").alias("country"),
        F.lit(device).cast("string").alias("device"),
        "total_sessions",
        "total_page_views",
        "avg_time_on_page",
        "overall_bounce_rate",
        "segments",
    )


def _strongest_score() -> Column:
    return F.greatest(*[F.coalesce(F.abs(f"z_{f}"), F.lit(0)) for f in FEATURES])


def ranked_anomalies(anomalies: DataFrame, day, limit=None) -> DataFrame:
    """Anomalous sessions of a day, most flags first, then the strongest z-score."""
    return (
        _on(anomalies, check_date(day))
        .orderBy(
            F.desc_nulls_last("total_flags"), _strongest_score().desc(), F.asc("session_id"),
            F.asc("user_id"),
        )
        .limit(check_limit(limit, ANOMALY_LIMIT))
        .select(
            "session_id",
            "user_id",
            *FEATURES,
            F.struct(*[F.col(f"z_{f}").alias(f) for f in FEATURES]).alias("z_score"),
            "total_flags",
            "anomaly_type",
        )
    )
