"""Event cleaning: deduplication, imputation and normalisation.

The steps that only rewrite a value are plain projections. The two imputations
need a small table computed from the deduplicated events (modal device per user,
median time per page type); ``build_lookups`` stages those, so the join that uses
them is planned on their true size.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import is_event
from footfall.schema import UNKNOWN
from footfall.sources.staging import stage

COPIES = "copies"
_FIRST = "__first"
_MODAL = "__modal_device"
_MEDIAN = "__median_time"


def _collapse_copies(df: DataFrame, copies: Column) -> DataFrame:
    # A minimum over a struct is combined inside each map task, so an event_id
    # with very many copies sends one row per task through the shuffle. The
    # struct starts with event_ts (NULL sorts first); the other columns break ties.
    payload = [c for c in df.columns if c not in ("event_id", "event_ts")]
    first = F.min(F.struct("event_ts", *payload)).alias(_FIRST)
    grouped = df.groupBy("event_id").agg(first, copies.alias(COPIES))
    fields = [F.col("event_id") if c == "event_id" else F.col(_FIRST)[c].alias(c) for c in df.columns]
    return grouped.select(*fields, COPIES)


def deduplicate(df: DataFrame) -> DataFrame:
    """One row per non-NULL ``event_id``: the earliest by ``event_ts``."""
    present = df.filter(F.col("event_id").isNotNull())
    return _collapse_copies(present, F.count(F.lit(1))).drop(COPIES)


def count_copies(df: DataFrame) -> DataFrame:
    """Deduplicated rows with ``copies``, the number of raw rows behind each.

    Rows without an id stay as one row whose ``copies`` is negative: the sum of
    the absolute values is the raw row count, and ``with_ids`` filters on this
    small column instead of the ids themselves.
    """
    sign = F.when(F.col("event_id").isNull(), -1).otherwise(1)
    return _collapse_copies(df, F.sum(sign))


def with_ids(counted: DataFrame) -> DataFrame:
    """The deduplicated events of ``count_copies``."""
    return counted.filter(F.col(COPIES) > 0).drop(COPIES)


def impute_country(df: DataFrame) -> DataFrame:
    """NULL country of any event becomes UNKNOWN."""
    return df.withColumn("country", F.coalesce("country", F.lit(UNKNOWN)))


def modal_devices(df: DataFrame) -> DataFrame:
    """Most frequent page-view device per user; a tie goes to the first by name."""
    known = df.filter(is_event("page_view") & F.col("device_type").isNotNull())
    return known.groupBy("user_id").agg(F.mode("device_type", True).alias(_MODAL))


def median_times(df: DataFrame) -> DataFrame:
    """Approximate median ``time_on_page_seconds`` of page views per page type."""
    median = F.percentile_approx("time_on_page_seconds", 0.5)
    return df.filter(is_event("page_view")).groupBy("page_type").agg(median.alias(_MEDIAN))


def impute_device(df: DataFrame, devices: DataFrame | None = None) -> DataFrame:
    """NULL device becomes the user's modal device, or UNKNOWN if there is none.

    Only rows without a device meet the table of users; the others stay where they are.
    """
    if devices is None:
        devices = stage(modal_devices(df), "devices")
    missing = df.filter(F.col("device_type").isNull())
    joined = missing.join(devices, "user_id", "left").withColumn(
        "device_type", F.coalesce(_MODAL, F.lit(UNKNOWN))
    )
    return df.filter(F.col("device_type").isNotNull()).unionByName(joined.select(*df.columns))


def impute_time_on_page(df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """NULL time of a page view becomes the median of its page type."""
    if medians is None:
        medians = stage(median_times(df), "medians")
    missing = is_event("page_view") & F.col("time_on_page_seconds").isNull()
    filled = F.when(missing, F.col(_MEDIAN)).otherwise(F.col("time_on_page_seconds"))
    joined = df.join(medians, "page_type", "left").withColumn("time_on_page_seconds", filled)
    return joined.select(*df.columns)


def normalize_url(df: DataFrame) -> DataFrame:
    """Lower-case URL without its query string."""
    return df.withColumn("page_url", F.lower(F.substring_index("page_url", "?", 1)))


def normalize_country(df: DataFrame) -> DataFrame:
    """Upper-case country code."""
    return df.withColumn("country", F.upper("country"))


class Lookups(NamedTuple):
    devices: DataFrame | None = None
    medians: DataFrame | None = None


# What an imputation reads beside the column it fills.
_READS = {
    "device_type": ("user_id", "event_type"),
    "time_on_page_seconds": ("event_type", "page_type"),
}


def input_columns(wanted: Sequence[str]) -> list[str]:
    """Columns cleaning must read to produce ``wanted``."""
    needed = dict.fromkeys(["event_id", "event_ts", *wanted])
    for column, extra in _READS.items():
        if column in wanted:
            needed.update(dict.fromkeys(extra))
    return list(needed)


def build_lookups(deduped: DataFrame, wanted: Sequence[str]) -> Lookups:
    """Stage the imputation tables that ``wanted`` needs."""
    return Lookups(
        stage(modal_devices(deduped), "devices") if "device_type" in wanted else None,
        stage(median_times(deduped), "medians") if "time_on_page_seconds" in wanted else None,
    )


def fill_and_normalize(deduped: DataFrame, lookups: Lookups, wanted: Sequence[str]) -> DataFrame:
    """Every cleaning step after deduplication, only for the columns asked for."""
    out = deduped
    if "country" in wanted:
        out = impute_country(out)
    if "device_type" in wanted:
        out = impute_device(out, lookups.devices)
    if "time_on_page_seconds" in wanted:
        out = impute_time_on_page(out, lookups.medians)
    if "page_url" in wanted:
        out = normalize_url(out)
    if "country" in wanted:
        out = normalize_country(out)
    return out.select(*wanted)


def clean_events(df: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """The whole cleaning pipeline, for all columns or only for ``wanted``.

    The deduplicated events are staged when an imputation reads them again, so
    the shuffle by ``event_id`` happens once.
    """
    wanted = list(wanted or df.columns)
    deduped = deduplicate(df.select(*input_columns(wanted)))
    if any(c in wanted for c in _READS):
        deduped = stage(deduped, "deduped", sort_by="event_type")
    return fill_and_normalize(deduped, build_lookups(deduped, wanted), wanted)
