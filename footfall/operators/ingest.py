"""File-level ingest results: line numbers, quarantine, summaries and metrics.

Input is a frame of verdicts with ``source_key``, ``block`` (a bounded piece of a
file, in file order), ``position`` (increasing by one inside a block) and the
columns added by ``validate_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.schema import EVENT_TYPES

# --- fixed values -----------------------------------------------------------------
MAX_INVALID_RATIO = 0.5
PAYLOAD_CHARS = 1000
WHOLE_FILE_REASON = "invalid_ratio_exceeded"
WHOLE_FILE_COUNT = -1
ROLLUP_WINDOW = "5 minutes"
INVALID_RATE_ALERT = 50.0
METRIC_UNITS = {
    "FilesProcessed": "Count",
    "BytesProcessed": "Bytes",
    "RecordsValid": "Count",
    "RecordsInvalid": "Count",
    "InvalidRate": "Percent",
    "ProcessingDurationMs": "Milliseconds",
    "EventsByType": "Count",
}


def block_offsets(lines: DataFrame) -> DataFrame:
    """First position and number of earlier lines for every block of every file.

    Lines are only counted per block, so the window runs over one row per block.
    """
    before = Window.partitionBy("source_key").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        lines.groupBy("source_key", "block")
        .agg(F.min("position").alias("first_position"), F.count(F.lit(1)).alias("lines"))
        .select(
            "source_key",
            "block",
            "first_position",
            F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
        )
    )


def with_line_numbers(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add the 1-based ``line_number`` inside the file to any subset of its lines."""
    number = F.col("lines_before") + F.col("position") - F.col("first_position") + 1
    return (
        rows.join(offsets, ["source_key", "block"])
        .withColumn("line_number", number)
        .drop("first_position", "lines_before")
    )


def quarantine_key(source_key: Column, whole_file: Column) -> Column:
    """Target of a file's rejects, keeping its date folders."""
    rest = F.regexp_replace(source_key, "^events/", "")
    stem = F.regexp_replace(rest, r"\.jsonl$", "")
    suffix = F.when(whole_file, ".full.jsonl").otherwise(".errors.jsonl")
    return F.concat(F.lit("quarantine/"), stem, suffix)


def file_summary(
    verdicts: DataFrame,
    size: Column,
    max_invalid_ratio: float = MAX_INVALID_RATIO,
    **extra: Column,
) -> DataFrame:
    """One row per file: size, counts, ratio, counts per type, verdict on the file.

    ``size`` and ``extra`` are aggregates over the lines of a file.
    """
    by_type = [
        F.count_if(F.col("is_valid") & (F.col("event_type") == kind)).alias(kind)
        for kind in EVENT_TYPES
    ]
    counted = verdicts.groupBy("source_key").agg(
        size.alias("size_bytes"),
        F.count_if("is_valid").alias("records_valid"),
        F.count_if(~F.col("is_valid")).alias("records_invalid"),
        *by_type,
        *[value.alias(name) for name, value in extra.items()],
    )
    invalid = F.col("records_invalid")
    total = F.col("records_valid") + invalid
    share = F.coalesce(
        F.try_divide(invalid.cast("double"), total.cast("double")), F.lit(0.0)
    )
    corrupt = (invalid > 0) & (share >= max_invalid_ratio)
    return counted.select(
        "source_key",
        "size_bytes",
        "records_valid",
        "records_invalid",
        F.round(share, 4).alias("invalid_ratio"),
        *EVENT_TYPES,
        corrupt.alias("is_corrupt"),
        F.when(invalid > 0, quarantine_key(F.col("source_key"), corrupt)).alias("quarantine_key"),
        F.when(corrupt, F.lit(WHOLE_FILE_COUNT)).otherwise(invalid).alias("quarantine_count"),
        F.when(corrupt, WHOLE_FILE_REASON).alias("quarantine_reason"),
        *extra,
    )


def with_empty_files(summary: DataFrame, files: DataFrame) -> DataFrame:
    """Add files that have no line: no records, nothing in quarantine."""
    kinds = {"boolean": F.lit(False), "string": F.lit(None)}
    given = {"source_key": F.col("source_key"), "size_bytes": F.col("size_bytes")}
    absent = files.join(summary.select("source_key"), "source_key", "left_anti")
    return summary.unionByName(
        absent.select(
            *[
                given.get(name, kinds.get(kind, F.lit(0))).cast(kind).alias(name)
                for name, kind in summary.dtypes
            ]
        )
    )


def corrupt_files(summary: DataFrame) -> DataFrame:
    """Files whose share of invalid lines sends them to quarantine as a whole."""
    return summary.filter("is_corrupt").select(
        "source_key", "invalid_ratio", "quarantine_key", "quarantine_reason"
    )


def quarantine_records(verdicts: DataFrame, offsets: DataFrame, summary: DataFrame) -> DataFrame:
    """Rejected lines of the files that stay, with line number and reason."""
    whole = summary.filter("is_corrupt").select("source_key")
    rejected = verdicts.filter(~F.col("is_valid")).join(whole, "source_key", "left_anti")
    return with_line_numbers(rejected, offsets).select(
        "line_number",
        "source_key",
        "event_type",
        F.col("error").alias("error_reason"),
        F.substring("raw", 1, PAYLOAD_CHARS).alias("raw_payload"),
    )


def ingest_metrics(
    summary: DataFrame, source: str, at: Column, duration_ms: Column | None = None
) -> DataFrame:
    """Long form: one row per file and metric, plus one per event type."""
    valid, invalid = F.col("records_valid"), F.col("records_invalid")
    total = (valid + invalid).cast("double")
    rate = F.coalesce(F.try_divide(invalid.cast("double"), total) * 100.0, F.lit(0.0))
    values = {
        "FilesProcessed": F.lit(1.0),
        "BytesProcessed": F.col("size_bytes"),
        "RecordsValid": valid,
        "RecordsInvalid": invalid,
        "InvalidRate": rate,
        "ProcessingDurationMs": F.lit(None) if duration_ms is None else duration_ms,
    }

    def row(name: str, value: Column, kind: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            value.cast("double").alias("value"),
            F.lit(METRIC_UNITS[name]).alias("unit"),
            kind.cast("string").alias("event_type"),
        )

    rows = [row(name, value, F.lit(None)) for name, value in values.items()]
    rows += [row("EventsByType", F.col(kind), F.lit(kind)) for kind in EVENT_TYPES]
    return (
        summary.select("source_key", at.alias("recorded_at"), F.inline(F.array(*rows)))
        .filter(F.col("value").isNotNull())
        .withColumn("source", F.lit(source))
    )


def rollup_metrics(metrics: DataFrame, window: str = ROLLUP_WINDOW) -> DataFrame:
    """Tumbling totals of counts, mean invalid rate, mean and maximum duration."""
    is_level = F.col("name").isin("InvalidRate", "ProcessingDurationMs")
    return (
        metrics.groupBy(F.window("recorded_at", window).alias("w"), "source", "name", "event_type")
        .agg(
            F.sum("value").alias("total"),
            F.avg("value").alias("average"),
            F.max("value").alias("maximum"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "source",
            "name",
            "event_type",
            F.when(~is_level, F.col("total")).alias("total"),
            F.when(is_level, F.col("average")).alias("average"),
            F.when(F.col("name") == "ProcessingDurationMs", F.col("maximum")).alias("maximum"),
            F.when(F.col("name") == "InvalidRate", F.lit(INVALID_RATE_ALERT)).alias("alert_at"),
        )
    )


def partial_rollup(
    metrics: DataFrame, closed_before: Column, window: str = ROLLUP_WINDOW
) -> DataFrame:
    """Totals of one batch of metrics that add up with those of other batches.

    ``late_rows`` counts the rows of windows that ended by ``closed_before`` (NULL: none).
    """
    late = F.coalesce(F.col("w.end") <= closed_before, F.lit(False))
    return (
        metrics.withColumn("w", F.window("recorded_at", window))
        .groupBy(F.col("w.start").alias("window_start"), "source", "name", "event_type")
        .agg(
            F.sum("value").alias("total"),
            F.count("value").alias("valued"),
            F.max("value").alias("maximum"),
            F.count_if(late).alias("late_rows"),
        )
    )


def merged_rollup(partials: DataFrame) -> DataFrame:
    """The roll-up of all batches, as ``rollup_metrics`` has it, and its late rows."""
    is_level = F.col("name").isin("InvalidRate", "ProcessingDurationMs")
    merged = partials.groupBy("window_start", "source", "name", "event_type").agg(
        F.sum("total").alias("total"),
        F.sum("valued").alias("valued"),
        F.max("maximum").alias("maximum"),
        F.sum("late_rows").alias("late_rows"),
    )
    return merged.select(
        "window_start",
        "source",
        "name",
        "event_type",
        F.when(~is_level, F.col("total")).alias("total"),
        F.when(is_level, F.try_divide("total", "valued")).alias("average"),
        F.when(F.col("name") == "ProcessingDurationMs", F.col("maximum")).alias("maximum"),
        F.when(F.col("name") == "InvalidRate", F.lit(INVALID_RATE_ALERT)).alias("alert_at"),
        "late_rows",
    )
