"""File ingest: validate lines, quarantine rejects, publish per-file results."""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import ingest as op
from footfall.operators.validation import validate_lines
from footfall.sources.batches import Attempt, commit, read_committed, write_part
from footfall.sources.lines import exact_path, read_lines, with_key_folders
from footfall.sources.staging import stage, staging_scope

_FOLDERS = ("year", "month", "day", "quarantine_key")
_PLACE = "batch string, attempt string, year string, month string, day string, quarantine_key string"
REJECTS = f"""line_number long, source_key string, event_type string, error_reason string,
    raw_payload string, {_PLACE}"""
WHOLE_FILES = f"source_key string, line_number long, line string, {_PLACE}"
FAILURES = "source_key string, error boolean, batch string, attempt string"


class IngestTargets(NamedTuple):
    """Where the ingest writes; each kind of result is a folder that readers open by the manifest."""

    base: str

    @classmethod
    def under(cls, base: str) -> IngestTargets:
        return cls(base.rstrip("/"))

    def summaries(self, spark: SparkSession) -> DataFrame:
        """One row per ingested file."""
        return read_committed(spark, self.base, "summaries")

    def metrics(self, spark: SparkSession) -> DataFrame:
        return read_committed(spark, self.base, "metrics")

    def failures(self, spark: SparkSession) -> DataFrame:
        """Files that could not be read."""
        return read_committed(spark, self.base, "failures", FAILURES)

    def rejects(self, spark: SparkSession, quarantine_key: str | None = None) -> DataFrame:
        """Rejected lines; of one file by the key its summary names, only that folder is read."""
        rows = read_committed(spark, self.base, "rejects", REJECTS, file_format="json")
        return rows if quarantine_key is None else rows.filter(F.col("quarantine_key") == quarantine_key)

    def whole_files(self, spark: SparkSession, quarantine_key: str | None = None) -> DataFrame:
        """Numbered lines of corrupt files, by the key their summary names."""
        rows = read_committed(spark, self.base, "whole_files", WHOLE_FILES)
        return rows if quarantine_key is None else rows.filter(F.col("quarantine_key") == quarantine_key)


def slim_verdicts(verdicts: DataFrame) -> DataFrame:
    """Verdict columns, with text only where a line was rejected."""
    return verdicts.select(
        "source_key",
        "path",
        "file_size",
        "block",
        "position",
        "is_valid",
        "event_type",
        "error",
        F.when(~F.col("is_valid"), F.substring("raw", 1, op.PAYLOAD_CHARS)).alias("raw"),
    )


def whole_file_lines(spark: SparkSession, corrupt: DataFrame) -> DataFrame:
    """All lines of the files in ``corrupt(source_key, path, quarantine_key)``, numbered.

    Only those files are listed and scanned. Their names reach the driver, as names of
    files do for every scan. The lines are staged once, so numbers come from the very
    blocks that were read.
    """
    named = {r.path: (r.source_key, r.quarantine_key) for r in corrupt.collect()}
    lines = read_lines(spark, [exact_path(p) for p in named], "/").drop("source_key", "file_size")
    keys = spark.createDataFrame(
        [(p, *keys) for p, keys in named.items()], "path string, source_key string, quarantine_key string"
    )
    found = stage(lines.join(keys, "path").drop("path"), "whole_files")
    return op.with_line_numbers(found, op.block_offsets(found)).select(
        "source_key", "quarantine_key", "line_number", "line"
    )


def ingest_lines(
    lines: DataFrame,
    targets: IngestTargets,
    source: str,
    batch: str,
    max_invalid_ratio: float = op.MAX_INVALID_RATIO,
    files: DataFrame | None = None,
    failed: DataFrame | None = None,
) -> None:
    """Validate one batch of files (``read_lines``), write all ingest results, then commit them.

    ``files(source_key, size_bytes)`` names the files of the batch, so that those
    without a line are reported too; ``failed(source_key)`` those that cannot be read.
    A batch that is ingested again replaces its former results for every reader at once.

    Lines are parsed once; the staged verdicts hold a few bytes per valid line.
    Numbering, per-file totals and rejects all read that table. Corrupt files are the
    only ones read again, by their names.
    """
    started = time.monotonic()
    spark = lines.sparkSession
    attempt = Attempt.of(targets.base, batch)
    with staging_scope(spark):
        verdicts = stage(slim_verdicts(validate_lines(lines)), "verdicts")
        summary = stage(
            op.file_summary(verdicts, F.max("file_size"), max_invalid_ratio), "summary"
        )
        if files is not None:
            summary = stage(op.with_empty_files(summary, files), "summary")
        offsets = stage(op.block_offsets(verdicts), "offsets")
        rejects = op.quarantine_records(verdicts, offsets, summary)
        kept_at = summary.select("source_key", "quarantine_key")
        write_part(
            with_key_folders(rejects.join(kept_at, "source_key")).hint("rebalance", *_FOLDERS),
            attempt, "rejects", *_FOLDERS, file_format="json",
            # every record shows all fields, also an unknown event type
            ignoreNullFields="false",
        )
        corrupt = stage(
            op.corrupt_files(summary).select("source_key", "quarantine_key").join(
                verdicts.select("source_key", "path").distinct(), "source_key"
            ),
            "corrupt",
        )
        if not corrupt.isEmpty():
            whole = with_key_folders(whole_file_lines(spark, corrupt))
            write_part(whole.hint("rebalance", *_FOLDERS), attempt, "whole_files", *_FOLDERS)
        if failed is not None:
            write_part(failed.withColumn("error", F.lit(True)), attempt, "failures")
        write_part(summary.withColumn("source", F.lit(source)), attempt, "summaries")
        duration = F.lit((time.monotonic() - started) * 1000.0)
        metrics = op.ingest_metrics(summary, source, F.current_timestamp(), duration)
        write_part(metrics, attempt, "metrics")
        commit(spark, attempt)
