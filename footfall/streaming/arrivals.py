"""Each new event file is ingested once, as a stream of file arrivals."""

from __future__ import annotations

import argparse
import json
import logging
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.isolation import spoilers
from footfall.operators.ingest import (
    MAX_INVALID_RATIO,
    merged_rollup,
    partial_rollup,
    rollup_metrics,
)
from footfall.plans.ingest import IngestTargets, ingest_lines
from footfall.session import build_session
from footfall.sources.batches import (
    Attempt,
    commit,
    is_committed,
    read_committed,
    write_part,
)
from footfall.sources.lines import exact_path, fine_splits, read_lines, source_key

log = logging.getLogger(__name__)

_PARTIALS = """window_start timestamp, source string, name string, event_type string, total double,
    valued long, maximum double, late_rows long, batch string, attempt string"""
_MARKS = "seen timestamp, batch string, attempt string"
_CODECS = (".gz", ".gzip", ".bz2", ".zst", ".zstd", ".lz4", ".snappy", ".deflate", ".xz")
ARRIVAL_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Batches are numbered per checkpoint, and every checkpoint has an id of its own."""
    stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]
    return f"{stream}-{batch_id}"


def named_files(failure: str, paths: Sequence[str]) -> list[str]:
    """Those of ``paths`` that the message of a failed job calls unreadable."""

    def plain(path: str) -> str:
        return re.sub("^[A-Za-z0-9]+:/*", "/", path)

    told = {plain(unquote(p)) for p in re.findall(r"while reading file (\S+?)\.?(?:\s|$)", failure)}
    return [path for path in paths if plain(path) in told]


def arrivals(
    spark: SparkSession, base: str, pattern: str = "*.jsonl", files_per_batch: int = 1000
) -> DataFrame:
    """Paths and sizes of new event files below ``base``; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(ARRIVAL_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(base)
        .select("path", "length")
    )


def start_ingest(
    spark: SparkSession,
    base: str,
    root: str,
    output: str,
    checkpoint: str,
    source: str = "landing",
    max_invalid_ratio: float = MAX_INVALID_RATIO,
    pattern: str = "*.jsonl",
    files_per_batch: int = 1000,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the ingest stream.

    A batch is ingested as one unit over its files. If that fails, the files that
    cannot be read are found: the one that the failure names is read alone, then the
    others together, and so on; where it names none, by halving (about log2 of the
    number of files reading jobs for each). They are recorded as failures, and the rest
    is ingested. A batch with compressed files, which break when they are cut, is read once
    before it is ingested, so that no line is validated in vain; a failure that is
    not a file's fault stops the stream, which repeats the batch when it is started
    again. Results count when the batch is committed, all at once, and a batch that
    was committed before the stream noted its end is not ingested twice. Only the
    names of one batch's files, at most ``files_per_batch``, reach the driver.
    """
    targets = IngestTargets.under(output)

    def read(paths) -> DataFrame:
        return read_lines(spark, [exact_path(p) for p in paths], root)

    def ingest(paths, sizes: DataFrame, batch: str, failed: DataFrame | None = None) -> None:
        options = {"max_invalid_ratio": max_invalid_ratio, "files": sizes, "failed": failed}
        ingest_lines(read(paths), targets, source, batch, **options)

    failure = ""

    def unreadable(paths) -> bool:
        nonlocal failure
        try:
            read(paths).write.format("noop").mode("overwrite").save()
        except Exception as error:
            failure = str(error)
            log.warning("cannot read all of %d files", len(paths), exc_info=len(paths) == 1)
            return True
        return False

    def named(paths) -> DataFrame:
        return spark.createDataFrame([(p,) for p in paths], "path string").select(
            source_key(F.col("path"), root).alias("source_key")
        )

    def ingest_readable(paths, sizes: DataFrame, batch: str) -> None:
        nonlocal failure
        try:
            if any(path.lower().endswith(_CODECS) for path in paths):
                read(paths).write.format("noop").mode("overwrite").save()
            ingest(paths, sizes, batch)
        except Exception as error:
            failure = str(error)
            failed = spoilers(paths, unreadable, lambda group: named_files(failure, group))
            if not failed:
                raise
            lost = named(sorted(failed))
            readable = [p for p in paths if p not in set(failed)]
            if readable:
                ingest(readable, sizes.join(lost, "source_key", "left_anti"), batch, lost)
            else:
                attempt = Attempt.of(targets.base, batch)
                write_part(lost.withColumn("error", F.lit(True)), attempt, "failures")
                commit(spark, attempt)

    def on_batch(files: DataFrame, batch_id: int) -> None:
        found = [(row.path, row.length) for row in files.select("path", "length").collect()]
        if not found:
            return
        paths = [path for path, _ in found]
        batch = _batch_name(spark, checkpoint, batch_id)
        if is_committed(spark, targets.base, batch):
            return
        sizes = spark.createDataFrame(found, "path string, size_bytes long").select(
            source_key(F.col("path"), root).alias("source_key"), "size_bytes"
        )
        with fine_splits(spark):
            ingest_readable(paths, sizes, batch)

    writer = (
        arrivals(spark, base, pattern, files_per_batch)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()


def stream_rollup(metrics: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The five-minute roll-up over a stream of ingest metrics."""
    return rollup_metrics(metrics.withWatermark("recorded_at", delay))


def start_rollup(
    metrics: DataFrame,
    output: str,
    checkpoint: str,
    delay: str = "10 minutes",
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the five-minute roll-up of a stream of ingest metrics below ``output``.

    Every batch adds its own totals per window and is committed once, so a stream that is
    stopped, or dies between two steps, goes on from its checkpoint without losing or
    doubling a row. A row counts however late it is: windows that had ended ``delay`` before
    the newest row of all earlier batches are closed, and rows that still reach them are
    added and reported as late. Nothing is held in executor state; what a batch shuffles are its
    own partial totals.
    """
    spark = metrics.sparkSession

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        batch = _batch_name(spark, checkpoint, batch_id)
        if is_committed(spark, output, batch):
            return
        seen = read_committed(spark, output, "marks", _MARKS).agg(F.max("seen")).first()[0]
        closed = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        attempt = Attempt.of(output, batch)
        write_part(partial_rollup(rows, closed), attempt, "partials")
        write_part(rows.agg(F.max("recorded_at").alias("seen")), attempt, "marks")
        commit(spark, attempt)

    writer = metrics.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()


def read_rollup(spark: SparkSession, output: str) -> DataFrame:
    """The roll-up of all committed batches, with ``late_rows`` per window and metric."""
    return merged_rollup(read_committed(spark, output, "partials", _PARTIALS))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder watched for event files")
    parser.add_argument("--root", required=True, help="folder that source keys are relative to")
    parser.add_argument("--output", required=True, help="base folder of all ingest results")
    parser.add_argument("--checkpoint", required=True, help="progress of the stream")
    parser.add_argument("--pattern", default="*.jsonl", help="names of event files")
    parser.add_argument("--max-invalid-ratio", type=float, default=MAX_INVALID_RATIO)
    parser.add_argument("--continuous", action="store_true", help="keep waiting for files")
    args = parser.parse_args(argv)
    spark = build_session("footfall-ingest")
    query = start_ingest(
        spark,
        args.input,
        args.root,
        args.output,
        args.checkpoint,
        source=args.root,
        max_invalid_ratio=args.max_invalid_ratio,
        pattern=args.pattern,
        available_now=not args.continuous,
    )
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
