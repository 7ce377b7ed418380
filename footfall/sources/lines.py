"""Raw text lines with their place in the file, and the quarantine sinks."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LAYOUT = ("year", "month", "day")


def source_key(path: Column, root: str) -> Column:
    """Path of a file below ``root``; the whole path if it lies elsewhere."""
    if ":" not in root.split("/", 1)[0]:
        root = os.path.abspath(root)
    scheme = "^[A-Za-z0-9]+:/*"
    folder = "/" + re.sub(scheme, "", root).strip("/") + "/"
    plain = F.regexp_replace(path, scheme, "/")
    below = F.substring(plain, len(folder) + 1, 1 << 30)
    return F.when(plain.startswith(folder), below).otherwise(plain)


def _decoded(path: Column) -> Column:
    """A file path without the URL escapes that file metadata carries."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def exact_path(path: str) -> str:
    """The path as a pattern that matches only itself."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_lines(spark: SparkSession, paths: str | Sequence[str], root: str) -> DataFrame:
    """Lines of text files: ``source_key, path, file_size, block, position, line``.

    ``block`` is the byte offset of the split a line was read from. ``position``
    grows by one from line to line of a split. ``paths`` may be patterns.
    """
    scan = spark.read.option("recursiveFileLookup", "true").text(paths)
    path = _decoded(F.col("_metadata.file_path"))
    return scan.select(
        source_key(path, root).alias("source_key"),
        path.alias("path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        F.col("value").alias("line"),
    )


@contextmanager
def fine_splits(spark: SparkSession, per_core: int = 4):
    """Read files in about ``per_core`` tasks for every core inside the block.

    Spark deals whole files, as compressed ones are, to one task more than there are cores,
    which takes twice as long as one task each.
    """
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    least = per_core * spark.sparkContext.defaultParallelism
    spark.conf.set(key, str(max(least, int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def with_key_folders(df: DataFrame) -> DataFrame:
    """Add the date folders named in ``source_key``."""
    return df.withColumns(
        {f: F.regexp_extract("source_key", rf"(?:^|/){f}=(\d+)/", 1) for f in _LAYOUT}
    )


def copy_start(spark: SparkSession, source: str, target: str, size: int) -> None:
    """Copy the first ``size`` bytes of one file, a buffer at a time, in any storage."""
    apache = spark._jvm.org.apache
    conf = spark._jsc.hadoopConfiguration()
    old, new = apache.hadoop.fs.Path(source), apache.hadoop.fs.Path(target)
    given, sink = old.getFileSystem(conf).open(old), new.getFileSystem(conf).create(new)
    try:
        apache.commons.io.IOUtils.copyLarge(given, sink, 0, size)
    finally:
        sink.close()
        given.close()
