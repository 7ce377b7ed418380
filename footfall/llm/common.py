"""Helpers shared by the operators: reading tables, unused names, prefix sums, files."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.sources.staging import scratch_path, stage

#: Characters that count as white space in every operator: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


#: Rows that tasks exchange with Python at once where texts are read: 1 MB of ordinary texts.
BATCH_ROWS = 500
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application, as ``--py-files`` would."""
    app = spark.conf.get("spark.app.id")
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="footfall-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in package.rglob("*.py"):
            target.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches that tasks exchange with Python to ``BATCH_ROWS``.

    Spark's own 10 000 rows are 20 MB of ordinary texts, which every task holds more than
    once in the executor's direct memory and in Python. A smaller bound of the session stays.
    """
    if not 0 < int(spark.conf.get(_BATCH_KEY)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))


@contextmanager
def small_batches(spark: SparkSession):
    """``bound_batches`` for what runs inside the block."""
    before = spark.conf.get(_BATCH_KEY)
    bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_KEY, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"{base}_{uuid4().hex[:8]}"
    return name


def running_sums(df: DataFrame, order: list[str], value: str, into: str) -> DataFrame:
    """Exclusive prefix sums of ``value`` over all rows in ascending ``order``.

    Rows are dealt into ranges of ``order`` and staged, so that every row's range
    is fixed; each range is summed by itself and shifted by the total of the
    ranges before it. Only one row per range meets in a single task. ``order``
    must end in a column that is unique, or equal rows may swap their places.
    """
    block = unused(df, "__block")
    dealt = stage(
        df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn(
            block, F.spark_partition_id()
        ),
        "ranges",
    )
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    shift = unused(df, "__shift")
    totals = stage(dealt.groupBy(block).agg(F.sum(value).alias(shift)), "range_totals").select(
        block, F.coalesce(F.sum(shift).over(before), F.lit(0)).alias(shift)
    )
    inside = (
        Window.partitionBy(block)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = dealt.withColumn(into, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        summed.join(totals, block).withColumn(into, F.col(into) + F.col(shift)).drop(block, shift)
    )


def folder_uri(path: str) -> str:
    """The path with a scheme, as pyarrow's file systems want it."""
    if "://" in path:
        return path.replace("s3a://", "s3://", 1)
    if path.startswith("file:"):
        return "file://" + path[len("file:") :]
    return "file://" + os.path.abspath(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused folder in the shared folder, made, as a URI that tasks can open."""
    from pyarrow import fs

    uri = folder_uri(scratch_path(spark, label))
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return uri


__all__ = [
    "BATCH_ROWS", "SPACE", "bound_batches", "folder_uri", "new_folder", "running_sums",
    "scratch_path", "ship_package", "small_batches", "stage", "table", "unused",
]
