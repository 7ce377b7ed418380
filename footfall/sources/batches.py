"""Results of batches that readers see whole or not at all.

Every try of a batch writes below folders of its own, ``<base>/<kind>/attempt=<id>/``.
When all of it is written, one row is appended to ``<base>/commits``: it names the attempt
that counts for the batch. Readers follow that manifest, so neither what a broken try
left behind nor what an earlier run of the same batch wrote is ever read.
"""

from __future__ import annotations

from typing import NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMITS = "commits"
_COMMIT = "batch string, number long, attempt string, committed_at timestamp"


class Attempt(NamedTuple):
    """One try of a batch."""

    base: str
    batch: str
    name: str

    @classmethod
    def of(cls, base: str, batch: str) -> Attempt:
        # the letter keeps Spark from reading a folder's name as a number
        return cls(base.rstrip("/"), batch, f"a{uuid4().hex}")


def write_part(df: DataFrame, attempt: Attempt, kind: str, *folders: str, file_format="parquet",
               **options: str) -> None:
    """Write one kind of result of an attempt, in ``folders`` by those columns."""
    (
        df.withColumns({"batch": F.lit(attempt.batch), "attempt": F.lit(attempt.name)})
        .write.mode("append")
        .format(file_format)
        .options(**options)
        .partitionBy("attempt", *folders)
        .save(f"{attempt.base}/{kind}")
    )


def _read(spark: SparkSession, path: str, schema: str | None, file_format: str) -> DataFrame | None:
    reader = spark.read.format(file_format)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def commits(spark: SparkSession, base: str) -> DataFrame:
    """``(batch, attempt, number)``: the attempt that counts for each batch, its last one."""
    found = _read(spark, f"{base.rstrip('/')}/{_COMMITS}", _COMMIT, "json")
    if found is None:
        found = spark.createDataFrame([], _COMMIT)
    last = found.groupBy("batch").agg(F.max(F.struct("number", "attempt")).alias("last"))
    return last.select("batch", "last.attempt", "last.number")


def is_committed(spark: SparkSession, base: str, batch: str) -> bool:
    return not commits(spark, base).filter(F.col("batch") == batch).isEmpty()


def commit(spark: SparkSession, attempt: Attempt) -> None:
    """Make an attempt the one that counts; a single file appears, so readers see it or not."""
    earlier = commits(spark, attempt.base).filter(F.col("batch") == attempt.batch).first()
    number = earlier.number + 1 if earlier else 1
    row = spark.createDataFrame([(attempt.batch, number, attempt.name)], "batch string, number long, attempt string")
    (
        row.withColumn("committed_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .json(f"{attempt.base}/{_COMMITS}")
    )


def read_committed(
    spark: SparkSession,
    base: str,
    kind: str,
    schema: str | None = None,
    batch: str | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Rows of one kind of all committed batches, or of one.

    ``schema`` names the columns, ``attempt`` and other folders included, where a kind
    may have no rows at all. The manifest is joined on the folder name, so with a batch
    only the folders of its attempt are scanned.
    """
    rows = _read(spark, f"{base.rstrip('/')}/{kind}", schema, file_format)
    if rows is None:
        if schema is None:
            raise ValueError(f"nothing was written to {base}/{kind}")
        rows = spark.createDataFrame([], schema)
    valid = commits(spark, base)
    if batch is not None:
        valid = valid.filter(F.col("batch") == batch)
    return rows.join(valid.select("attempt"), "attempt", "left_semi").drop("attempt")
