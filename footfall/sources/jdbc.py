"""Fact sink for a relational warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame

BATCH_SIZE = 1000


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> dict[str, str]:
    """Writer options; credentials are left out when not given.

    ``partitions`` bounds the connections that write at a time: Spark merges the
    frame's partitions down to as many, without a shuffle.
    """
    given = {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "numPartitions": str(partitions) if partitions else None,
    }
    return {**{k: v for k, v in given.items() if v}, "batchsize": str(batch_size)}


def jdbc_mode(load_mode: str) -> str:
    """Spark's save mode for a load mode; a day cannot be replaced over JDBC."""
    if load_mode == "replace_days":
        raise ValueError("a database table can be appended to or replaced, not replaced by day")
    return "overwrite" if load_mode == "replace_all" else "append"


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    """Append to, or with ``overwrite`` truncate and refill, a database table.

    Spark's JDBC writer cannot delete one day first. Where a day must be
    replaceable, load the Parquet facts (``write_days``) and publish from there.
    """
    writer = df.write.format("jdbc").options(**options)
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()
