"""Top rows of every group, safe for groups that hold a large part of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
_SALT = "__salt"
_SALTS = 64


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, position).filter(F.col(_RANK) <= n)


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of each group under ``order``.

    Spark prunes every map task's share of a group to ``n`` rows before the
    shuffle as long as ``n`` is within ``windowGroupLimitThreshold``, so one huge
    group costs ``n`` rows per task and not the group. For a larger ``n`` the
    group is split over salts first: the best ``n`` of each slice contain the
    best ``n`` of the whole.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > limit:
        slices = df.withColumn(_SALT, F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        df = _ranked(slices, [*keys, _SALT], order, n).drop(_RANK, _SALT)
    return _ranked(df, keys, order, n).drop(_RANK)
