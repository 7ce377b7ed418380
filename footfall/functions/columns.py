"""Column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_event(*kinds: str) -> Column:
    """True for rows of the given event types."""
    return F.col("event_type").isin(*kinds) if len(kinds) > 1 else F.col("event_type") == kinds[0]


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """``part / whole`` rounded; NULL (not an error) when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), places)


def whole_seconds(ts: Column) -> Column:
    """Seconds since the epoch, fractions dropped; takes zoned and local timestamps."""
    return F.unix_seconds(ts.cast("timestamp"))


def sql_list(values) -> Column:
    """A constant array column."""
    return F.array(*[F.lit(v) for v in values])


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections reuse instead of inlining.

    The optimizer replaces a column by its expression when it pushes a filter
    down. For a long rule chain over a parsed document that repeats the parsing
    once per rule. A one-row generator keeps the value as it is, inside codegen.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
