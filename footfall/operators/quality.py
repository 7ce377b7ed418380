"""Declarative data-quality rules: one aggregation pass per table, then a gate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSED, FAILED = "Passed", "Failed"

# Column types that always satisfy a declared type; other columns are tested by value.
_FITTING = {
    "DATE": ("date",),
    "INTEGER": ("tinyint", "smallint", "int", "bigint"),
    "DOUBLE": ("double", "float", "decimal", "tinyint", "smallint", "int", "bigint"),
}


# Shape a string must have before a cast is tried: a failed cast raises inside the
# engine, which is slow for a column full of other text.
_SHAPES = {
    "DATE": r"^\s*[+-]?\d{4,7}(-\d{1,2}(-\d{1,2}([ T].*)?)?)?\s*$",
    "INTEGER": r"^\s*[+-]?\d+\s*$",
    "DOUBLE": r"(?i)^\s*[+-]?(nan|inf|infinity|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?)\s*$",
}


class QualityError(ValueError):
    """A gate met at least one failed rule."""


class Rule(NamedTuple):
    """``breaks`` maps a frame to the condition that is true for offending rows.

    A rule over a key has ``keys`` instead and is judged on groups.
    """

    name: str
    breaks: object = None
    keys: tuple[str, ...] = ()


def is_complete(column: str) -> Rule:
    return Rule(f'IsComplete "{column}"', lambda df: F.col(column).isNull())


def has_type(column: str, kind: str) -> Rule:
    def breaks(df: DataFrame) -> Column:
        actual = df.schema[column].dataType.simpleString()
        if actual.startswith(_FITTING[kind]):
            return F.lit(False)
        if actual != "string":
            return F.col(column).isNotNull()
        shaped = F.col(column).rlike(_SHAPES[kind])
        return F.when(shaped, F.col(column).try_cast(kind.lower()).isNull()).otherwise(~shaped)

    return Rule(f'ColumnDataType "{column}" = "{kind}"', breaks)


def values(column: str, operator: str, limit: float) -> Rule:
    """``operator`` is ``>`` or ``>=``; NULLs are left to ``is_complete``."""

    def breaks(df: DataFrame) -> Column:
        return F.col(column) <= limit if operator == ">" else F.col(column) < limit

    return Rule(f'ColumnValues "{column}" {operator} {limit}', breaks)


def values_between(column: str, low: float, high: float) -> Rule:
    """Both bounds belong to the range."""
    return Rule(
        f'ColumnValues "{column}" between {low} and {high}',
        lambda df: ~F.col(column).between(low, high),
    )


def is_primary_key(*columns: str) -> Rule:
    names = " ".join(f'"{c}"' for c in columns)
    return Rule(f"IsPrimaryKey {names}", keys=columns)


def _offends(rule: Rule, df: DataFrame) -> Column:
    return F.coalesce(rule.breaks(df), F.lit(False))


def _key_failures(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows that share a key with another row, or have NULL in it."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in rule.keys])
    groups = df.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("__rows"))
    offending = F.when(missing | (F.col("__rows") > 1), F.col("__rows")).otherwise(0)
    return groups.agg(F.coalesce(F.sum(offending), F.lit(0)).alias("failing_rows")).select(
        F.lit(rule.name).alias("rule"), "failing_rows"
    )


def evaluate(df: DataFrame, rules: Sequence[Rule], context: str) -> DataFrame:
    """One row per rule: context, rule, outcome and number of failing rows.

    All row rules share a single aggregation; each key rule adds one grouping
    with map-side combine.
    """
    row_rules = [r for r in rules if not r.keys]
    parts = []
    if row_rules:
        counts = df.agg(
            *[F.count_if(_offends(r, df)).alias(f"r{i}") for i, r in enumerate(row_rules)]
        )
        pairs = [
            F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("failing_rows"))
            for i, r in enumerate(row_rules)
        ]
        parts.append(counts.select(F.inline(F.array(*pairs))))
    parts += [_key_failures(df, r) for r in rules if r.keys]
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(context).alias("context"),
        "rule",
        F.when(F.col("failing_rows") == 0, PASSED).otherwise(FAILED).alias("outcome"),
        F.col("failing_rows").cast("bigint").alias("failing_rows"),
    )


def publish(outcomes: DataFrame, folder: str) -> None:
    """Append rule outcomes with the time of evaluation."""
    stamped = outcomes.withColumn("evaluated_at", F.current_timestamp())
    stamped.coalesce(1).write.mode("append").json(folder)


def passing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows no row rule objects to."""
    tests = [~_offends(r, df) for r in rules if not r.keys]
    return df.filter(reduce(and_, tests)) if tests else df


def failing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows at least one row rule objects to, with the names of those rules."""
    broken = [F.when(_offends(r, df), r.name) for r in rules if not r.keys]
    named = df.withColumn("broken_rules", F.array_compact(F.array(*broken)))
    return named.filter(F.size("broken_rules") > 0)


def gate(df: DataFrame, rules: Sequence[Rule], context: str, results: str | None = None):
    """Return ``df`` unchanged if every rule holds; raise ``QualityError`` if not.

    The outcome frame has one row per rule, so collecting it is bounded by the
    rule set and not by the data.
    """
    outcomes = evaluate(df, rules, context)
    rows = outcomes.collect()
    if results:
        frame = df.sparkSession.createDataFrame(rows, outcomes.schema)
        publish(frame, results)
    failed = [f"{r.rule} ({r.failing_rows} rows)" for r in rows if r.outcome == FAILED]
    if failed:
        raise QualityError(f"{context}: " + "; ".join(failed))
    return df


def missing_references(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values of the facts that the dimension lacks, with their row counts."""
    found = facts.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return found.join(dimension.select(key), key, "left_anti")


def require_references(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Return ``facts`` if the dimension knows every key; raise if not."""
    if not missing_references(facts, dimension, key).isEmpty():
        raise QualityError(f"facts refer to {key} values the dimension lacks")
    return facts
