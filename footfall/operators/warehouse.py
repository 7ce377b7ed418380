"""Star schema: fact shapes, schema change, dimensions and load stamp."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.schema import COUNTRIES, DEVICE_TYPES
from footfall.sources.staging import stage

# --- fixed values: metric, fact table and column types of the standard load --------
FACT_TABLES = {
    "top_pages": "fact_top_pages",
    "bounce_rate": "fact_bounce_rate",
    "funnel": "fact_conversion_funnel",
    "product_gap": "fact_product_gap",
    "nav_paths": "fact_nav_paths",
    "device_country": "fact_device_country",
    "anomalies": "fact_anomalies",
}

FACT_SCHEMAS = {
    "top_pages": """dt date, page_url string, page_type string, views int,
        avg_time_on_page double, p95_time_on_page double""",
    "bounce_rate": """dt date, landing_page_type string, total_sessions int,
        bounce_sessions int, bounce_rate double""",
    "funnel": """dt date, stage string, sessions int,
        conversion_rate_from_previous double, conversion_rate_overall double""",
    "product_gap": """dt date, product_id string, category string, views int, cart_adds int,
        conversion double, gap_score double""",
    "nav_paths": "dt date, path string, sessions int, avg_path_length double",
    "device_country": """dt date, device_type string, country string, page_views int,
        avg_time_on_page double, p95_time_on_page double, unique_sessions int""",
    "anomalies": """dt date, session_id string, user_id string, total_events int,
        session_duration_seconds double, unique_pages int, events_per_minute double,
        z_total_events double, z_session_duration_seconds double, z_unique_pages double,
        z_events_per_minute double, total_flags smallint, anomaly_type string""",
}

# --- fixed values: exact numeric types of the warehouse columns --------------------
NUMERIC_SCHEMAS = {
    "top_pages": """dt date, page_url string, page_type string, views int,
        avg_time_on_page decimal(10,2), p95_time_on_page decimal(10,2)""",
    "bounce_rate": """dt date, landing_page_type string, total_sessions int,
        bounce_sessions int, bounce_rate decimal(6,4)""",
    "funnel": """dt date, stage string, sessions int,
        conversion_rate_from_previous decimal(6,4), conversion_rate_overall decimal(6,4)""",
    "product_gap": """dt date, product_id string, category string, views int, cart_adds int,
        conversion decimal(6,4), gap_score decimal(6,4)""",
    "nav_paths": "dt date, path string, sessions int, avg_path_length decimal(5,2)",
    "device_country": """dt date, device_type string, country string, page_views int,
        avg_time_on_page decimal(10,2), p95_time_on_page decimal(10,2), unique_sessions int""",
    "anomalies": """dt date, session_id string, user_id string, total_events int,
        session_duration_seconds decimal(12,2), unique_pages int,
        events_per_minute decimal(10,4),
        z_total_events decimal(8,3), z_session_duration_seconds decimal(8,3),
        z_unique_pages decimal(8,3), z_events_per_minute decimal(8,3),
        total_flags smallint, anomaly_type string""",
}

BUSINESS_KEYS = {
    "top_pages": ("dt", "page_url", "page_type"),
    "bounce_rate": ("dt", "landing_page_type"),
    "funnel": ("dt", "stage"),
    "product_gap": ("dt", "product_id", "category"),
    "nav_paths": ("dt", "path"),
    "device_country": ("dt", "device_type", "country"),
    "anomalies": ("dt", "session_id", "user_id"),
}

DATE_SCHEMA = """dt date, year smallint, month smallint, day smallint, day_of_week smallint,
    is_weekend boolean, week_of_year smallint"""


def change_schema(df: DataFrame, schema: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Select, rename and cast; columns that ``schema`` does not list are dropped.

    ``renames`` maps a target column to its source where the names differ.
    """
    source = renames or {}
    return df.select(
        *[
            F.col(source.get(f.name, f.name)).cast(f.dataType).alias(f.name)
            for f in StructType.fromDDL(schema).fields
        ]
    )


def to_fact(metric: str, df: DataFrame, exact: bool = False) -> DataFrame:
    """A metric table in the shape of its fact table."""
    return change_schema(df, (NUMERIC_SCHEMAS if exact else FACT_SCHEMAS)[metric])


def with_load_stamp(df: DataFrame, metric: str | None = None) -> DataFrame:
    """Add ``loaded_at``; with ``metric``, also an id derived from the business key."""
    stamped = df.withColumn("loaded_at", F.current_timestamp())
    return stamped if metric is None else stamped.withColumn(
        "id", F.xxhash64(*BUSINESS_KEYS[metric])
    )


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame with a ``dt`` column; Monday is day 0."""
    weekday = F.weekday("dt")
    rows = days.select(
        "dt",
        F.year("dt").alias("year"),
        F.month("dt").alias("month"),
        F.dayofmonth("dt").alias("day"),
        weekday.alias("day_of_week"),
        (weekday >= 5).alias("is_weekend"),
        F.weekofyear("dt").alias("week_of_year"),
    )
    return change_schema(rows, DATE_SCHEMA)


def dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = (end - start).days + 1
    return calendar(
        spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("dt"))
    )


def calendar_spanning(df: DataFrame, column: str) -> DataFrame:
    """Calendar from the first to the last day of a date column."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return calendar(ends.select(F.explode(F.sequence("first", "last")).alias("dt")))


def _one_column(spark: SparkSession, name: str, members: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([(m,) for m in members], f"{name} string")


def dim_device(spark: SparkSession) -> DataFrame:
    return _one_column(spark, "device_type", DEVICE_TYPES)


def dim_country(spark: SparkSession) -> DataFrame:
    """Country codes; the name column of the table has no source and stays NULL."""
    return _one_column(spark, "country_code", COUNTRIES).withColumn(
        "country_name", F.lit(None).cast("string")
    )


def absent_rows(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``existing`` lacks: insert, do nothing on conflict.

    Of several new rows with one key the smallest in the order of their other columns
    is inserted, so a load that is run again inserts the same.
    """
    rest = [c for c in new.columns if c not in keys]
    if not rest:
        return new.dropDuplicates(keys).join(existing, keys, "left_anti")
    first = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__first"))
    rows = first.select(*keys, "__first.*").select(*new.columns)
    return rows.join(existing, keys, "left_anti")


def with_serial_ids(new: DataFrame, order: list[str], last: int = 0) -> DataFrame:
    """Add ``serial_id``: numbers without gaps in ascending ``order``, continued after ``last``.

    Rows are dealt into ranges of ``order``, numbered inside them and shifted by the
    sizes of the ranges before, so only one row per range meets in one task. ``order``
    should be unique; rows that are equal in it may swap their numbers.
    """
    places = [F.col(c).asc_nulls_first() for c in order]
    dealt = stage(
        new.repartitionByRange(*places).withColumn("__range", F.spark_partition_id()), "serial"
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows")).select(
        "__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift")
    )
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*places))
    numbered = dealt.withColumn("serial_id", inside).join(stage(shifts, "serial_shifts"), "__range")
    number = (F.col("serial_id") + F.col("__shift") + F.lit(last)).cast("long")
    return numbered.withColumn("serial_id", number).drop("__range", "__shift")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
