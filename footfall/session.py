"""Session settings shared by every job."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a running session accepts, so they can also be applied to a session
# that somebody else built (a notebook, a test harness).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a repeated key in a JSON line counts with its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "footfall", **extra: str) -> SparkSession:
    """Get or create a session; ``extra`` adds settings such as ``{"spark.master": ...}``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
