"""Intermediate tables that cut lineage and let Spark see real sizes.

A staged frame is written once as Parquet under the shared folder named by
``spark.checkpoint.dir``. Later plans read it back with column pruning, survive
the loss of executors, and join against its true size: Spark broadcasts it only
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.

The files are read by their path and known schema: a table of the catalogue would
cost the driver a second query for each, whose plan it keeps.
"""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_databases: dict[str, str] = {}
_local_folders: dict[str, str] = {}
_scope: ContextVar[str | None] = ContextVar("footfall_staging_scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local master."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{_CHECKPOINT_DIR} must name a folder all executors can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="footfall-")
    return _local_folders[app]


def _database(spark: SparkSession) -> str:
    app = spark.conf.get("spark.app.id")
    name = _databases.get(app)
    if name is None or not spark.catalog.databaseExists(name):
        name = _databases[app] = _new_database(spark)
    return name


def _new_database(spark: SparkSession) -> str:
    name = f"footfall_stage_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    return name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder, beside the staged frames."""
    return f"{shared_folder(spark)}/{_database(spark)}/{label}-{uuid4().hex}"


def stage(df: DataFrame, label: str, sort_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder now and return a frame reading it.

    ``sort_by`` clusters rows inside each file so filters on that column skip
    Parquet row groups.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{_scope.get() or _database(spark)}"
    path = f"{folder}/{label}_{uuid4().hex}"
    ordered = df.sortWithinPartitions(sort_by) if sort_by else df
    ordered.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession):
    """Remove what is staged inside the block when it ends."""
    own = _new_database(spark)
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
        spark.sql(f"DROP DATABASE IF EXISTS {own} CASCADE")


@contextmanager
def workspace(spark: SparkSession):
    """Remove everything staged, and all scratch folders made, inside the block when it ends.

    The block gets a database of its own below the shared folder, which is dropped with
    its tables and files. Results must be written or collected before the block ends.
    A workspace belongs to the application: do not open two in threads at a time.
    """
    app = spark.conf.get("spark.app.id")
    outer = _databases.get(app)
    own = _databases[app] = _new_database(spark)
    try:
        yield
    finally:
        if outer is None:
            _databases.pop(app, None)
        else:
            _databases[app] = outer
        spark.sql(f"DROP DATABASE IF EXISTS {own} CASCADE")
