"""Written intermediate tables: results that several jobs read, or that must not be recomputed."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}
_scope: ContextVar[str] = ContextVar("scope", default="")


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only on a local master."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    # one folder per application; the session's own settings stay as they are
    application = spark.sparkContext.applicationId
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="lexforge-")
    return _local[application]


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below this application's part of the shared folder."""
    return f"{_own_folder(spark)}{_scope.get()}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{work_dir(spark).rstrip('/')}/lexforge-{spark.sparkContext.applicationId}"


@contextmanager
def own_work_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized inside are deleted at the end; plans that read them can no longer run then."""
    token = _scope.set(f"{_scope.get()}/run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, _own_folder(spark) + _scope.get())
        _scope.reset(token)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_work_tables(spark: SparkSession) -> None:
    """Delete all tables this application materialized; plans that read them can no longer run."""
    _delete(spark, _own_folder(spark))
