"""Materialise-or-load: a result that later runs read back, as long as its inputs are the same."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge import __version__


def source_fingerprint(spark: SparkSession, paths: Sequence[str], version: str = __version__) -> str:
    """A short digest of the input files' names, sizes and times, and of the version; no file is read."""
    # the file content column is not selected, so the scan only lists
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    seen = files.select(F.xxhash64("path", "length", "modificationTime").alias("h"), "length").agg(
        F.count("*"), F.sum("length"), F.bit_xor("h")
    )
    n, size, digest = seen.first()
    return f"v{version}-{n}-{size or 0}-{(digest or 0) & (2**64 - 1):016x}"


def is_complete(spark: SparkSession, path: str) -> bool:
    """The folder holds the marker that Spark writes when a job has committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], create: bool = True,
           fingerprint: str = "current") -> DataFrame:
    """Read ``<path>-cache/<fingerprint>`` if it is complete; otherwise build, write and read back.

    With ``create=False`` a miss returns the plan unwritten. Other inputs give another fingerprint and
    so another folder: a stale result is never read.
    """
    target = f"{path}-cache/{fingerprint}"
    if is_complete(spark, target):
        return spark.read.parquet(target)
    built = build()
    if not create:
        return built
    built.write.mode("overwrite").parquet(target)
    return spark.read.schema(built.schema).parquet(target)
