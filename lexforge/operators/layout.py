"""Row order and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_rank(df: DataFrame, rank: str, key: str, nulls_first: bool = True) -> DataFrame:
    """Total order by rank; rows without a rank lead unless told otherwise."""
    first = F.asc_nulls_first(rank) if nulls_first else F.asc_nulls_last(rank)
    return df.orderBy(first, F.asc(key))


def widen(df: DataFrame) -> DataFrame:
    """Spread the rows of a scan that has fewer partitions than the cluster has cores.

    For costly work per row on a few files that cannot be split. A large scan is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def more_than(df: DataFrame, column: str, bound: int) -> DataFrame:
    return df.filter(F.col(column) > bound)


def preview(df: DataFrame, n: int = 50) -> DataFrame:
    """The first rows, as a report; 50 of them unless told otherwise."""
    return df.limit(n)


def keep(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select a declared output list, skipping names the table does not have."""
    return df.select(*[c for c in columns if c in df.columns])
