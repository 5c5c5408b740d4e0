"""One-pass profile of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, distinct: bool = True) -> DataFrame:
    """One row per column: its type, the table's rows, the column's nulls, its approximate distinct values.

    One aggregate row is computed in one pass and then turned on its side.
    """
    wanted = [F.count("*").alias("_rows")]
    for i, (name, kind) in enumerate(df.dtypes):
        column = F.col(f"`{name}`")
        wanted.append(F.count_if(column.isNull()).alias(f"_nulls{i}"))
        if distinct:
            hashed = F.to_json(column) if kind.startswith("map") else F.when(column.isNotNull(), F.xxhash64(column))
            wanted.append(F.approx_count_distinct(hashed).alias(f"_distinct{i}"))
    reports = []
    for i, (name, kind) in enumerate(df.dtypes):
        fields = [F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"),
                  F.col("_rows").alias("n_rows"), F.col(f"_nulls{i}").alias("n_nulls")]
        if distinct:
            fields.append(F.col(f"_distinct{i}").alias("n_distinct"))
        reports.append(F.struct(*fields))
    return df.agg(*wanted).select(F.inline(F.array(*reports)))


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_distinct): exact counts of the values that are not null.

    Values become text, copies fall together before and after one shuffle for all columns, and the counts of the distinct rows
    are summed; so no task holds the values of a column.
    """
    def as_text(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        return F.to_json(F.struct(column)) if kind.startswith(("array", "map", "struct")) else column.cast("string")

    items = [F.struct(F.lit(n).alias("column_name"), F.when(F.col(f"`{n}`").isNotNull(), as_text(n, k)).alias("_v")) for n, k in df.dtypes]
    values = df.select(F.inline(F.array(*items))).distinct()
    return values.groupBy("column_name").agg(F.count("_v").alias("n_distinct"))
