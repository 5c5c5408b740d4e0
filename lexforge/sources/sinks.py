"""Sinks. The number of files follows the data unless a layout is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.readwriter import DataFrameWriter


def _laid_out(df: DataFrame, partitions: int | None, rows_per_file: int | None, single_file: int | None) -> DataFrameWriter:
    if single_file is not None:
        if df.count() > single_file:
            raise ValueError(f"the table has more than {single_file} rows; use partitions=")
        # a shuffle, so that only the writing is one task
        df = df.repartition(1)
    elif partitions:
        df = df.repartition(partitions)
    writer = df.write.mode("overwrite")
    return writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer


def write_json(df: DataFrame, path: str, partitions: int | None = None, rows_per_file: int | None = None,
               single_file: int | None = None) -> None:
    """JSON lines; null fields are left out. ``rows_per_file=1`` gives one file per row.

    ``single_file`` asks for one file, written by one task, and says how many rows it may hold at most.
    """
    _laid_out(df, partitions, rows_per_file, single_file).json(path)


def write_text(df: DataFrame, path: str, column: str | None = None, partitions: int | None = None,
               rows_per_file: int | None = None) -> None:
    """One line per row, from a single text column."""
    lines = df.select(column) if column else df
    _laid_out(lines, partitions, rows_per_file, None).text(path)


def write_csv(df: DataFrame, path: str, header: bool = False, single_file: int | None = None) -> None:
    """Flat columns only: lists and structs have no CSV form."""
    nested = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    if nested:
        raise ValueError(f"nested columns cannot be written as CSV: {', '.join(nested)}")
    _laid_out(df, None, None, single_file).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    _laid_out(df, None, rows_per_file, None).parquet(path)
