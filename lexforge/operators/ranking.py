"""Ranks and numbering over whole tables without a single-task window.

A rank without a natural partition would move every row to one task. Here the distinct values are
counted first (copies collapse before the shuffle), range-partitioned in rank order, numbered inside
each range, and shifted by the sizes of the ranges before it. The ranks then go back to the rows by
value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.operators.joins import fits_broadcast, hot_keys, null_safe_join, skew_join
from lexforge.operators.materialize import materialize

WINDOW_ROWS = 100_000
ROW_BITS = 33


def row_of(identifier: Column) -> Column:
    """The number of a row in its partition, from 0, out of a monotonically increasing identifier."""
    return identifier.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def number_rows(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (),
                out: str = "position") -> DataFrame:
    """Number the rows 1, 2, ... in a total order, inside each group, on any number of tasks.

    Rows that compare equal are told apart by their input partition, so copies of one row spread over
    several ranges. The numbering inside a range is written before the ranges are added up: a range
    that is computed again could otherwise be cut elsewhere.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = [*[F.col(g).asc() for g in group], *order, F.col("_src").asc()]
    ordered = (
        df.withColumn("_src", F.spark_partition_id())
        .repartitionByRange(n, *total)
        .sortWithinPartitions(*total)
        .drop("_src")
        # the identifier holds the partition in its upper bits and the row number in the lower 33
        .withColumn("_id", F.monotonically_increasing_id())
    )
    table = materialize(
        ordered.withColumns(
            {"_block": F.shiftright("_id", ROW_BITS), "_row": row_of(F.col("_id"))}
        ).drop("_id"),
        "ordered",
    )
    # one row per group and range that holds it; a group has at most one row per range here
    heads = table.groupBy(*group, "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = null_safe_join(table, heads, group, "inner", never_null=["_block"])
    return placed.withColumn(out, F.col("_row") - F.col("_first") + F.col("_before") + 1).drop(
        "_block", "_row", "_first", "_before"
    )


def dense_ranks(df: DataFrame, ranks: Mapping[str, str], group: Sequence[str] = (), descending: bool = True,
                window_rows: int | None = None, written: bool = False) -> DataFrame:
    """Add one dense rank per entry ``{new column: ranked column}``, inside each group.

    All ranked columns of one type share one pass. Nulls rank last when descending and first when
    ascending. A plain window is used only where the distinct values number ``window_rows`` or less
    (WINDOW_ROWS if not given). ``written`` says that the table is a written one, whose rows are counted
    at no cost: with that few rows it is ranked as it stands.
    """
    window_rows = WINDOW_ROWS if window_rows is None else window_rows
    if written and df.count() <= window_rows and _narrow(df):
        return df.withColumns({out: _plain_rank(group, F.col(c), descending) for out, c in ranks.items()})
    by_type: dict[str, dict[str, str]] = {}
    for out, column in ranks.items():
        by_type.setdefault(df.schema[column].dataType.simpleString(), {})[out] = column
    for wanted in by_type.values():
        df = _dense_ranks_of_type(df, wanted, list(group), descending, window_rows)
    return df


def _narrow(df: DataFrame) -> bool:
    """A table without lists and structs, whose rows a single task can take with their rank."""
    return not any(t.startswith(("array", "map", "struct")) for _, t in df.dtypes)


def _plain_rank(group: Sequence[str], value: Column, descending: bool) -> Column:
    within = Window.partitionBy(*group).orderBy(value.desc() if descending else value.asc())
    return F.dense_rank().over(within).cast("long")


def _dense_ranks_of_type(df: DataFrame, wanted: Mapping[str, str], group: list[str], descending: bool,
                         window_rows: int) -> DataFrame:
    items = [F.struct(F.lit(out).alias("_metric"), F.col(c).alias("_value")) for out, c in wanted.items()]
    values = df.select(*group, F.explode(F.array(*items)).alias("_e")).select(*group, "_e.*")
    keys = [*group, "_metric", "_value"]
    counted = materialize(values.groupBy(*keys).agg(F.count("*").alias("_rows")), "values")
    small = counted.count() <= window_rows
    if small:
        ranked = counted.withColumn("_rank", _plain_rank([*group, "_metric"], F.col("_value"), descending))
    else:
        order = F.col("_value").desc() if descending else F.col("_value").asc()
        ranked = number_rows(counted, [order], [*group, "_metric"], "_rank")
    # the ranks go back to the rows by value
    for out, column in wanted.items():
        keys = [*group, column]
        own = ranked.filter(F.col("_metric") == out).select(
            *group, F.col("_value").alias(column), F.col("_rank").alias(out))
        # few values, but a value may be a long text: the bytes count as well
        if small and fits_broadcast(own):
            df = null_safe_join(df, F.broadcast(own), keys, "left")
        else:
            rows = counted.filter(F.col("_metric") == out).withColumnRenamed("_value", column)
            df = skew_join(df, own, keys, "left", hot_keys(rows, keys, "_rows"), null_safe=True)
    return df
