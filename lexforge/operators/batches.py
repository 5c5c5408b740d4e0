"""Batches of entry lines as request bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.operators.materialize import materialize
from lexforge.operators.ranking import ROW_BITS, number_rows, row_of


def entry_batches(df: DataFrame, table: str, n: int, entry: str = "entry",
                  order: Sequence[Column] | None = None) -> DataFrame:
    """Put ``n`` entry lines into each request body; the comma after the last line is removed.

    Without an order, the lines of each partition are batched as they come, and its last batch may be
    short; the lines are written once, so that none changes its batch when a task runs again. With an
    order, the batches follow it over the whole table, and only the last may be short.
    """
    if order:
        numbered = number_rows(df, list(order))
    else:
        numbered = materialize(df.select(entry, F.monotonically_increasing_id().alias("_id")), "lines").withColumns({
            "block": F.shiftright("_id", ROW_BITS), "position": row_of(F.col("_id")) + 1})
    block = [F.col("block")] if "block" in numbered.columns else [F.lit(0).cast("bigint").alias("block")]
    batched = numbered.groupBy(*block, F.expr(f"(position - 1) div {int(n)}").alias("batch")).agg(
        F.count("*").alias("n_entries"),
        F.sort_array(F.collect_list(F.struct("position", F.col(entry).alias("line")))).alias("_lines"),
    )
    lines = F.array_join(F.transform("_lines", lambda x: x["line"]), " ")
    # The request envelope.
    body = F.concat(
        F.lit('{"RequestItems":{"' + table + '": ['), F.regexp_replace(lines, ",$", ""), F.lit("]}}")
    )
    return batched.select("block", "batch", "n_entries", body.alias("body"))
