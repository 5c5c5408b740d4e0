"""Nested lists: rows of one key as an array of structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.symbols import KANJI, distinct_symbols, has_symbol
from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize
from lexforge.operators.ranking import number_rows

PART_ROWS = 50_000
# A task that collects lists holds about so many rows of them at once.
TASK_ROWS = 2 * PART_ROWS


def nest(df: DataFrame, key: str, item: Column, out: str, order: Sequence[Column] = (),
         part_rows: int | None = None, part: str = "part") -> DataFrame:
    """Collect the items of each key into ``out``, sorted by ``order`` and then by the item.

    A key with more than ``part_rows`` rows continues on further rows, numbered by ``part`` from 0,
    so that no task has to hold the whole list of a hot key. All items are kept: the parts of a key, one
    after the other, are its whole list in the declared order, and all but the last hold ``part_rows`` items.
    The lists are collected in as many tasks as their rows ask for, so that no task holds many long lists. The
    table is read several times.
    """
    part_rows = part_rows or PART_ROWS
    sorting = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], item.alias("_item")).alias("_s")
    # keys go by their hash, which is never null; two keys that share one are numbered each on its own
    rows = df.select(key, F.xxhash64(key).alias("_hash"), sorting)
    counts = materialize(rows.groupBy("_hash").agg(F.count("*").alias("_n")), "counts")
    tasks = max(1, -(-(counts.agg(F.sum("_n")).first()[0] or 0) // max(TASK_ROWS, 2 * part_rows)))
    hot = materialize(counts.filter(F.col("_n") > part_rows).select("_hash", F.lit(True).alias("_long")), "hot")
    if hot.isEmpty():
        parted = rows.withColumn(part, F.lit(0))
    else:
        known = lookup_join(rows, hot, ["_hash"])
        # the rows of a long list are numbered in its order, over ranges, and cut at equal places
        numbered = number_rows(known.filter("_long").select(key, "_s"), [F.col("_s").asc()], [key])
        cut = numbered.select(key, "_s", F.expr(f"int((position - 1) div {int(part_rows)})").alias(part))
        parted = known.filter("_long is null").select(key, "_s", F.lit(0).alias(part)).unionByName(cut)
    nested = parted.repartition(tasks, key, part).groupBy(key, part).agg(F.sort_array(F.collect_list("_s")).alias(out))
    return nested.withColumn(out, F.transform(out, lambda x: x["_item"]))


def symbols_of(df: DataFrame, word: str, out: str, symbol: str = KANJI) -> DataFrame:
    """One row per word and distinct symbol in it; words without a symbol drop out."""
    return df.filter(has_symbol(F.col(word), symbol)).withColumn(
        out, F.explode(distinct_symbols(F.col(word), symbol))
    )


def whole_row(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in (columns or df.columns)])


def first_by(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: the first in the given order."""
    others = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return kept.select(key, "_row.*")


def merged_lists(df: DataFrame, key: str, items: str, order: Column, part_rows: int | None = None) -> DataFrame:
    """One list per key: the distinct items of all its rows, in order of first occurrence.

    Copies of an item are removed before the shuffle; very long lists continue as in :func:`nest`.
    Keys whose lists are all empty keep an empty list.
    """
    exploded = df.select(key, order.alias("_o"), F.posexplode_outer(items).alias("_i", "_item"))
    distinct = exploded.groupBy(key, "_item").agg(F.min(F.struct("_o", "_i")).alias("_at"))
    nested = nest(distinct, key, F.col("_item"), items, [F.col("_at")], part_rows)
    return nested.withColumn(items, F.filter(items, lambda x: x.isNotNull()))
