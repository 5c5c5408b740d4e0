"""Equi-joins: size-checked broadcast, skew-safe lookup, star assembly."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.operators.materialize import materialize

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# A key with more rows than this is taken apart, into one task for each HOT_ROWS of its rows.
HOT_ROWS = 100_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure the table's rows and bytes, in one pass that moves one row per task."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, total = df.select(width.alias("b")).agg(F.count("*"), F.sum("b")).first()
    return n <= rows and (total or 0) <= size


def spread(df: DataFrame, n: int) -> Column:
    """A number in 0..n-1 that scatters rows, copies of one row included.

    It depends on the row and on its input partition only, so a task that is run again assigns the
    same numbers.
    """
    hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]
    # the hash is reduced first: a sum with a full 64-bit hash could overflow
    return F.pmod(F.pmod(F.xxhash64(*hashed), F.lit(n)) + F.spark_partition_id(), F.lit(n)).cast("int")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                   never_null: Sequence[str] = ()) -> DataFrame:
    """An equi-join in which nulls are equal; the keys of the left side remain."""
    names = {k: f"_r_{k}" for k in [*never_null, *on]}
    renamed = right.withColumnsRenamed(names)
    condition = F.lit(True)
    for k in never_null:
        condition = condition & (left[k] == renamed[names[k]])
    for k in on:
        condition = condition & left[k].eqNullSafe(renamed[names[k]])
    return left.join(renamed, condition, how).drop(*names.values())


def lookup_join(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows whose keys may be skewed to a table with one row per key.

    A lookup table of checked size is broadcast; beyond that the join is a shuffle that takes hot
    keys apart.
    """
    if how not in ("left", "inner"):
        raise ValueError("a lookup join is left or inner")
    on = list(on)
    if fits_broadcast(lookup):
        return big.join(F.broadcast(lookup), on, how)
    return skew_join(big, lookup, on, how, hot_keys(big.groupBy(*on).agg(F.count("*").alias("_n")), on, "_n"))


def hot_keys(counts: DataFrame, on: Sequence[str], n: str, above: int | None = None) -> DataFrame:
    """(on..., _salts): the keys that hold more than ``above`` rows, from a table of counts, and over how many places to scatter them.

    Should they be too many to be sent to every task, the bound rises until they are not; any other key then holds a
    negligible part of the rows.
    """
    bound = HOT_ROWS if above is None else above
    salts = F.ceil(F.col("_rows") / F.lit(max(bound, 1))).cast("int") + 1
    found = materialize(counts.filter(F.col(n) > bound).select(*on, F.col(n).alias("_rows")), "hot")
    while found.count() > BROADCAST_ROWS:
        bound *= 4
        found = materialize(found.filter(F.col("_rows") > bound), "hot")
    return found.select(*on, salts.alias("_salts"))


def skew_join(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str, hot: DataFrame,
              null_safe: bool = False) -> DataFrame:
    """Shuffle join in which only the ``hot`` keys are salted, each over as many places as its rows ask for.

    A hot row of the big side goes to one of them, and the lookup row of its key to all. Rows with a null key match
    nothing unless ``null_safe``; they are scattered as well.
    """
    on = list(on)
    marks = F.broadcast(hot)
    salts = F.col("_salts")
    place = F.when(salts.isNotNull(), F.pmod(spread(big, 1 << 20), salts))
    if not null_safe:
        for k in on:
            place = place.when(F.col(k).isNull(), spread(big, 1 << 20))
    left = null_safe_join(big, marks, on, "left").withColumn("_salt", place.otherwise(0).cast("int")).drop("_salts")
    right = null_safe_join(lookup, marks, on, "left").withColumn(
        "_salt", F.explode(F.when(salts.isNotNull(), F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0))))).drop("_salts")
    if null_safe:
        return null_safe_join(left, right, on, how, never_null=["_salt"]).drop("_salt")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


@dataclass(frozen=True)
class Dimension:
    """A table with one row per ``key``, joined to the hub's key."""

    table: DataFrame
    key: str
    how: str = "left"
    columns: Sequence[str] = field(default_factory=tuple)

    def narrowed(self) -> DataFrame:
        kept = [c for c in (self.columns or self.table.columns) if c != self.key]
        return self.table.select(F.col(self.key).alias("_key"), *kept)


def star_join(hub: DataFrame, key: str, dimensions: Iterable[Dimension]) -> DataFrame:
    """Join every dimension to the hub on one key; the dimension's own key column is not kept.

    Hub and dimensions hold one row per key, so no key is hot. All joins share the key: a hub that is
    shuffled once stays in place for the next dimension, and the planner broadcasts a dimension by
    its measured size.
    """
    result = hub
    for d in dimensions:
        side = d.narrowed()
        result = result.join(side, result[key] == side["_key"], d.how).drop("_key")
    return result


def full_join_on_any(frames: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """Full outer join of tables that each name their key differently; the keys become one column."""
    (first, first_key), *others = frames
    result = first.withColumnRenamed(first_key, key)
    for table, table_key in others:
        result = result.join(table.withColumnRenamed(table_key, key), key, "full")
    return result
