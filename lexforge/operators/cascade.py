"""A second chance for rows that a lookup doesn't know: the next of several keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize


def cascade_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], on: str, hit: str = "hit") -> DataFrame:
    """The rows with the lookup's columns by the first of their keys that it knows, and the number of that key from 0; null where it knows none.

    Only rows without a hit go to the next key, so a table in which most rows hit at once is hardly joined again. The lookup holds one row per ``on``; null keys and nulls in it
    never meet, and a row whose lookup columns are null is a hit all the same.
    """
    if not keys:
        raise ValueError("a cascade has one key or more")
    kept = [c for c in lookup.columns if c != on]
    table = lookup.filter(F.col(on).isNotNull()).select(F.col(on).alias("_key"), F.struct(F.lit(True).alias("_hit"), *kept).alias("_found"))
    done, left = [], rows
    for number, key in enumerate(keys):
        met = materialize(lookup_join(left.withColumn("_key", F.col(key)), table, ["_key"]).drop("_key"), "cascade")
        known = met.filter("_found is not null")
        done.append(known.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in kept], F.lit(number).alias(hit)))
        left = met.filter("_found is null").select(*rows.columns)
    types = dict(lookup.dtypes)
    result = left.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in kept], F.lit(None).cast("int").alias(hit))
    for part in done:
        result = result.unionByName(part)
    return result
