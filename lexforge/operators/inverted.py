"""An inverted index: which keys hold an item, and which hold all of several."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize
from lexforge.operators.nesting import nest

# a task keeps about so many pairs in memory to find repeated ones
DISTINCT_ROWS = 500_000


def posting_lists(pairs: DataFrame, key: str, item: str, out: str = "keys", part_rows: int | None = None) -> DataFrame:
    """(item, part, n, keys): the keys that hold each item, in order; n counts all of them.

    A list that is too long for one row goes on in further parts. Pairs with a null end and repeated ones don't count.
    """
    given = materialize(pairs.select(item, key).filter(F.col(item).isNotNull() & F.col(key).isNotNull()), "given")
    once = materialize(given.repartition(max(1, -(-given.count() // DISTINCT_ROWS)), item, key).distinct(), "pairs")
    lists = materialize(nest(once, item, F.col(key), out, part_rows=part_rows), "postings")
    sizes = once.groupBy(item).agg(F.count("*").alias("n"))
    return lists.join(sizes, item).select(item, "part", "n", out)


def holding_all(lists: DataFrame, queries: DataFrame, query: str, key: str, item: str, out: str = "keys") -> DataFrame:
    """(query, key): the keys that hold every item of a query.

    Each query starts with its rarest item: only that posting list is opened, so an item that all keys hold costs nothing unless a query asks for it alone. What is left goes
    against the next rarer item, and so on; each step is one join on (item, key) and shrinks the candidates. A query with an item that no key holds finds nothing, and so does one
    without items.
    """
    asked = queries.select(F.col(query).alias("_q"), F.col(item).alias("_i")).filter("_q is not null and _i is not null").distinct()
    sizes = lists.groupBy(F.col(item).alias("_i")).agg(F.max("n").alias("_n"))
    # a query is a short list of items
    order = Window.partitionBy("_q").orderBy("_n", "_i")
    ranked = lookup_join(asked, materialize(sizes, "sizes"), ["_i"]).withColumns({
        "_n": F.coalesce("_n", F.lit(0)), }).withColumns({"_place": F.row_number().over(order), "_least": F.min("_n").over(Window.partitionBy("_q"))})
    ranked = materialize(ranked.filter("_least > 0").select("_q", "_i", "_place"), "asked")
    longest = ranked.agg(F.max("_place")).first()[0] or 0
    opened = lists.select(F.col(item).alias("_i"), F.col(out).alias("_keys"))
    first = ranked.filter("_place = 1").select("_q", "_i")
    left = first.join(opened, "_i").select("_q", F.explode("_keys").alias("_k"))
    if longest < 2:
        return left.toDF(query, key)
    # the lists of the further items alone, as pairs
    further = ranked.filter("_place > 1").select("_i").distinct()
    pairs = materialize(opened.join(further, "_i", "left_semi").select("_i", F.explode("_keys").alias("_k")), "pairs")
    for place in range(2, longest + 1):
        left = materialize(left, "candidates")
        step = ranked.filter(F.col("_place") == place).select("_q", "_i")
        going = left.join(step, "_q", "left")
        # queries that have no further item are done
        left = going.filter("_i is null").select("_q", "_k").unionByName(going.join(pairs, ["_i", "_k"], "left_semi").select("_q", "_k"))
    return left.toDF(query, key)
