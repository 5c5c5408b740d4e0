"""Joins, star assembly, and nesting in both directions; letters stand for symbols, terms for words."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.symbols import LETTER, characters
from lexforge.operators.joins import Dimension, lookup_join, star_join
from lexforge.operators.materialize import materialize
from lexforge.operators.profile import distinct_counts, profile
from lexforge.operators.ranking import dense_ranks
from lexforge.plans.crossing import symbols_per_word, symbols_with_words, words_per_symbol, words_with_symbols
from lexforge.queries.base import LETTERS, Query, table, term_counts



def left_enrich(spark, sf_dir):
    """Orders with their customers and nations; order keys without a customer stay."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return lookup_join(lookup_join(orders, customers, ["c_custkey"]), nations, ["n_nationkey"])


def star_master(spark, sf_dir):
    """Customers as the hub; dimensions of one row per customer; customers without orders are dropped."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    spent = orders.groupBy(F.col("o_custkey").alias("k1")).agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("largest"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("k2")).agg(
        F.count("*").alias("n_urgent"), F.min("o_orderkey").alias("first_urgent"))
    quantity = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("k3")).agg(
        F.sum("q").cast("long").alias("quantity"))
    places = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("c_custkey").alias("k4"), "n_name", "r_name", "c_mktsegment")
    hub = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    master = star_join(hub, "c_custkey", [
        Dimension(spent, "k1", "inner", ["n_orders"]), Dimension(urgent, "k2"), Dimension(quantity, "k3"),
        Dimension(places, "k4", columns=["n_name", "r_name"]),
        Dimension(table(spark, sf_dir, "supplier"), "s_suppkey", columns=["s_name"])])
    return master


def _vocabulary(spark, sf_dir):
    words = materialize(term_counts(spark, sf_dir), "words").withColumnsRenamed({"term": "word", "n": "totalOcurrences"})
    return materialize(dense_ranks(words, {"rank": "totalOcurrences"}, written=True), "ranked")


def _letters(vocabulary):
    """One row per letter: the words and the occurrences that hold it."""
    pairs = vocabulary.select("totalOcurrences", F.explode(F.array_distinct(characters(F.col("word")))).alias("kanji"))
    return pairs.groupBy("kanji").agg(F.count("*").alias("n_words"), F.sum("totalOcurrences").alias("n"))


def symbol_words(spark, sf_dir):
    """Letters with all their words; the lists come out again as rows, so that the whole of them is compared."""
    vocabulary = _vocabulary(spark, sf_dir)
    letters = materialize(_letters(vocabulary), "letters")
    nested = symbols_with_words(letters, words_per_symbol(vocabulary, symbol=LETTER))
    return nested.select("kanji", "n_words", F.inline("vocabsPerKanji"))


def symbol_words_in_parts(spark, sf_dir):
    """The same in parts of 500 words: every word with the part of its letter's list and its place there."""
    nested = words_per_symbol(_vocabulary(spark, sf_dir), columns=["word", "totalOcurrences"], symbol=LETTER, part_rows=500)
    return nested.select("vocabK", "part", F.posexplode("vocabsPerKanji").alias("pos", "w")).select(
        "vocabK", "part", "pos", F.col("w.word").alias("word"), F.col("w.totalOcurrences").alias("n"))


def word_symbols(spark, sf_dir):
    """Terms with the rows of their letters, in the order of the word; the letters of part names are the dimension."""
    vocabulary = _vocabulary(spark, sf_dir)
    held = table(spark, sf_dir, "part").select(F.explode(characters(F.col("p_name"))).alias("kanji")).distinct()
    letters = materialize(_letters(vocabulary).join(held, "kanji", "left_semi"), "letters")
    per_word = symbols_per_word(vocabulary, letters, symbol=LETTER)
    joined = words_with_symbols(vocabulary, per_word)
    return joined.select("word", "rank", F.array_join(
        F.transform("kanjisInVocab", lambda k: F.concat_ws(":", k["kanji"], k["n"].cast("string"))), "|").alias("letters"))


def order_profile(spark, sf_dir):
    """Rows and nulls per column of orders that are looked up among the customers."""
    enriched = left_enrich(spark, sf_dir)
    return profile(enriched, distinct=False).drop("column_type")


def distinct_profile(spark, sf_dir):
    """Rows, nulls and exact distinct values per column of the events; the estimates of the one-pass profile lie near them."""
    events = table(spark, sf_dir, "events")
    near = profile(events).select("column_name", "n_rows", "n_nulls", F.col("n_distinct").alias("_estimate"))
    exact = distinct_counts(events)
    return near.join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", "n_distinct",
        (F.abs(F.col("_estimate") - F.col("n_distinct")) <= F.greatest(F.lit(2.0), F.col("n_distinct") * 0.2)).alias("estimate_near"))


_ENRICHED = """enriched AS (SELECT o_orderkey, o_custkey * 2 AS c_custkey, c_name, c_nationkey AS n_nationkey, n_name
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2 LEFT JOIN nation ON n_nationkey = c_nationkey)"""
_SYMBOL_SQL = LETTERS + """, ranked AS (SELECT term, n, dense_rank() OVER (ORDER BY n DESC) AS rank FROM terms),
    stats AS (SELECT letter, count(*) AS n_words, sum(n)::BIGINT AS n FROM letters GROUP BY letter)"""

QUERIES = {
    "left_enrich": Query(left_enrich, f"WITH {_ENRICHED} SELECT * FROM enriched"),
    "star_master": Query(star_master, """SELECT c_custkey, c_name, n_orders, n_urgent, first_urgent, quantity, n_name, r_name, s_name
        FROM customer
        JOIN (SELECT o_custkey AS k1, count(*) AS n_orders FROM orders GROUP BY o_custkey) ON k1 = c_custkey
        LEFT JOIN (SELECT o_custkey AS k2, count(*) AS n_urgent, min(o_orderkey) AS first_urgent FROM orders
            WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) ON k2 = c_custkey
        LEFT JOIN (SELECT o_custkey AS k3, sum(l_quantity)::BIGINT AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey
            GROUP BY o_custkey) ON k3 = c_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN supplier ON s_suppkey = c_custkey"""),
    "symbol_words": Query(symbol_words, f"""WITH {_SYMBOL_SQL}
        SELECT l.letter AS kanji, n_words, l.term AS word, l.n AS "totalOcurrences", rank
        FROM letters AS l JOIN ranked AS r ON r.term = l.term JOIN stats AS s ON s.letter = l.letter"""),
    "symbol_words_in_parts": Query(symbol_words_in_parts, f"""WITH {_SYMBOL_SQL}, placed AS (
            SELECT letter, l.term, l.n, row_number() OVER (PARTITION BY letter ORDER BY rank, l.term) - 1 AS spot
            FROM letters AS l JOIN ranked AS r ON r.term = l.term)
        SELECT letter AS "vocabK", (spot // 500)::INTEGER AS part, (spot % 500)::INTEGER AS pos, term AS word, n FROM placed"""),
    "word_symbols": Query(word_symbols, f"""WITH {_SYMBOL_SQL}, held AS (SELECT DISTINCT unnest(string_split(p_name, '')) AS letter FROM part)
        SELECT r.term AS word, rank, coalesce(string_agg(l.letter || ':' || s.n, '|' ORDER BY l.pos)
            FILTER (WHERE h.letter IS NOT NULL), '') AS letters
        FROM ranked AS r JOIN letters AS l ON l.term = r.term JOIN stats AS s ON s.letter = l.letter
        LEFT JOIN held AS h ON h.letter = l.letter GROUP BY r.term, rank"""),
    "order_profile": Query(order_profile, f"WITH {_ENRICHED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM enriched"
        for c in ("o_orderkey", "c_custkey", "c_name", "n_nationkey", "n_name"))),
    "distinct_profile": Query(distinct_profile, " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct, true AS estimate_near FROM events"
        for c in ("event_id", "ts", "user_id", "event_type", "value", "props"))),
}
