"""Frequencies, ranks, orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexforge.functions.symbols import characters
from lexforge.operators.joins import lookup_join
from lexforge.operators.layout import more_than, order_by_rank, preview
from lexforge.operators.materialize import materialize
from lexforge.operators.ranking import dense_ranks
from lexforge.plans.frequencies import compile_stacked
from lexforge.plans.vocabulary import WORD_RANKS, word_totals
from lexforge.queries.base import CORPORA, TOKENS, Query, corpus, table, term_counts

def _stacked(counts, symbol, n):
    """(corpus, symbol, occurrences, frequency) with the share of the corpus."""
    counts = materialize(counts, "counts")
    totals = counts.groupBy("corpus").agg(F.sum(n).alias("_total"))
    return lookup_join(counts, totals, ["corpus"], "inner").select(
        "corpus", F.col(symbol).alias("symbol"), F.col(n).alias("occurrences"),
        (F.col(n) / F.col("_total")).alias("frequency"),
    )


def corpus_ranks(spark, sf_dir):
    counts = term_counts(spark, sf_dir, corpus=corpus())
    return compile_stacked(_stacked(counts, "term", "n"), CORPORA, key="term")


def symbol_ranks(spark, sf_dir):
    """The same for letters; they are counted from the term counts, not from the texts."""
    return compile_stacked(_stacked(letter_counts(term_counts(spark, sf_dir, corpus=corpus())), "letter", "n"), CORPORA, key="letter")


def letter_counts(terms):
    letters = terms.select("corpus", "n", F.explode(characters(F.col("term"))).alias("letter"))
    return letters.groupBy("corpus", "letter").agg(F.sum("n").alias("n"))


def _corpus_sql(counts: str, key: str, final: str) -> str:
    joins = " ".join(f"JOIN r AS {c} ON {c}.corpus = '{c}' AND {c}.symbol = a.symbol" for c in CORPORA[1:])
    columns = ", ".join(
        f'{c}.n AS "{c}Ocu", {c}.n / {c}.total AS "{c}Freq", {c}.rk AS "{c}Rank"' for c in CORPORA)
    total = " + ".join(f"{c}.rk" for c in CORPORA)
    return f"""WITH {counts}, r AS (
        SELECT corpus, symbol, n, sum(n) OVER (PARTITION BY corpus)::DOUBLE AS total,
               dense_rank() OVER (PARTITION BY corpus ORDER BY n DESC) AS rk FROM counts
    ), joined AS (
        SELECT a.symbol AS {key}, {columns}, ({total}) / 4.0E0 AS "avgRank"
        FROM r AS a {joins} WHERE a.corpus = 'a'
    ), done AS (SELECT *, dense_rank() OVER (ORDER BY "avgRank") AS rank FROM joined) {final}"""


_TERM_COUNTS = TOKENS + """, counts AS (
    SELECT corpus, term AS symbol, count(*)::BIGINT AS n FROM tokens GROUP BY corpus, term)"""
_LETTER_COUNTS = TOKENS + """, counts AS (
    SELECT corpus, symbol, count(*)::BIGINT AS n
    FROM (SELECT corpus, unnest(string_split(term, '')) AS symbol FROM tokens) GROUP BY corpus, symbol)"""


def top_ranks(spark, sf_dir):
    """The report of the first 50 rows in rank order."""
    return preview(order_by_rank(corpus_ranks(spark, sf_dir), "rank", "term"), 50).select("term", "avgRank", "rank")


def with_shares(counts, media):
    """Counts in several media with the share of each medium and the mean share; a medium without words gives null shares.

    The totals are one row, joined by a constant.
    """
    counts = materialize(counts, "media").withColumn("_one", F.lit(1))
    totals = counts.groupBy("_one").agg(*[F.sum(f"{m}Ocurrences").cast("double").alias(f"_{m}") for m in media])
    shares = counts.join(F.broadcast(totals), "_one").withColumns({f"{m}Relative": F.try_divide(f"{m}Ocurrences", f"_{m}") for m in media})
    total = F.col(f"{media[0]}Relative")
    for m in media[1:]:
        total = total + F.col(f"{m}Relative")
    return shares.withColumn("averageRelative", total / F.lit(float(len(media)))).drop("_one", *[f"_{m}" for m in media])


def _media_words(spark, sf_dir):
    """Each part is a word; quantities by return flag are its counts in three media."""
    media = {"internet": "A", "novel": "N", "subtitles": "R"}
    sums = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(*[
        F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0)).cast("long").alias(f"{medium}Ocurrences")
        for medium, flag in media.items()])
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("word"))
    return with_shares(sums, list(media)).join(parts, "l_partkey").drop("l_partkey")


def word_ranks(spark, sf_dir):
    words = dense_ranks(materialize(_media_words(spark, sf_dir), "words"), WORD_RANKS, written=True)
    totals = word_totals(words, ["internetOcurrences", "novelOcurrences", "subtitlesOcurrences"])
    return more_than(totals, "totalOcurrences", 500)


_WORD_SQL = """WITH sums AS (
    SELECT l_partkey,
        sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END)::BIGINT AS i,
        sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END)::BIGINT AS v,
        sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)::BIGINT AS s
    FROM lineitem GROUP BY l_partkey
), shares AS (
    SELECT *, i / sum(i) OVER ()::DOUBLE AS ir, v / sum(v) OVER ()::DOUBLE AS vr, s / sum(s) OVER ()::DOUBLE AS sr FROM sums
), words AS (
    SELECT p_name || ' ' || p_partkey AS word, *, (ir + vr + sr) / 3.0E0 AS ar
    FROM shares JOIN part ON p_partkey = l_partkey
), ranked AS (
    SELECT word, i AS "internetOcurrences", v AS "novelOcurrences", s AS "subtitlesOcurrences",
        ir AS "internetRelative", vr AS "novelRelative", sr AS "subtitlesRelative", ar AS "averageRelative",
        dense_rank() OVER (ORDER BY ir DESC) AS "internetRank", dense_rank() OVER (ORDER BY vr DESC) AS "novelsRank",
        dense_rank() OVER (ORDER BY sr DESC) AS "subtitlesRank", dense_rank() OVER (ORDER BY ar DESC) AS rank,
        i + v + s AS "totalOcurrences"
    FROM words
) SELECT * FROM ranked WHERE "totalOcurrences" > 500"""


def full_rank(spark, sf_dir):
    """A rank with almost as many values as rows, by ranges even at a small scale."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return dense_ranks(lines, {"price_rank": "l_extendedprice"}, window_rows=10_000)


QUERIES = {
    "corpus_ranks": Query(corpus_ranks, _corpus_sql(_TERM_COUNTS, "term", "SELECT * FROM done")),
    "symbol_ranks": Query(symbol_ranks, _corpus_sql(_LETTER_COUNTS, "letter", "SELECT * FROM done")),
    "top_ranks": Query(top_ranks, _corpus_sql(
        _TERM_COUNTS, "term", 'SELECT term, "avgRank", rank FROM done ORDER BY rank, term LIMIT 50')),
    "word_ranks": Query(word_ranks, _WORD_SQL),
    "full_rank": Query(full_rank, """SELECT l_orderkey, l_linenumber, l_extendedprice,
        dense_rank() OVER (ORDER BY l_extendedprice DESC) AS price_rank FROM lineitem"""),
}
