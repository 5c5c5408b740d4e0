"""Shared inputs: tables and the term counts of the documents, in both languages."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions.symbols import terms
from lexforge.operators.layout import widen


# a list that holds more items continues on further rows; the queries name the bound, so that their SQL can
PART_ROWS = 50_000


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Four corpora that hold every document between them: five sources each.
CORPORA = ["a", "b", "c", "d"]


def corpus() -> Column:
    number = F.substring("source", 4, 9).try_cast("int")
    return F.when(number < 5, "a").when(number < 10, "b").when(number < 15, "c").otherwise("d")


def term_counts(spark: SparkSession, sf_dir: str, **by: Column) -> DataFrame:
    """(by..., term, n) over the whole texts of all documents."""
    columns = [c.alias(name) for name, c in by.items()]
    documents = widen(table(spark, sf_dir, "documents").select(*columns, "text"))
    exploded = documents.select(*by, F.explode(terms(F.col("text"))).alias("term"))
    return exploded.groupBy(*by, "term").agg(F.count("*").alias("n"))


TOKENS = r"""tokens AS (
    SELECT * FROM (SELECT lang, CASE WHEN TRY_CAST(substr(source, 4) AS INT) < 5 THEN 'a'
        WHEN TRY_CAST(substr(source, 4) AS INT) < 10 THEN 'b' WHEN TRY_CAST(substr(source, 4) AS INT) < 15 THEN 'c' ELSE 'd' END AS corpus,
        unnest(string_split_regex(lower(text), '\P{L}+')) AS term FROM documents)
    WHERE term <> '')"""
TERMS = TOKENS + """, terms AS (SELECT term, count(*) AS n FROM tokens GROUP BY term)"""
# one row per term and distinct letter, with the place where the letter occurs first
LETTERS = TERMS + """, spots AS (
    SELECT term, n, unnest(string_split(term, '')) AS letter, generate_subscripts(string_split(term, ''), 1) AS pos
    FROM terms), letters AS (SELECT term, n, letter, min(pos) AS pos FROM spots GROUP BY term, n, letter)"""
