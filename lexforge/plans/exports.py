"""Summaries and key-value entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.entries import entry_line
from lexforge.functions.lists import english_meanings, greedy_summary, joined_field
from lexforge.operators.layout import more_than
from lexforge.operators.nesting import whole_row

# Thresholds of the word exports and prefixes of the keys.
COMMON_WORD, SUMMARY_WORD = 1_000, 4_000
WORD_PREFIX, SYMBOL_PREFIX = "wrd-", "knj-"


def summarize_words(vocabulary: DataFrame, above: int = SUMMARY_WORD, limit: int = 30) -> DataFrame:
    """(w, m): the words above a number of occurrences and as many translations as fit."""
    common = more_than(vocabulary, "totalOcurrences", above)
    return common.select(F.col("word").alias("w"), greedy_summary(F.col("translations"), limit).alias("m"))


def summarize_symbols(symbols: DataFrame) -> DataFrame:
    return symbols.select(
        "kanji",
        english_meanings(F.col("meanings")).alias("meanings"),
        joined_field(F.col("kunYomi"), "reading", "romaji").alias("romajiKun"),
        joined_field(F.col("onYomi"), "reading", "romaji").alias("romajiOn"),
        joined_field(F.col("kunYomi"), "reading", "hiragana").alias("hiraganaKun"),
        joined_field(F.col("onYomi"), "reading", "hiragana").alias("hiraganaOn"),
    )


def key_value_entries(df: DataFrame, key: str, prefix: str = "", part: str = "part") -> DataFrame:
    """(entry): one put request per row, with the whole row as JSON payload; null fields are left out.

    Hash key and sort key are the prefixed key. A further part of a long list has its number in the
    sort key, since an entry must have a pair of keys of its own.
    """
    payload = F.to_json(whole_row(df.drop(part)))
    name = F.concat(F.lit(prefix), F.col(key).cast("string"))
    sort_key = name
    if part in df.columns:
        sort_key = F.when(F.col(part) > 0, F.concat(name, F.lit("#"), F.col(part))).otherwise(name)
    return df.select(entry_line(name, sort_key, payload).alias("entry"))


def word_entries(words: DataFrame) -> DataFrame:
    return key_value_entries(words, "word", WORD_PREFIX)


def symbol_entries(symbols: DataFrame) -> DataFrame:
    return key_value_entries(symbols, "kanji", SYMBOL_PREFIX)
