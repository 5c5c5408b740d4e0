"""Which part of a word's reading belongs to which of its symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.kana import to_hiragana
from lexforge.functions.lists import no_strings
from lexforge.functions.symbols import KANJI, characters, distinct_symbols, has_symbol, is_symbol
from lexforge.operators.joins import lookup_join

_PATHS = "array<struct<used:int,path:array<string>>>"


def _split_reading(choices: Column, reading: Column) -> Column:
    """The smallest way to write ``reading`` as one choice per position, or null.

    Ways that have used up the same length are interchangeable for what follows, so only the smallest
    of them is kept: there are never more of them than characters in the reading.
    """

    def extend(states: Column, options: Column) -> Column:
        def grow(state: Column) -> Column:
            fitting = F.filter(
                options,
                lambda c: (c != "") & (F.substr(reading, state["used"] + 1, F.char_length(c)) == c),
            )
            return F.transform(
                fitting,
                lambda c: F.struct(
                    (state["used"] + F.char_length(c)).alias("used"),
                    F.concat(state["path"], F.array(c)).alias("path"),
                ),
            )

        grown = F.array(F.sort_array(F.flatten(F.transform(states, grow))))
        # the list stands in an array of one, so that it is computed once and named in the lambda
        return F.transform(
            grown,
            lambda s: F.filter(s, lambda x, i: (i == 0) | (x["used"] != F.get(s, i - 1)["used"])),
        )[0].cast(_PATHS)

    start = F.array(F.struct(F.lit(0).alias("used"), no_strings().alias("path"))).cast(_PATHS)
    ends = F.filter(F.aggregate(choices, start, extend), lambda s: s["used"] == F.char_length(reading))
    return F.get(ends, F.lit(0))["path"]


def _middle(word: Column, reading: Column, symbol: str) -> Column:
    """The reading without the plain characters that lead and end the word."""
    last = F.reverse(characters(word))
    head = to_hiragana(F.regexp_extract(word, f"^((?:(?!{symbol}).)*)", 1))
    tail_size = F.coalesce(F.array_position(F.transform(last, lambda c: is_symbol(c, symbol)), F.lit(True)) - 1, F.lit(0))
    tail = to_hiragana(F.array_join(F.reverse(F.slice(last, F.lit(1), tail_size.cast("int"))), ""))
    inner = F.char_length(reading) - F.char_length(head) - F.char_length(tail)
    fits = (inner > 0) & F.startswith(reading, head) & F.endswith(reading, tail)
    return F.when(fits, F.substr(reading, F.char_length(head) + 1, inner)).otherwise(reading)


def first_takes_all(chars: Column, known: Column, word: Column, reading: Column, symbol: str) -> Column:
    """A reading per character: the first symbol has all that the plain characters at both ends leave, the others nothing."""
    first = F.array_position(F.transform(chars, lambda c: F.map_contains_key(known, c)), F.lit(True)).cast("int")
    blank = F.lit("")
    return F.concat(F.array_repeat(blank, first - 1), F.array(_middle(word, reading, symbol)), F.array_repeat(blank, F.size(chars) - first))


def align_readings(words: DataFrame, candidates: DataFrame, word: str, reading: str, out: str = "furigana",
                   symbol: str = KANJI) -> DataFrame:
    """(word, furigana) for the words that hold symbols; furigana is an array of (kanji, reading).

    ``candidates`` holds (symbol, readings). Plain characters stand for themselves. Where no choice of
    candidates spells the reading, the first symbol takes all that the plain characters at both ends
    leave, and the others an empty reading. ``words`` holds one row per word.
    """
    spelled = words.select(word, reading).filter(has_symbol(F.col(word), symbol))
    pairs = spelled.withColumn("symbol", F.explode(distinct_symbols(F.col(word), symbol)))
    found = lookup_join(pairs, candidates.select("symbol", "readings"), ["symbol"])
    # a word has as many rows here as it has distinct symbols; copies of a word fall together
    known = found.groupBy(word).agg(
        F.min(reading).alias(reading),
        F.map_from_entries(F.collect_set(F.struct("symbol", F.coalesce("readings", no_strings())))).alias("_known")
    )
    # the map holds every symbol of the word, so a character that is not in it stands for itself
    choices = F.transform(
        "_chars", lambda c: F.coalesce(F.try_element_at(F.col("_known"), c), F.array(to_hiragana(c))))
    split = known.withColumn("_chars", characters(F.col(word))).withColumn("_path", _split_reading(choices, F.col(reading)))
    path = F.coalesce(F.col("_path"), first_takes_all(F.col("_chars"), F.col("_known"), F.col(word), F.col(reading), symbol))
    paired = F.filter(
        F.transform(
            F.arrays_zip(F.col("_chars").alias("kanji"), path.alias("reading")),
            lambda p: F.struct(p["kanji"].alias("kanji"), p["reading"].alias("reading")),
        ),
        lambda p: F.map_contains_key("_known", p["kanji"]),
    )
    return split.select(word, paired.alias(out))
