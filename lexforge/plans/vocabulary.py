"""The word table: ranks, totals, scripts, readings per symbol, base forms, translations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.kana import scripts, to_hiragana
from lexforge.functions.symbols import KANJI, has_symbol
from lexforge.operators.cascade import cascade_join
from lexforge.operators.joins import lookup_join
from lexforge.operators.layout import keep
from lexforge.operators.materialize import materialize
from lexforge.operators.nesting import first_by, merged_lists
from lexforge.operators.ranking import dense_ranks
from lexforge.plans.alignment import align_readings
from lexforge.plans.inflection import deinflect
from lexforge.plans.sounds import SoundChange, align_by_cost
from lexforge.sources.schemas import WORD_COUNTS, WORD_MASTER

WORD_RANKS = {
    "internetRank": "internetRelative", "novelsRank": "novelRelative",
    "subtitlesRank": "subtitlesRelative", "rank": "averageRelative",
}


def compile_dictionary(entries: DataFrame, place: str, merge: bool = False) -> DataFrame:
    """One row per headword: the first entry by ``place``, or all glosses merged in that order.

    Merged glosses that are too many for one row continue on further rows, numbered by ``part``.
    """
    if not merge:
        return first_by(entries, "edictWord", F.col(place)).drop(place)
    glosses = merged_lists(entries, "edictWord", "translations", F.col(place))
    readings = first_by(entries.select("edictWord", "reading", place), "edictWord", F.col(place)).drop(place)
    return lookup_join(glosses, readings, ["edictWord"])


def word_totals(words: DataFrame, counts: list[str], out: str = "totalOcurrences") -> DataFrame:
    total = F.lit(0).cast("bigint")
    for c in counts:
        total = total + F.col(c).cast("bigint")
    return words.withColumn(out, total)


def with_base_forms(words: DataFrame, lemmas: DataFrame | None, word: str = "word") -> DataFrame:
    """The lemma of each word from a (surface, lemma) table; else the word itself. Of several lemmas the first by name counts."""
    if lemmas is None:
        return words.withColumn("baseForm", F.col(word))
    table = lemmas.groupBy(F.col("surface").alias("_surface")).agg(F.min("lemma").alias("_lemma"))
    joined = words.join(table, words[word] == table["_surface"], "left")
    return joined.withColumn("baseForm", F.coalesce("_lemma", word)).drop("_surface", "_lemma")


def with_scripts(words: DataFrame, reading: str, word: str = "word", symbol: str = KANJI) -> DataFrame:
    """Spell each word in the three scripts by its dictionary reading.

    A word without symbols is its own reading; one that has symbols and no reading gets null.
    """
    spoken = F.when(has_symbol(F.col(word), symbol), F.col(reading)).otherwise(F.col(word))
    return words.withColumn(
        "transliterations", F.when(spoken.isNotNull(), scripts(F.col(word), spoken))
    )


def compile_vocabulary(words: DataFrame, dictionary: DataFrame, candidates: DataFrame,
                       lemmas: DataFrame | None = None, symbol: str = KANJI, changes: Sequence[SoundChange] | None = None,
                       endings: Sequence[tuple[str, str]] | None = None, second_chance: bool = False) -> DataFrame:
    """Compile the word table.

    With ``changes``, readings are split over symbols by the cheapest sound changes. With ``endings`` and without lemmas, base forms are found by rewriting endings until the
    dictionary knows the form. With ``second_chance``, words that the dictionary doesn't hold get the entry of their base form.

    ``words`` holds one row per word with numeric counts and shares, ``dictionary`` one row per
    headword, ``candidates`` the possible readings per symbol as (symbol, readings). All three are read
    more than once and should be written tables. The result is not sorted; sort it where it is
    written.
    """
    ranked = dense_ranks(words, WORD_RANKS, written=True)
    totals = word_totals(ranked, WORD_COUNTS)
    if lemmas is None and endings is not None:
        lemmas = materialize(deinflect(words, "word", dictionary, "edictWord", endings).select(F.col("word").alias("surface"), F.col("baseForm").alias("lemma")), "lemmas")
    if second_chance:
        based = cascade_join(with_base_forms(totals, lemmas), dictionary, ["word", "baseForm"], "edictWord").withColumn("_own", F.col("hit") == 0)
    else:
        looked_up = totals.join(dictionary, totals["word"] == dictionary["edictWord"], "left").drop("edictWord")
        based = with_base_forms(looked_up, lemmas)
    # the reading of a base form is not the word's
    own = F.when(F.col("_own"), F.col("reading")) if second_chance else F.col("reading")
    spelled = with_scripts(based.withColumn("reading", own), "reading", symbol=symbol)
    # from the words again, not from the ranked table, whose joins would run twice
    known = dictionary.filter(F.col("reading").isNotNull()).select("edictWord", to_hiragana(F.col("reading")).alias("spoken"))
    spoken = words.select("word").join(known, F.col("word") == F.col("edictWord")).drop("edictWord")
    if changes is None:
        aligned = align_readings(spoken, candidates, "word", "spoken", symbol=symbol)
    else:
        aligned = align_by_cost(spoken, candidates, "word", "spoken", changes, symbol=symbol)
    renamed = aligned.select(F.col("word").alias("_w"), "furigana")
    joined = spelled.join(renamed, spelled["word"] == renamed["_w"], "left").withColumn(
        "furigana", F.coalesce("furigana", F.array().cast("array<struct<kanji:string,reading:string>>"))
    )
    return keep(joined, WORD_MASTER)
