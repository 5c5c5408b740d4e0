"""Readings of a symbol: inferred from words, listed in dictionaries, and both combined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.kana import clean_readings, reading_list, transliteration
from lexforge.operators.nesting import nest

KUN, ON = "ja_kun", "ja_on"  # fixed values: entry types of the dictionary
READINGS = """array<struct<reading:struct<original:string,hiragana:string,katakana:string,romaji:string>,
    frequency:bigint>>"""


def reading_sums(vocabulary: DataFrame, pairs: str = "furigana", occurrences: str = "totalOcurrences") -> DataFrame:
    """(k, reading, Occ): how often each symbol is read in each way; words without symbols add nothing."""
    pair = F.col("_pair")
    known = pair["kanji"].isNotNull() & pair["reading"].isNotNull()
    return (
        vocabulary.select(F.explode(pairs).alias("_pair"), F.col(occurrences).alias("_n"))
        .groupBy(F.when(known, pair["kanji"]).otherwise("").alias("k"), pair["reading"].alias("reading"))
        .agg(F.sum("_n").alias("Occ"))
    )


def infer_readings(sums: DataFrame, part_rows: int | None = None) -> DataFrame:
    """(k, part, readingsWFreq): the sums of each symbol as one list."""
    furigana = F.struct(F.col("k").alias("kanji"), F.col("reading"))
    return nest(sums, "k", F.struct(furigana.alias("furigana"), "Occ"), "readingsWFreq", part_rows=part_rows)


def dictionary_readings(levels: DataFrame, kanjidic: DataFrame, kanji_alive: DataFrame, tanos: DataFrame,
                        use_tanos: bool = False) -> DataFrame:
    """(readingsKanji, readings, kunYomiRaw, onYomiRaw) for every symbol of the hub.

    The third source is taken into account only with ``use_tanos``; otherwise the second one's list
    stands in for it.
    """
    joined = (
        levels.select("kanji")
        .join(kanjidic.select("literal", "kdReadings"), F.col("kanji") == F.col("literal"), "left")
        .join(kanji_alive.select("kaKanji", "kaKunYomi_ja", "kaOnYomi_ja"), F.col("kanji") == F.col("kaKanji"), "left")
        .join(tanos.select("tanosKanji", "tanosKunyomi", "tanosOnyomi"), F.col("kanji") == F.col("tanosKanji"), "left")
    )
    lists = joined.select(
        F.col("kanji").alias("readingsKanji"),
        reading_list(F.col("kaKunYomi_ja"), F.col("kdReadings"), KUN,
                     F.col("tanosKunyomi") if use_tanos else None).alias("_kun"),
        reading_list(F.col("kaOnYomi_ja"), F.col("kdReadings"), ON,
                     F.col("tanosOnyomi") if use_tanos else None).alias("_on"),
    )
    return lists.select(
        "readingsKanji",
        clean_readings(F.col("_kun"), F.col("_on")).alias("readings"),
        F.transform("_kun", transliteration).alias("kunYomiRaw"),
        F.transform("_on", transliteration).alias("onYomiRaw"),
    )


def _kept(kind: str) -> Column:
    own = F.when(F.col("_kind") == kind, F.struct("_pos", F.struct("reading", "frequency").alias("_item")))
    ordered = F.sort_array(F.collect_set(own))
    return F.array_distinct(F.transform(ordered, lambda x: x["_item"]))


def combine_readings(dictionary: DataFrame, sums: DataFrame) -> DataFrame:
    """(readingsKanji, readings, kunYomi, onYomi): dictionary readings that occur in words, with their counts.

    Each listed reading is looked up by (symbol, hiragana); the lists come back in their own order.
    """
    kinds = F.array(
        F.struct(F.lit("kun").alias("kind"), F.col("kunYomiRaw").alias("items")),
        F.struct(F.lit("on").alias("kind"), F.col("onYomiRaw").alias("items")),
    )
    listed = (
        dictionary.select("readingsKanji", F.explode(kinds).alias("_k"))
        .select("readingsKanji", F.col("_k.kind").alias("_kind"), F.posexplode("_k.items").alias("_pos", "_listed"))
    )
    counted = sums.select(F.col("k").alias("_symbol"), F.col("reading").alias("_spoken"), F.col("Occ").alias("frequency"))
    found = listed.join(
        counted,
        (listed["readingsKanji"] == counted["_symbol"]) & (F.col("_listed.hiragana") == counted["_spoken"]),
        "inner",
    ).withColumn("reading", F.col("_listed"))
    # a symbol has no more items here than its dictionary lists hold; copies of a symbol fall together
    nested = found.groupBy(F.col("readingsKanji").alias("_symbol")).agg(
        _kept("kun").alias("kunYomi"), _kept("on").alias("onYomi")
    )
    return dictionary.join(nested, dictionary["readingsKanji"] == nested["_symbol"], "left").select(
        "readingsKanji", "readings",
        *[F.coalesce(F.col(c), F.array()).cast(READINGS).alias(c) for c in ("kunYomi", "onYomi")],
    )


def reading_candidates(dictionary: DataFrame) -> DataFrame:
    """(symbol, readings) for the alignment of words."""
    return dictionary.select(F.col("readingsKanji").alias("symbol"), "readings")
