"""Meanings of a symbol from three dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.lists import gloss_list, normalised_meanings, ordered_union
from lexforge.operators.joins import full_join_on_any


def combine_meanings(kanjidic: DataFrame, kanji_alive: DataFrame, tanos: DataFrame,
                     strict_keys: bool = False) -> DataFrame:
    """(cmLiteral, meanings): the first dictionary's meanings, then the third's, then the second's.

    By default a symbol that only the smaller dictionaries know has one row under its own name.
    ``strict_keys`` joins each of them to the first alone, which leaves such rows apart and without a
    key.
    """
    first = kanjidic.select("literal", "kdMeanings")
    second = kanji_alive.select("kaKanji", "kaMeanings")
    third = tanos.select("tanosKanji", "tanosMeaning")
    if strict_keys:
        joined = first.join(second, first["literal"] == second["kaKanji"], "full")
        joined = joined.join(third, joined["literal"] == third["tanosKanji"], "full")
        joined = joined.withColumnRenamed("literal", "cmLiteral")
    else:
        joined = full_join_on_any([(first, "literal"), (second, "kaKanji"), (third, "tanosKanji")], "cmLiteral")
    meanings = ordered_union(
        normalised_meanings(F.col("kdMeanings"), "m_lang"),
        gloss_list(F.col("tanosMeaning")),
        gloss_list(F.col("kaMeanings")),
    )
    return joined.select("cmLiteral", meanings.alias("meanings"))
