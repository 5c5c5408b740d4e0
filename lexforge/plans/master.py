"""The symbol table: one row per symbol of the hub."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.operators.joins import Dimension, star_join
from lexforge.operators.layout import keep
from lexforge.sources.schemas import SYMBOL_MASTER


def symbol_master(levels: DataFrame, kanjidic: DataFrame, kanji_alive: DataFrame, decompositions: DataFrame,
                  frequencies: DataFrame, meanings: DataFrame, sums: DataFrame, readings: DataFrame,
                  keep_unread: bool = False) -> DataFrame:
    """Assemble the hub with its dimensions; the declared columns come out in their order.

    A symbol that no word is read with is dropped unless ``keep_unread``. The component lists and the
    third dictionary add no column to the output and are not joined. Sort with ``order_by_rank``
    where the table is written.
    """
    dims = [
        Dimension(kanjidic, "literal", columns=["grade", "stroke_count", "variant"]),
        Dimension(kanji_alive, "kaKanji", columns=[
            "examples", "kname", "rad_meaning", "rad_name", "rad_name_ja", "rad_order", "rad_position",
            "rad_position_ja", "rad_stroke", "radical"]),
        Dimension(decompositions, "cKanji", columns=["components"]),
        Dimension(frequencies, "freqKanji"),
        Dimension(meanings, "cmLiteral", columns=["meanings"]),
        Dimension(readings, "readingsKanji", columns=["kunYomi", "onYomi"]),
    ]
    if not keep_unread:
        levels = levels.join(sums.select(F.col("k").alias("kanji")).distinct(), "kanji", "left_semi")
    return keep(star_join(levels, "kanji", dims), SYMBOL_MASTER)
