"""Words under their symbols and symbols under their words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.symbols import KANJI, distinct_symbols, has_symbol
from lexforge.operators.joins import lookup_join
from lexforge.operators.nesting import nest, symbols_of, whole_row


def words_per_symbol(vocabulary: DataFrame, word: str = "word", columns: Sequence[str] | None = None,
                     order: Sequence[str] = ("rank", "word"), symbol: str = KANJI,
                     part_rows: int | None = None) -> DataFrame:
    """(vocabK, part, vocabsPerKanji): the word rows of every symbol, whole or narrowed to ``columns``.

    A common symbol occurs in a large share of all words; its list continues over several parts.
    """
    needed = list(dict.fromkeys([word, *(columns or vocabulary.columns), *order]))
    exploded = symbols_of(vocabulary.select(*needed), word, "vocabK", symbol)
    return nest(exploded, "vocabK", whole_row(vocabulary, columns), "vocabsPerKanji",
                [F.col(o) for o in order], part_rows)


def symbols_with_words(symbols: DataFrame, per_symbol: DataFrame, key: str = "kanji") -> DataFrame:
    """The symbol table with its words; a symbol without words has a null list in part 0."""
    lists = per_symbol.withColumnRenamed("vocabK", key)
    columns = [*symbols.columns, "part", "vocabsPerKanji"]
    # the parts of a hot symbol must not meet in one task, so they are the big side of the join
    found = lookup_join(lists, symbols, [key], "inner")
    missing = symbols.join(lists.select(key).distinct(), key, "left_anti")
    empty = F.lit(None).cast(per_symbol.schema["vocabsPerKanji"].dataType)
    return found.select(*columns).unionByName(
        missing.select("*", F.lit(0).alias("part"), empty.alias("vocabsPerKanji"))
    )


def symbols_per_word(vocabulary: DataFrame, symbols: DataFrame, word: str = "word", key: str = "kanji",
                     columns: Sequence[str] | None = None, symbol: str = KANJI) -> DataFrame:
    """(wordK, kanjisInVocab): the symbol rows of every word, in the order of the word.

    Words are taken once each. Symbols without a row are skipped. ``symbols`` holds one row per symbol.
    """
    text = F.col(word)
    pairs = (
        vocabulary.select(word).distinct().filter(has_symbol(text, symbol))
        .select(text.alias("wordK"), F.posexplode(distinct_symbols(text, symbol)).alias("_pos", "_symbol"))
    )
    rows = symbols.select(F.col(key).alias("_symbol"), whole_row(symbols, columns).alias("_row"))
    found = lookup_join(pairs, rows, ["_symbol"])
    # a word has as many rows here as it has distinct symbols
    present = F.when(F.col("_row").isNotNull(), F.struct("_pos", "_row"))
    nested = found.groupBy("wordK").agg(F.collect_list(present).alias("_rows"))
    return nested.select("wordK", F.transform(F.sort_array("_rows"), lambda x: x["_row"]).alias("kanjisInVocab"))


def words_with_symbols(vocabulary: DataFrame, per_word: DataFrame, word: str = "word",
                       keep_unmatched: bool = False) -> DataFrame:
    """The word table with its symbols; words without any are lost unless ``keep_unmatched``."""
    how = "left" if keep_unmatched else "inner"
    return vocabulary.join(per_word, vocabulary[word] == per_word["wordK"], how).drop("wordK")
