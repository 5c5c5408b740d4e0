"""Symbol classes: which characters of a word count as symbols."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two ideograph blocks that count as kanji.
KANJI = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]"
# For text in alphabetic scripts: one letter.
LETTER = r"\p{L}"

# Characters that a trim removes: the control characters and the plain space.
BLANKS = "".join(map(chr, range(0x21)))


def strip(text: Column) -> Column:
    """Trim blanks and control characters; the built-in ``trim`` removes plain spaces only."""
    return F.btrim(text, F.lit(BLANKS))


def has_symbol(text: Column, symbol: str = KANJI) -> Column:
    return text.rlike(symbol)


def is_symbol(char: Column, symbol: str = KANJI) -> Column:
    return char.rlike(f"^{symbol}$")


def distinct_symbols(text: Column, symbol: str = KANJI) -> Column:
    """The symbols of a word, each once, in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(symbol), 0))


def characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), 0)


def terms(text: Column) -> Column:
    """Lower-case letter runs of a running text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)
