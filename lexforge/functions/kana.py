"""Kana scripts: conversion between them, Latin spelling, and lists of readings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions.lists import no_strings
from lexforge.functions.symbols import strip

# The two scripts are aligned blocks: U+3041..3096 and U+30A1..30F6.
HIRAGANA = "".join(map(chr, range(0x3041, 0x3097)))
KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))

# Hepburn spelling, one row of the syllabary per line, in natural order.
ROWS = {
    "あいうえお": "a i u e o",
    "かきくけこ": "ka ki ku ke ko",
    "さしすせそ": "sa shi su se so",
    "たちつてと": "ta chi tsu te to",
    "なにぬねの": "na ni nu ne no",
    "はひふへほ": "ha hi fu he ho",
    "まみむめも": "ma mi mu me mo",
    "やゆよ": "ya yu yo",
    "らりるれろ": "ra ri ru re ro",
    "わゐゑを": "wa wi we wo",
    "がぎぐげご": "ga gi gu ge go",
    "ざじずぜぞ": "za ji zu ze zo",
    "だぢづでど": "da ji zu de do",
    "ばびぶべぼ": "ba bi bu be bo",
    "ぱぴぷぺぽ": "pa pi pu pe po",
    "ぁぃぅぇぉ": "a i u e o",
    "ゃゅょゎ": "ya yu yo wa",
    "んゔゕゖ": "n vu ka ke",
}
# Syllables of loan words: a kana and a small vowel or y syllable.
LOANS = {
    "いぇ": "ye", "うぃ": "wi", "うぇ": "we", "うぉ": "wo", "ゔぁ": "va", "ゔぃ": "vi", "ゔぇ": "ve", "ゔぉ": "vo", "ゔゅ": "vyu",
    "くぁ": "kwa", "くぃ": "kwi", "くぇ": "kwe", "くぉ": "kwo", "ぐぁ": "gwa", "しぇ": "she", "じぇ": "je", "ちぇ": "che",
    "つぁ": "tsa", "つぃ": "tsi", "つぇ": "tse", "つぉ": "tso", "てぃ": "ti", "でぃ": "di", "てゅ": "tyu", "でゅ": "dyu",
    "とぅ": "tu", "どぅ": "du", "ふぁ": "fa", "ふぃ": "fi", "ふぇ": "fe", "ふぉ": "fo", "ふゅ": "fyu",
}
# Syllables of the i column that join with a small y syllable.
GLIDES = {"き": "ky", "し": "sh", "ち": "ch", "に": "ny", "ひ": "hy", "み": "my", "り": "ry",
          "ぎ": "gy", "じ": "j", "ぢ": "j", "び": "by", "ぴ": "py"}
SMALL_Y = {"ゃ": "a", "ゅ": "u", "ょ": "o"}


def _syllables() -> dict[str, str]:
    single = {k: r for kana, latin in ROWS.items() for k, r in zip(kana, latin.split())}
    joined = {k + y: g + v for k, g in GLIDES.items() for y, v in SMALL_Y.items()}
    return single | joined | LOANS


SYLLABLES = _syllables()


def to_hiragana(text: Column) -> Column:
    return F.translate(text, KATAKANA, HIRAGANA)


def to_katakana(text: Column) -> Column:
    return F.translate(text, HIRAGANA, KATAKANA)


def to_romaji(text: Column) -> Column:
    """Hepburn with long vowels spelled out.

    A small tsu doubles the next consonant, as t before ch; one that no consonant follows is silent.
    """
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(SYLLABLES.items())])
    pairs = "|".join(k for k in SYLLABLES if len(k) == 2)
    tokens = F.regexp_extract_all(to_hiragana(text), F.lit(f"(?s)({pairs}|.)"), 1)
    latin = F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), t)), "")
    latin = F.regexp_replace(latin, "っ(?=ch)", "t")
    latin = F.regexp_replace(latin, "っ([bcdfghjkmnpqrstvwyz])", "$1$1")
    latin = F.replace(latin, F.lit("っ"), F.lit(""))
    return F.regexp_replace(latin, "([aiueo])ー", "$1$1")


def transliteration(text: Column) -> Column:
    return scripts(text, text)


def scripts(original: Column, reading: Column) -> Column:
    """A text with its reading in the three scripts."""
    return F.struct(
        original.alias("original"),
        to_hiragana(reading).alias("hiragana"),
        to_katakana(reading).alias("katakana"),
        to_romaji(reading).alias("romaji"),
    )


def _pieces(text: Column, separator: str) -> Column:
    """Split without the empty pieces at the end; an empty text is one empty piece."""
    body = F.rtrim(text, F.lit(separator))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(body == "", no_strings())
        .otherwise(F.split(body, separator))
    )


def _stem(reading: Column) -> Column:
    return F.split(reading, r"\.")[0]


def reading_list(listed: Column, entries: Column, kind: str, more: Column | None = None) -> Column:
    """Readings of one kind from the three dictionaries, in order, with repeats.

    ``listed`` is a list separated by the ideographic comma; ``entries`` an array of (type, value)
    whose values are cut at the first dot; ``more`` a list separated by spaces or commas, also cut.
    ``more`` defaults to ``listed``. Blank or null sources add nothing.
    """
    more = listed if more is None else more

    def unless_blank(text: Column, items: Column) -> Column:
        return F.when(F.coalesce(strip(text), F.lit("")) != "", items).otherwise(no_strings())

    from_list = unless_blank(listed, _pieces(listed, "、"))
    from_entries = F.transform(
        F.filter(entries, lambda r: (r["type"] == kind) & (r["value"] != "")),
        lambda r: _stem(r["value"]),
    )
    words = F.flatten(F.transform(_pieces(more, " "), lambda w: _pieces(w, "、")))
    from_more = unless_blank(more, F.transform(words, _stem))
    return F.concat(from_list, F.coalesce(from_entries, no_strings()), from_more)


def clean_readings(*lists: Column) -> Column:
    """All readings as distinct hiragana without affix marks."""
    return F.array_distinct(
        F.transform(F.concat(*lists), lambda r: F.replace(to_hiragana(r), F.lit("-"), F.lit("")))
    )
