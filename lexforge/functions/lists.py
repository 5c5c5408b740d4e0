"""Arrays of strings and of structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions.symbols import strip

MEANING = "struct<lang:string,meaning:string>"
MEANINGS = f"array<{MEANING}>"


def no_strings() -> Column:
    return F.array().cast("array<string>")


def ordered_union(*arrays: Column) -> Column:
    """Union of arrays that keeps the first occurrence of each item; a null array counts as empty."""
    return F.array_distinct(F.flatten(F.array(*[F.coalesce(a, F.array()) for a in arrays])))


def gloss_list(text: Column, lang: str = "en") -> Column:
    """``"day, sun"`` -> [(en, day), (en, sun)]; null -> empty."""
    return F.coalesce(
        F.transform(
            F.split(strip(text), ", "),
            lambda t: F.struct(F.lit(lang).alias("lang"), t.alias("meaning")),
        ),
        F.array(),
    ).cast(MEANINGS)


def normalised_meanings(items: Column, lang: str = "lang", meaning: str = "meaning") -> Column:
    """Rename the fields to (lang, meaning); an item with a null part becomes a pair of empty strings."""

    def clean(x: Column) -> Column:
        known = x[lang].isNotNull() & x[meaning].isNotNull()
        return F.struct(
            F.when(known, x[lang]).otherwise("").alias("lang"),
            F.when(known, x[meaning]).otherwise("").alias("meaning"),
        )

    return F.coalesce(F.transform(items, clean), F.array()).cast(MEANINGS)


def english_meanings(items: Column, lang: str = "en", separator: str = ", ") -> Column:
    """Distinct meanings of one language, joined; null -> empty string."""
    chosen = F.transform(F.filter(items, lambda m: m["lang"] == lang), lambda m: m["meaning"])
    return F.coalesce(F.array_join(F.array_distinct(chosen), separator), F.lit(""))


def joined_field(items: Column, *path: str, separator: str = ", ") -> Column:
    """Join one (nested) field of an array of structs; null -> empty string."""

    def pick(x: Column) -> Column:
        for name in path:
            x = x[name]
        return x

    return F.coalesce(F.array_join(F.transform(items, pick), separator), F.lit(""))


def bracket_pairs(text: Column) -> Column:
    """``[[en,file], [en,russian]]`` -> array of (language, word)."""
    pairs = F.regexp_extract_all(text, F.lit(r"\[([^\[\],]*,[^\[\]]*)\]"), 1)

    def pair(p: Column) -> Column:
        fields = F.split(p, ",")
        return F.struct(F.get(fields, F.lit(0)).alias("language"), F.get(fields, F.lit(1)).alias("word"))

    return F.transform(pairs, pair)


def example_pairs(text: Column) -> Column:
    """JSON list of [sentence, translation] lists held in a string."""
    return F.from_json(text, "array<array<string>>")


def greedy_summary(items: Column, limit: int = 30) -> Column:
    """Append items while the text stays within ``limit``; the first is always taken.

    The separator before an item belongs to the text so far, so it counts on the next step; a short
    item may still fit after a longer one was skipped. Double quotes become single quotes.
    """

    def step(text: Column, item: Column) -> Column:
        fits = (text == "") | (F.char_length(F.concat(text, item)) <= limit)
        return F.when(fits, F.concat(text, F.lit(", "), item)).otherwise(text)

    text = F.aggregate(F.filter(items, lambda i: i.isNotNull()), F.lit(""), step)
    text = F.regexp_replace(F.translate(text, '"', "'"), "^, ", "")
    return F.coalesce(text, F.lit(""))
