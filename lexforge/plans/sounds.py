"""Readings with sound changes: the cheapest way to spell a word's reading by changed readings of its symbols.

Inside a compound a symbol's first sound may become voiced, its last one a doubled consonant, or its ending short. The changes are rules with costs. Every reading of a symbol
gives its variants, once for the symbol and not for each word that holds it, and a word's reading is a path through the lattice of its symbols' variants.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.kana import to_hiragana
from lexforge.functions.lists import no_strings
from lexforge.functions.symbols import KANJI, characters, distinct_symbols, has_symbol
from lexforge.operators.joins import lookup_join
from lexforge.plans.alignment import first_takes_all

FIRST, LAST = "first", "last"
VARIANTS = "array<struct<reading:string,cost:int,first:boolean,last:boolean>>"
_STATES = "array<struct<used:int,cost:int,path:array<string>>>"


class SoundChange(NamedTuple):
    """At a reading's first or last place, ``old`` may become ``new``. A first sound changes after another character only, a last one before another."""

    place: str
    old: str
    new: str
    cost: int


# The sounds that may change inside a compound.
VOICED = {"かきくけこさしすせそたちつてとはひふへほ": "がぎぐげござじずぜぞだぢづでどばびぶべぼ"}
HALF_VOICED = {"はひふへほ": "ぱぴぷぺぽ"}
DOUBLED = "つちくき"
SHORTENED = "うい"


def japanese_changes() -> list[SoundChange]:
    """Voiced and half-voiced first sounds, doubled consonants, and endings without their long vowel."""
    pairs = lambda rows: [(a, b) for old, new in rows.items() for a, b in zip(old, new)]
    return [*[SoundChange(FIRST, a, b, 1) for a, b in pairs(VOICED)], *[SoundChange(FIRST, a, b, 2) for a, b in pairs(HALF_VOICED)],
            *[SoundChange(LAST, c, "っ", 1) for c in DOUBLED], *[SoundChange(LAST, c, "", 2) for c in SHORTENED]]


def _variant(reading: Column, cost: Column, first: bool, last: bool) -> Column:
    return F.struct(reading.alias("reading"), cost.cast("int").alias("cost"), F.lit(first).alias("first"), F.lit(last).alias("last"))


def reading_variants(readings: Column, changes: Sequence[SoundChange]) -> Column:
    """The readings with at most one change at each end, as (reading, cost, first, last); first and last say where the symbol must not stand.

    Of several ways to one variant the cheapest counts.
    """
    whole = F.transform(F.filter(F.array_distinct(readings), lambda r: r != ""), lambda r: _variant(r, F.lit(0), False, False))

    def changed(variants: Column, place: str) -> Column:
        def by(rule: SoundChange, v: Column) -> Column:
            size = F.char_length(v["reading"])
            n = len(rule.old)
            if place == FIRST:
                return F.concat(F.lit(rule.new), F.substring(v["reading"], n + 1, size))
            return F.concat(F.substring(v["reading"], F.lit(1), size - n), F.lit(rule.new))

        def fits(rule: SoundChange, v: Column) -> Column:
            meets = F.startswith(v["reading"], F.lit(rule.old)) if place == FIRST else F.endswith(v["reading"], F.lit(rule.old))
            return F.coalesce(meets, F.lit(False)) & (by(rule, v) != "")

        def grown(rule: SoundChange) -> Column:
            return F.transform(F.filter(variants, lambda v: fits(rule, v)), lambda v: F.struct(
                by(rule, v).alias("reading"), (v["cost"] + rule.cost).cast("int").alias("cost"),
                (v["first"] | F.lit(place == FIRST)).alias("first"), (v["last"] | F.lit(place == LAST)).alias("last")))

        return F.concat(variants, *[grown(r) for r in changes if r.place == place])

    # the places first, so that the cheapest of equal variants comes first
    keyed = F.transform(changed(changed(whole, FIRST), LAST), lambda v: F.struct(
        v["reading"].alias("reading"), v["first"].alias("first"), v["last"].alias("last"), v["cost"].alias("cost")))
    ordered = F.array(F.sort_array(keyed))
    same = lambda a, b: (a["reading"] == b["reading"]) & (a["first"] == b["first"]) & (a["last"] == b["last"])
    kept = F.transform(ordered, lambda s: F.filter(s, lambda v, i: (i == 0) | ~same(v, F.get(s, i - 1))))[0]
    return F.coalesce(F.transform(kept, lambda v: F.struct(v["reading"], v["cost"], v["first"], v["last"])).cast(VARIANTS), F.array().cast(VARIANTS))


def cheapest_path(choices: Column, reading: Column, unknown: int, longest: int) -> Column:
    """(cost, path): the cheapest way to spell ``reading`` by one choice per place, of equals the smallest path, or null.

    ``choices`` is an array of (wild, variants) per place: at a wild one any 1 to ``longest`` characters may stand, for ``unknown`` and one for each of them. Of the
    ways that have used up the same length only the cheapest is kept, so there are never more of them than characters in the reading.
    """
    size = F.size(choices)
    total = F.char_length(reading)

    def extend(acc: Column, choice: Column) -> Column:
        at = acc["at"]

        def grow(state: Column) -> Column:
            rest = total - state["used"]
            fitting = F.filter(choice["variants"], lambda v: ~(v["first"] & (at == 0)) & ~(v["last"] & (at == size - 1))
                               & (F.substr(reading, state["used"] + 1, F.char_length(v["reading"])) == v["reading"]))
            known = F.transform(fitting, lambda v: F.struct(
                (state["used"] + F.char_length(v["reading"])).alias("used"), (state["cost"] + v["cost"]).alias("cost"),
                F.concat(state["path"], F.array(v["reading"])).alias("path")))
            sizes = F.when(choice["wild"] & (rest > 0), F.sequence(F.lit(1), F.least(F.lit(longest), rest))).otherwise(F.array().cast("array<int>"))
            guessed = F.transform(sizes, lambda n: F.struct(
                (state["used"] + n).alias("used"), (state["cost"] + unknown + n).alias("cost"),
                F.concat(state["path"], F.array(F.substr(reading, state["used"] + 1, n))).alias("path")))
            return F.concat(known.cast(_STATES), guessed.cast(_STATES))

        grown = F.array(F.sort_array(F.flatten(F.transform(acc["states"], grow))))
        kept = F.transform(grown, lambda s: F.filter(s, lambda x, i: (i == 0) | (x["used"] != F.get(s, i - 1)["used"])))[0]
        return F.struct((at + 1).alias("at"), kept.cast(_STATES).alias("states"))

    start = F.struct(F.lit(0).alias("at"), F.array(F.struct(F.lit(0).alias("used"), F.lit(0).alias("cost"), no_strings().alias("path"))).cast(_STATES).alias("states"))
    ends = F.reduce(choices, start, extend, lambda acc: F.filter(acc["states"], lambda s: s["used"] == total))
    return F.get(ends, F.lit(0))


def align_by_cost(words: DataFrame, candidates: DataFrame, word: str, reading: str, changes: Sequence[SoundChange] | None = None, out: str = "furigana",
                  symbol: str = KANJI, unknown: int = 10, longest: int = 4) -> DataFrame:
    """(word, furigana, cost) for the words that hold symbols; furigana is an array of (kanji, reading).

    ``candidates`` holds (symbol, readings). Plain characters stand for themselves. A symbol may take any 1 to ``longest`` characters that no rule explains, for the cost
    ``unknown`` and one for each. Where even this spells nothing, the cost is null and the first symbol takes what the plain characters at both ends leave. ``words`` holds
    one row per word; a null reading has no path.
    """
    changes = japanese_changes() if changes is None else changes
    spelled = words.select(word, reading).filter(has_symbol(F.col(word), symbol))
    pairs = spelled.withColumn("symbol", F.explode(distinct_symbols(F.col(word), symbol)))
    variants = candidates.select("symbol", reading_variants(F.col("readings"), changes).alias("_variants"))
    found = lookup_join(pairs, variants, ["symbol"])
    known = found.groupBy(word).agg(F.min(reading).alias(reading), F.map_from_entries(F.collect_set(F.struct(
        "symbol", F.coalesce("_variants", F.array().cast(VARIANTS))))).alias("_known"))
    chars = known.withColumn("_chars", characters(F.col(word)))
    choices = F.transform("_chars", lambda c: F.struct(
        F.map_contains_key("_known", c).alias("wild"),
        F.coalesce(F.try_element_at("_known", c), F.array(_variant(to_hiragana(c), F.lit(0), False, False)).cast(VARIANTS)).alias("variants")))
    # found once and then named, or the lattice would be walked for each use
    split = chars.withColumn("_best", F.transform(F.array(choices), lambda cs: cheapest_path(cs, F.col(reading), unknown, longest))[0])
    path = F.coalesce(F.col("_best.path"), first_takes_all(F.col("_chars"), F.col("_known"), F.col(word), F.col(reading), symbol))
    paired = F.filter(
        F.transform(F.arrays_zip(F.col("_chars").alias("kanji"), path.alias("reading")), lambda p: F.struct(p["kanji"].alias("kanji"), p["reading"].alias("reading"))),
        lambda p: F.map_contains_key("_known", p["kanji"]))
    return split.select(word, paired.alias(out), F.col("_best.cost").alias("cost"))
