"""Readings of symbols learned from words alone, by expectation-maximisation over all ways to split a word's reading."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.kana import to_hiragana
from lexforge.functions.lists import no_strings
from lexforge.functions.symbols import KANJI, characters, has_symbol, is_symbol
from lexforge.operators import joins
from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize

_STATES = "array<struct<used:int,path:array<string>>>"


def splits(chars: Column, reading: Column, symbol: str = KANJI, longest: int = 4) -> Column:
    """All ways to give every symbol 1 to ``longest`` characters of the reading and every plain character itself, as arrays of parts."""
    size, total = F.size(chars), F.char_length(reading)

    def extend(acc: Column, char: Column) -> Column:
        behind = size - acc["at"] - 1

        plain = to_hiragana(char)

        def guessed(state: Column) -> Column:
            # every place behind needs a character of its own
            most = F.least(F.lit(longest), total - state["used"] - behind)
            sizes = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
            return F.transform(sizes, lambda n: F.struct((state["used"] + n).alias("used"), F.concat(
                state["path"], F.array(F.substr(reading, state["used"] + 1, n))).alias("path")))

        def itself(state: Column) -> Column:
            return F.struct((state["used"] + F.char_length(plain)).alias("used"), F.concat(state["path"], F.array(plain)).alias("path"))

        # what a character is, is asked once for all states
        grown = F.when(is_symbol(char, symbol), F.flatten(F.transform(acc["states"], guessed)).cast(_STATES)).otherwise(F.transform(
            F.filter(acc["states"], lambda state: F.substr(reading, state["used"] + 1, F.char_length(plain)) == plain), itself).cast(_STATES))
        return F.struct((acc["at"] + 1).alias("at"), grown.alias("states"))

    start = F.struct(F.lit(0).alias("at"), F.array(F.struct(F.lit(0).alias("used"), no_strings().alias("path"))).cast(_STATES).alias("states"))
    ends = F.reduce(chars, start, extend, lambda acc: F.filter(acc["states"], lambda s: s["used"] == total))
    return F.transform(ends, lambda s: s["path"])


def _shares(counts: DataFrame) -> DataFrame:
    """(symbol, part, count, share): the counts of a symbol's parts as shares of all of them."""
    totals = counts.groupBy("symbol").agg(F.sum("count").alias("_all"))
    return lookup_join(counts, totals, ["symbol"], "inner").select("symbol", "part", "count", (F.col("count") / F.col("_all")).alias("share"))


Pairs = list[tuple[str, str]]


def _numbered(ways: DataFrame, pairs: Pairs) -> DataFrame:
    """(_n, _ways): the ways of each word with numbers in place of their pairs of symbol and part."""
    number = {f"{symbol}\0{part}": i for i, (symbol, part) in enumerate(pairs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("_ways")
            of_word = words.flatten()
            held = of_word.flatten()
            named = pc.binary_join_element_wise(*(pc.struct_field(held, f).cast(pa.string()) for f in ("symbol", "part")), "\0").dictionary_encode()
            ids = np.array([number[x] for x in named.dictionary.to_pylist()], np.int32)[named.indices.to_numpy()]
            # of a sliced batch the offsets begin anywhere
            ends = [pa.array(x.offsets.to_numpy() - x.offsets[0].as_py(), pa.int32()) for x in (words, of_word)]
            yield pa.RecordBatch.from_arrays([batch.column("_n"), pa.ListArray.from_arrays(ends[0], pa.ListArray.from_arrays(ends[1], pa.array(ids, pa.int32())))], names=["_n", "_ways"])

    return ways.select("_n", "_ways").mapInArrow(run, "_n double, _ways array<array<int>>")


def _counted(ways: DataFrame, pairs: Pairs, shares: dict[tuple[str, str], float] | None) -> DataFrame:
    """(symbol, part, count): the parts of numbered ways, each way weighed within its word; the counts of a task are added up there."""
    logs = np.zeros(len(pairs)) if shares is None else np.log(np.array([shares.get(p, np.nan) for p in pairs]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(logs))
        for batch in batches:
            words = batch.column("_ways")
            of_word = words.flatten()
            ids = of_word.flatten().to_numpy()
            word = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
            way = np.repeat(np.arange(len(of_word)), np.diff(of_word.offsets.to_numpy()))
            known = ~np.isnan(logs[ids])
            score = np.bincount(way, np.where(known, logs[ids], 0.0), len(of_word))
            score[np.bincount(way, known, len(of_word)) == 0] = -np.inf
            best = np.full(len(words), -np.inf)
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            if not len(begins):
                continue
            best[word[begins]] = np.maximum.reduceat(score, begins)
            weight = np.where(np.isfinite(score), np.exp(score - np.where(np.isfinite(best), best, 0.0)[word]), 0.0)
            total = np.bincount(word, weight, len(words))
            weight *= (batch.column("_n").to_numpy() / np.where(total > 0, total, 1.0))[word]
            counts += np.bincount(ids, weight[way], len(logs))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([pairs[i][k] for i in at.tolist()], pa.string()) for k in (0, 1)] + [pa.array(counts[at])], names=["symbol", "part", "count"])

    return ways.mapInArrow(run, "symbol string, part string, count double").groupBy("symbol", "part").agg(F.sum("count").alias("count"))


def _counted_by_joins(parts: DataFrame, shares: DataFrame | None) -> DataFrame:
    """The same from one row per word, way and part, for pairs that are too many to be sent to the tasks."""
    own = Window.partitionBy("_word", "_reading")
    if shares is None:
        known = parts.withColumn("share", F.lit(1.0))
    else:
        known = lookup_join(parts, shares.select("symbol", "part", "share"), ["symbol", "part"], "inner")
    # the ways of one word
    scored = known.groupBy("_word", "_reading", "_way").agg(F.sum(F.log("share")).alias("_score"))
    risen = scored.withColumn("_weight", F.exp(F.col("_score") - F.max("_score").over(own)))
    weights = risen.select("_word", "_reading", "_way", (F.col("_weight") / F.sum("_weight").over(own)).alias("_weight"))
    return parts.join(weights, ["_word", "_reading", "_way"]).groupBy("symbol", "part").agg(F.sum(F.col("_n") * F.col("_weight")).alias("count"))


def learn_readings(words: DataFrame, word: str, reading: str, n: str, symbol: str = KANJI, longest: int = 4, rounds: int = 20, tolerance: float = 1e-4) -> DataFrame:
    """(symbol, part, count, share): how often each symbol is read in each way, as far as the words tell, and what share of its readings that is.

    At first all ways to split a word count alike. Each round weighs the ways of a word by the product of the shares of their parts and counts the parts anew, until no share moves by more than ``tolerance`` or
    after ``rounds``. The ways are written once, the shares once a round. Pairs of symbol and part that fit a broadcast go to the tasks with their shares, and each task weighs the ways of its words without
    a shuffle; more of them are met by a lookup join, and then only the largest change comes to the driver.
    Words without a symbol, a reading or a way, and those whose number ``n`` is null or not above 0, add nothing. Of rows with one word and reading the numbers are added up.
    """
    given = words.select(F.col(word).alias("_word"), F.col(reading).alias("_reading"), F.col(n).cast("double").alias("_n"))
    given = given.filter(has_symbol(F.col("_word"), symbol) & F.col("_reading").isNotNull() & (F.col("_n") > 0)).groupBy("_word", "_reading").agg(F.sum("_n").alias("_n"))
    chars = given.withColumn("_chars", characters(F.col("_word")))
    paths = chars.select("_word", "_reading", "_n", "_chars", splits(F.col("_chars"), F.col("_reading"), symbol, longest).alias("_paths"))
    places = F.filter(F.sequence(F.lit(0), F.size("_chars") - 1), lambda i: is_symbol(F.get("_chars", i), symbol))
    held = F.transform("_paths", lambda path: F.transform("_places", lambda i: F.struct(F.get("_chars", i).alias("symbol"), F.get(path, i).alias("part"))))
    ways = materialize(paths.withColumn("_places", places).select("_word", "_reading", "_n", held.alias("_ways")), "ways")
    found = materialize(ways.select(F.inline(F.flatten("_ways"))).distinct(), "pairs")
    few = joins.fits_broadcast(found)
    if few:
        pairs = [(r.symbol, r.part) for r in found.collect()]
        numbered = materialize(_numbered(ways, pairs), "numbered")
    else:
        parts = materialize(ways.select("_word", "_reading", "_n", F.posexplode("_ways").alias("_way", "_held")).select("_word", "_reading", "_n", "_way", F.inline("_held")), "parts")
    shares = None
    for _ in range(rounds + 1):
        if few:
            counted = _counted(numbered, pairs, None if shares is None else {(r.symbol, r.part): r.share for r in shares.select("symbol", "part", "share").collect()})
        else:
            counted = _counted_by_joins(parts, shares)
        # shares of nothing have no logarithm
        new = materialize(_shares(materialize(counted.filter("count > 1e-300"), "counted")), "shares")
        if shares is not None:
            before = shares.select("symbol", "part", F.col("share").alias("_before"))
            moved = new.join(before, ["symbol", "part"], "full").agg(F.max(F.abs(F.coalesce("share", F.lit(0.0)) - F.coalesce("_before", F.lit(0.0))))).first()[0]
            if moved is None or moved <= tolerance:
                return new
        shares = new
    return shares
