"""The whole run: from the source files to the summaries and entries."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge import __version__
from lexforge.operators.batches import entry_batches
from lexforge.operators.closure import closure
from lexforge.operators.inverted import posting_lists
from lexforge.operators.layout import more_than, order_by_rank
from lexforge.operators.matching import texts_of_words
from lexforge.operators.materialize import materialize, own_work_tables
from lexforge.operators.profile import profile
from lexforge.plans.crossing import symbols_per_word, symbols_with_words, words_per_symbol, words_with_symbols
from lexforge.plans.exports import COMMON_WORD, SUMMARY_WORD, summarize_symbols, summarize_words, symbol_entries, word_entries
from lexforge.plans.frequencies import compile_frequencies
from lexforge.plans.inflection import japanese_endings
from lexforge.plans.master import symbol_master
from lexforge.plans.meanings import combine_meanings
from lexforge.plans.readings import combine_readings, dictionary_readings, infer_readings, reading_candidates, reading_sums
from lexforge.plans.sounds import japanese_changes
from lexforge.plans.vocabulary import compile_dictionary, compile_vocabulary
from lexforge.sources import readers, sinks
from lexforge.sources.cache import cached, source_fingerprint
from lexforge.sources.readers import SourcePaths, audit


SUMMARIES = ("word_summary", "symbol_summary")


@dataclass(frozen=True)
class RunOptions:
    """Choices of a run; the defaults are the plain rules."""

    use_tanos: bool = False
    strict_keys: bool = False
    drop_totals: bool = False
    keep_unread: bool = False
    keep_unmatched: bool = False
    common_word: int = COMMON_WORD
    summary_word: int = SUMMARY_WORD
    partitions: int | None = None
    rows_per_file: int | None = None
    #: entry lines per request body, and the tables that the bodies name; no bodies are written without a number
    batch: int | None = None
    word_table: str = "words"
    symbol_table: str = "symbols"
    report: bool = False
    #: readings split over symbols with sound changes, base forms by endings where no lemmas are given, and the entry of the base form for words without one
    sound_changes: bool = False
    deinflect: bool = False
    second_chance: bool = False


class _Stages:
    """Tables that others read, written once: to the cache under a digest of what they are made from, or for this run only.

    The digest of a stage holds its own files, the options it depends on, and the digests of the stages it reads; so a changed file
    gives new tables where it is used, and the others are read back.
    """

    def __init__(self, spark: SparkSession, cache: str | None):
        self.spark, self.cache = spark, cache
        self.digests: dict[str, str] = {}
        self.files: dict[str, str] = {}

    def _file(self, path: str) -> str:
        if path not in self.files:
            self.files[path] = source_fingerprint(self.spark, [path])
        return self.files[path]

    def __call__(self, name: str, build: Callable[[], DataFrame], files: Sequence[str] = (), after: Sequence[str] = (),
                 options: object = ()) -> DataFrame:
        if not self.cache:
            return materialize(build(), name)
        parts = [name, __version__, *[f"{f}={self._file(f)}" for f in files], *[self.digests[a] for a in after], repr(options)]
        self.digests[name] = hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]
        return cached(self.spark, f"{self.cache.rstrip('/')}/{name}", build, fingerprint=self.digests[name])


def compile_all(spark: SparkSession, paths: SourcePaths, options: RunOptions | None = None, nested: bool = True) -> dict[str, DataFrame]:
    """Every table of the run, by name; without ``nested`` those that nest words and symbols are left out.

    Tables that several others read are written once; the rest are plans that run when they are written.
    """
    o = options or RunOptions()
    stage = _Stages(spark, paths.cache)
    levels = stage("levels", lambda: readers.levels(spark, paths.levels), [paths.levels])
    kanjidic = stage("kanjidic", lambda: readers.kanjidic(spark, paths.kanjidic), [paths.kanjidic])
    kanji_alive = stage("kanji-alive", lambda: readers.kanji_alive(spark, paths.kanji_alive), [paths.kanji_alive])
    tanos = stage("tanos", lambda: readers.tanos(spark, paths.tanos), [paths.tanos])
    dictionary = stage("dictionary", lambda: compile_dictionary(
        readers.dictionary_entries(readers.text_lines(spark, paths.dictionary, "place"), keep=["place"]), "place"), [paths.dictionary])
    frequencies = stage("frequencies", lambda: compile_frequencies(
        {prefix: readers.symbol_frequencies(spark, p) for prefix, p in paths.symbol_frequencies.items()}, drop_totals=o.drop_totals),
        list(paths.symbol_frequencies.values()), options=(list(paths.symbol_frequencies), o.drop_totals))
    meanings = stage("meanings", lambda: combine_meanings(kanjidic, kanji_alive, tanos, o.strict_keys),
                     after=["kanjidic", "kanji-alive", "tanos"], options=o.strict_keys)
    listed = stage("dictionary-readings", lambda: dictionary_readings(levels, kanjidic, kanji_alive, tanos, o.use_tanos),
                   after=["levels", "kanjidic", "kanji-alive", "tanos"], options=o.use_tanos)
    lemmas = spark.read.schema("surface string, lemma string").json(paths.lemmas) if paths.lemmas else None
    words = stage("words", lambda: readers.word_frequencies(spark, paths.word_frequencies), [paths.word_frequencies])
    vocabulary = stage("vocabulary", lambda: compile_vocabulary(
        words, dictionary, reading_candidates(listed), lemmas, changes=japanese_changes() if o.sound_changes else None,
        endings=japanese_endings() if o.deinflect else None, second_chance=o.second_chance),
        [paths.lemmas] if paths.lemmas else [], ["words", "dictionary", "dictionary-readings"], (o.sound_changes, o.deinflect, o.second_chance))
    sums = stage("reading-sums", lambda: reading_sums(vocabulary), after=["vocabulary"])
    readings = stage("readings", lambda: combine_readings(listed, sums), after=["dictionary-readings", "reading-sums"])
    parts = readers.decompositions(readers.text_lines(spark, paths.decompositions))
    symbols = stage("symbols", lambda: symbol_master(
        levels, kanjidic, kanji_alive, parts, frequencies, meanings, sums, readings, o.keep_unread), [paths.decompositions],
        ["levels", "kanjidic", "kanji-alive", "frequencies", "meanings", "reading-sums", "readings"], o.keep_unread)
    lists = readers.two_fields(spark, paths.component_lists)
    held = stage("component-pairs", lambda: readers.component_pairs(lists), [paths.component_lists])
    tables = {
        "component_pairs": held, "component_index": posting_lists(held, "fKanji", "component"),
        "all_components": stage("all-components", lambda: closure(held, "fKanji", "component"), after=["component-pairs"]),
        "levels": levels, "kanjidic": kanjidic, "kanji_alive": kanji_alive, "tanos": tanos,
        "dictionary": dictionary, "frequencies": frequencies, "meanings": meanings,
        "component_lists": lists, "decompositions": parts,
        "vocabulary": vocabulary, "inferred_readings": infer_readings(sums),
        "dictionary_readings": listed, "readings": readings,
        "symbols": order_by_rank(symbols, "rank", "kanji"),
        "common_words": more_than(vocabulary, "totalOcurrences", o.common_word),
        "word_summary": summarize_words(vocabulary, o.summary_word),
        "symbol_summary": summarize_symbols(symbols),
    }
    if nested:
        # the nested tables are written as they are and as entries
        words_nested = stage("symbols-with-words", lambda: symbols_with_words(symbols, words_per_symbol(vocabulary)),
                             after=["symbols", "vocabulary"])
        symbols_nested = stage("words-with-symbols", lambda: words_with_symbols(
            vocabulary, symbols_per_word(vocabulary, symbols), keep_unmatched=o.keep_unmatched), after=["symbols", "vocabulary"],
            options=o.keep_unmatched)
        common = more_than(symbols_nested, "totalOcurrences", o.common_word)
        tables |= {
            "symbols_with_words": words_nested, "words_with_symbols": symbols_nested, "common_words_with_symbols": common,
            "word_entries": word_entries(symbols_nested), "common_word_entries": word_entries(common),
            "symbol_entries": symbol_entries(words_nested),
        }
    if paths.sentences:
        tables["sentences"] = readers.sentences(spark, paths.sentences)
        tables["word_sentences"] = stage("word-sentences", lambda: texts_of_words(
            tables["sentences"].groupBy("firstId").agg(F.min("jpSentence").alias("jpSentence")), "firstId", "jpSentence", vocabulary, "word", "sentences"),
            [paths.sentences], ["vocabulary"])
    if paths.wiki_radicals:
        tables["wiki_radicals"] = readers.json_lines(spark, paths.wiki_radicals)
    return tables


def report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column_name, column_type, n_rows, n_nulls, n_distinct) of every table, for a look at a run."""
    profiles = [profile(df).select(F.lit(name).alias("table"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, profiles)


def run(spark: SparkSession, paths: SourcePaths, output: str, everything: bool = False, options: RunOptions | None = None) -> dict[str, DataFrame]:
    """Compile all tables and write the two summaries; with ``everything`` also tables and entries.

    Options add request bodies, and a report with an audit of the sources and a profile of the written tables. Tables that were written for
    this run alone are deleted at its end; without a cache, the returned plans can be explained but not run again.
    """
    with own_work_tables(spark):
        return _run(spark, paths, output.rstrip("/"), everything, options or RunOptions())


def _run(spark: SparkSession, paths: SourcePaths, out: str, everything: bool, o: RunOptions) -> dict[str, DataFrame]:
    tables = compile_all(spark, paths, o, nested=everything)
    layout = {"partitions": o.partitions, "rows_per_file": o.rows_per_file}
    written = list(SUMMARIES)
    if everything:
        written += ["symbols", "symbols_with_words", "vocabulary", "words_with_symbols", "common_words", "common_words_with_symbols"]
    for name in written:
        sinks.write_json(tables[name], f"{out}/{name}", **layout)
    if everything:
        for name in ("word_entries", "common_word_entries", "symbol_entries"):
            sinks.write_text(tables[name], f"{out}/{name}", **layout)
            if o.batch:
                table = o.symbol_table if name == "symbol_entries" else o.word_table
                sinks.write_text(entry_batches(tables[name], table, o.batch), f"{out}/{name.replace('entries', 'bodies')}", "body")
    if o.report:
        sources = {n: tables[n] for n in ("levels", "kanjidic", "kanji_alive", "tanos", "component_lists", "decompositions")}
        sinks.write_json(audit(sources), f"{out}/audit")
        sinks.write_json(report({n: tables[n] for n in written}), f"{out}/profile")
    return tables
