"""Source scans. Schemas are declared; inference costs one more pass and is used only when asked for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions.records import bracket_reading, decomposition, glosses, headword, is_decomposition
from lexforge.functions.symbols import KANJI, strip
from lexforge.operators.profile import profile
from lexforge.sources import schemas

CORRUPT = "_corrupt_record"


# File names below one folder, unless a path is given.
FILES = {
    "levels": "levels.json",
    "dictionary": "dictionary.txt",
    "kanjidic": "kanjidic.json",
    "kanji_alive": "kanji-alive.json",
    "tanos": "tanos.json",
    "word_frequencies": "word-frequencies.json",
    "decompositions": "decompositions.txt",
    "component_lists": "component-lists.txt",
}
OPTIONAL_FILES = {"sentences": "sentences.json", "wiki_radicals": "wiki-radicals.json"}


@dataclass(frozen=True)
class SourcePaths:
    """Where the sources lie; every path is passed in, and the cache folder may be left out."""

    levels: str
    dictionary: str
    kanjidic: str
    kanji_alive: str
    tanos: str
    word_frequencies: str
    decompositions: str
    component_lists: str
    symbol_frequencies: Mapping[str, str]
    sentences: str | None = None
    wiki_radicals: str | None = None
    lemmas: str | None = None
    cache: str | None = None

    @classmethod
    def in_folder(cls, folder: str, **others: str | None) -> SourcePaths:
        """The default file names below one folder; any path can be given by name instead."""
        root = folder.rstrip("/")
        paths = {name: f"{root}/{file}" for name, file in FILES.items()}
        corpora = {prefix: f"{root}/{prefix}.csv" for prefix in schemas.CORPORA}
        return cls(**{**paths, "symbol_frequencies": corpora, **others})


def json_lines(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False,
               keep_corrupt: bool = False) -> DataFrame:
    """One JSON object per line, or whole-file JSON with ``multi_line``.

    ``keep_corrupt`` keeps lines that do not parse in the column ``_corrupt_record``.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    if schema:
        reader = reader.schema(f"{schema}, {CORRUPT} string" if keep_corrupt else schema)
    elif keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def symbol_frequencies(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Headerless (symbol, occurrences, frequency) rows, quoted or not."""
    if infer:
        return spark.read.option("inferSchema", True).csv(path).toDF("symbol", "occurrences", "frequency")
    return spark.read.schema(schemas.SYMBOL_FREQUENCY).csv(path)


def two_fields(spark: SparkSession, path: str, names: tuple[str, str] = ("fKanji", "ffragments"),
               separator: str = ":") -> DataFrame:
    """Lines of two fields, trimmed."""
    lines = spark.read.schema(f"{names[0]} string, {names[1]} string").option("sep", separator).csv(path)
    return lines.select(*[strip(F.col(n)).alias(n) for n in names])


def component_pairs(lists: DataFrame, key: str = "fKanji", listed: str = "ffragments", component: str = "component") -> DataFrame:
    """(key, component) of every component in a list separated by spaces."""
    parts = lists.select(key, F.explode(F.split(F.col(listed), " +")).alias(component))
    return parts.filter(F.col(component) != "").distinct()


def text_lines(spark: SparkSession, path: str, place: str | None = None) -> DataFrame:
    """(value) per line. ``place`` adds a column that sorts as the lines do in their files."""
    lines = spark.read.text(path)
    if place is None:
        return lines
    # a block of a file is read by one task, which numbers its rows upwards
    return lines.select("value", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias(place))


def dictionary_entries(lines: DataFrame, line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """(edictWord, reading, translations) of every dictionary line, repeats included, and the kept columns."""
    text = F.col(line)
    return lines.select(
        headword(text).alias("edictWord"), bracket_reading(text).alias("reading"),
        glosses(text).alias("translations"), *keep,
    )


def decompositions(lines: DataFrame, line: str = "value", symbol: str = KANJI, with_parts: bool = False) -> DataFrame:
    """(cKanji, components) of the lines that start with a symbol; other lines are skipped."""
    text = F.col(line)
    return lines.filter(is_decomposition(text, symbol)).select(
        F.substring(text, 1, 1).alias("cKanji"), decomposition(text, with_parts).alias("components")
    )


def levels(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.LEVELS)


def kanjidic(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.KANJIDIC).withColumnsRenamed(schemas.KANJIDIC_NAMES)


def kanji_alive(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.KANJI_ALIVE).withColumnsRenamed(schemas.KANJI_ALIVE_NAMES)


def tanos(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.TANOS).withColumnsRenamed(schemas.TANOS_NAMES)


def sentences(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.SENTENCES)


def word_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """Word counts and shares, turned into numbers so that ranks compare values and not text."""
    return numeric_word_frequencies(json_lines(spark, path, schemas.WORD_FREQUENCY))


def numeric_word_frequencies(df: DataFrame) -> DataFrame:
    numbers = {c: F.expr(f"try_cast(`{c}` AS bigint)") for c in schemas.WORD_COUNTS}
    numbers |= {c: F.expr(f"try_cast(`{c}` AS double)") for c in schemas.WORD_SHARES}
    return df.withColumns(numbers)


def audit(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source: rows, corrupt rows, and how many columns are null throughout.

    Shows a file of the wrong encoding, layout or schema, and one that came back empty.
    """
    reports = []
    for name, df in sources.items():
        columns = profile(df, distinct=False)
        rows, nulls = F.col("n_rows"), F.col("n_nulls")
        corrupt = F.max(F.when(F.col("column_name") == CORRUPT, rows - nulls))
        checked = F.col("column_name") != CORRUPT
        reports.append(columns.agg(
            F.lit(name).alias("source"), F.max(rows).alias("n_rows"),
            F.coalesce(corrupt, F.lit(0).cast("bigint")).alias("n_corrupt"),
            F.count_if(checked & (rows > 0) & (rows == nulls)).alias("n_null_columns"),
        ))
    result = reports[0]
    for r in reports[1:]:
        result = result.unionByName(r)
    return result
