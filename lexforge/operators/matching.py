"""Many patterns in many texts: the words of a list that occur in running text without spaces, the longest first."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.operators.materialize import materialize
from lexforge.operators.nesting import nest

# Texts of about so many characters meet about so many words in one group; a group gives lists of about so many matches at a time.
BLOCK_CHARACTERS = 4 << 20
SHARD_WORDS = 1_000_000
LISTED = 1 << 16
_MATCH = "struct<at:int,size:int,word:string>"


class _Words:
    """Some of the words. A word of n characters is filed under its first p, the largest power of two that is not above n, so that of a place only the lengths of words that begin so are tried."""

    def __init__(self, words: Iterable[str]):
        self.words = set(words)
        filed: dict[str, set[int]] = {}
        for word in self.words:
            filed.setdefault(word[:1 << (len(word).bit_length() - 1)], set()).add(len(word))
        self.filed = {beginning: sorted(sizes, reverse=True) for beginning, sizes in filed.items()}
        self.powers = sorted({len(beginning) for beginning in filed}, reverse=True)

    def longest(self, text: str) -> list[int]:
        """The length of the longest of the words that begins at each place of a text, or 0."""
        words, sizes_of, powers, total = self.words, self.filed.get, self.powers, len(text)
        out = []
        for at in range(total):
            found, room = 0, total - at
            for power in powers:
                sizes = sizes_of(text[at:at + power]) if power <= room else None
                if sizes:
                    for n in sizes:
                        if n <= room and text[at:at + n] in words:
                            found = n
                            break
                    if found:
                        break
            out.append(found)
        return out


def _listed(texts: list[str], found: list[np.ndarray]) -> pa.Array:
    """The matches (at, size, word) of texts from the lengths found at their places."""
    places = [np.flatnonzero(sizes) for sizes in found]
    sizes = [f[p] for f, p in zip(found, places)]
    taken = [text[i:i + n] for text, p, s in zip(texts, places, sizes) for i, n in zip(p.tolist(), s.tolist())]
    matches = pa.StructArray.from_arrays([pa.array(np.concatenate(places), pa.int32()), pa.array(np.concatenate(sizes), pa.int32()), pa.array(taken, pa.string())], names=["at", "size", "word"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, places)]), pa.int32()), matches)


def longest_matches(matches: Column) -> Column:
    """Matches (at, size, word) of one text, read from the left: at each place the longest, and none that begins inside one that was taken."""
    longest_first = F.array_sort(matches, lambda a, b: F.when(a["at"] != b["at"], a["at"] - b["at"]).otherwise(b["size"] - a["size"]))

    def take(acc: Column, m: Column) -> Column:
        free = m["at"] >= acc["end"]
        return F.struct(F.when(free, m["at"] + m["size"]).otherwise(acc["end"]).alias("end"),
                        F.when(free, F.concat(acc["kept"], F.array(m))).otherwise(acc["kept"]).alias("kept"))

    start = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{_MATCH}>").alias("kept"))
    return F.reduce(longest_first, start, take, lambda acc: acc["kept"])


def words_in_texts(texts: DataFrame, key: str, text: str, words: DataFrame, word: str) -> DataFrame:
    """(key, at, word): the words found in every text, at places counted from 0, the longest first and without overlaps.

    Texts in blocks of about ``BLOCK_CHARACTERS`` meet the words in shards of about ``SHARD_WORDS``, so no task holds all of either if they are many. A shard gives for each text a number for every place, the length
    of its longest word there, and the largest of all shards counts; places and the texts before them never become rows. So a text costs its own size for each shard, and the words theirs
    for each block. Texts with a null key or text and null or empty words take no part; ``texts`` holds one row per key.
    """
    heads = materialize(words.select(F.col(word).alias("_word")).filter("_word <> ''").distinct(), "words")
    n_words, longest = heads.agg(F.count("*"), F.max(F.char_length("_word"))).first()
    given = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter("_key is not null and _text <> ''").distinct()
    blocks = max(1, -(-(given.agg(F.sum(F.char_length("_text"))).first()[0] or 0) // BLOCK_CHARACTERS))
    shards = max(1, -(-n_words // SHARD_WORDS))
    kind = np.dtype(np.uint8 if (longest or 0) < 256 else np.uint32)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    group = ["_block", "_shard"]
    dealt = given.withColumn("_block", F.pmod(F.xxhash64("_key", "_text"), F.lit(blocks)).cast("int")).withColumn("_shard", every(shards))
    filed = heads.withColumn("_shard", F.pmod(F.xxhash64("_word"), F.lit(shards)).cast("int")).withColumn("_block", every(blocks))
    key_type = given.schema["_key"]

    def run(block: pa.Table, shard: pa.Table) -> pa.Table:
        held = _Words(shard.column("_word").to_pylist())
        sizes = [np.array(held.longest(t), kind).tobytes() for t in block.column("_text").to_pylist()]
        return pa.table([block.column("_key"), block.column("_text"), pa.array(sizes, pa.binary())], names=["_key", "_text", "_sizes"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, bodies = batch.column("_found").to_pylist(), batch.column("_text").to_pylist()
            found = [np.maximum.reduce([np.frombuffer(x, kind) for x in several]) for several in lists]
            ends = np.cumsum([len(f) for f in found])
            cuts = [0, *(np.flatnonzero(np.diff(ends // LISTED)) + 1).tolist(), len(found)]
            for i, j in zip(cuts, cuts[1:]):
                if j > i:
                    yield pa.RecordBatch.from_arrays([batch.column("_key").slice(i, j - i), _listed(bodies[i:j], found[i:j])], names=["_key", "_all"])

    # more partitions than groups, so that few of them hold several
    groups = 4 * blocks * shards
    met = dealt.repartition(groups, *group).groupBy(*group).cogroup(filed.repartition(groups, *group).groupBy(*group))
    sized = met.applyInArrow(run, T.StructType([key_type, T.StructField("_text", T.StringType()), T.StructField("_sizes", T.BinaryType())]))
    if shards > 1:
        sized = sized.groupBy("_key", "_text").agg(F.collect_list("_sizes").alias("_found"))
    else:
        sized = sized.select("_key", "_text", F.array("_sizes").alias("_found"))
    # the longest match of each place of one text
    matches = sized.mapInArrow(listed, T.StructType([key_type, T.StructField("_all", T.ArrayType(T.StructType.fromDDL("at int, size int, word string")))]))
    taken = matches.select("_key", F.explode(longest_matches(F.col("_all"))).alias("_m"))
    return taken.select(F.col("_key").alias(key), F.col("_m.at").alias("at"), F.col("_m.word").alias(word))


def texts_of_words(texts: DataFrame, key: str, text: str, words: DataFrame, word: str, out: str = "texts", part_rows: int | None = None) -> DataFrame:
    """(word, part, texts): the keys of the texts that use each word, in order and each once; a long list goes on in further parts."""
    found = materialize(words_in_texts(texts, key, text, words, word).select(word, key).distinct(), "found")
    return nest(found, word, F.col(key), out, part_rows=part_rows)
