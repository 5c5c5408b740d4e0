"""Document fingerprints by consistent weighted sampling.

A term is a word and its weight how often the text holds it. For each of ``SAMPLES`` independent samples a term draws, from its hash
alone, two numbers r and c of the gamma law Gamma(2, 1) and one number b uniform in 0..1. With t = floor(ln(weight) / r + b) its key is
c * exp(-r * (t - b + 1)), and the sample is the term and t of the smallest key. The chance that two texts have the same sample is their generalised
Jaccard similarity, the sum of the smaller weights over the sum of the larger. A fingerprint holds ``SAMPLE_BITS`` bits of a hash of each sample;
likeness is the share of equal samples, less what equal bits by chance would give.

Draws come from a table of 65,536 triples that every task makes from the same rule; a term's place in it differs from sample to sample.

Defined cases: a null or empty text has no terms; its fingerprint is that of nothing, likeness 1 to another such text and 0 to any
other. ``with_edits`` orders rows by id, equal ids by text, null ids first; a table of one row is its own next; an empty table gives no rows.
Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.batches import mix, slices, words, written

SAMPLES = 128
SAMPLE_BITS = 8
POOL_BITS = 16


def _pool() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, ln c, b): gamma numbers are minus the logarithm of two uniform numbers' product."""
    n = 1 << POOL_BITS
    uniform = ((mix(np.arange(5 * n, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    u = uniform.reshape(5, n)
    return -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]


_R, _LN_C, _B = (x.astype(np.float32) for x in _pool())
#: the key's logarithm of a term of weight 1, for which t is 0
_ONE = _LN_C - _R * (1 - _B)
_TURNS = mix(np.arange(SAMPLES, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)


def weighted_terms(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms, weights, rows): the distinct words of each text and how often it holds them."""
    h = hashes.copy()
    edges = rows.tolist()
    for a, b in zip(edges, edges[1:]):
        h[a:b].sort()
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    new[rows[:-1][np.diff(rows) > 0]] = True
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))), np.concatenate([[0], np.cumsum(new)])[rows]


def samples(terms: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A row of sample hashes per text, SAMPLES of SAMPLE_BITS bits; zeros for a text without terms."""
    out = np.zeros((len(rows) - 1, SAMPLES), dtype=np.uint8)
    full = np.flatnonzero(np.diff(rows) > 0)
    if not len(full):
        return out
    heads = rows[full]
    many = np.flatnonzero(weights > 1)
    ln_weights = np.log(weights[many]).astype(np.float32)
    owner = np.repeat(np.arange(len(full)), np.diff(rows)[full])
    for k, turn in enumerate(_TURNS):
        place = ((terms * turn) >> np.uint64(64 - POOL_BITS)).astype(np.int64)
        keys = _ONE[place]
        r, b = _R[place[many]], _B[place[many]]
        t = np.floor(ln_weights / r + b)
        keys[many] = _LN_C[place[many]] - r * (t - b + 1)
        least = np.minimum.reduceat(keys, heads)
        hits = np.flatnonzero(keys == least[owner])
        # of equal keys the smallest term counts: terms are in order, so it is the first of its text
        first = np.ones(len(hits), dtype=bool)
        first[1:] = owner[hits[1:]] != owner[hits[:-1]]
        chosen = hits[first]
        steps = np.zeros(len(weights), dtype=np.int64)
        steps[many] = t.astype(np.int64)
        sample = mix(terms[chosen] ^ (steps[chosen].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ turn)
        out[full, k] = (sample >> np.uint64(64 - SAMPLE_BITS)).astype(np.uint8)
    return out


def fingerprint_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(samples, empty) of texts; ``empty`` marks texts without a term."""
    found = words(texts)
    terms, weights, rows = weighted_terms(found.hashes, found.rows)
    return samples(terms, weights, rows), np.diff(rows) == 0


def likeness(a: np.ndarray, b: np.ndarray, empty_a: np.ndarray, empty_b: np.ndarray) -> np.ndarray:
    """The share of equal samples, less the share that equal bits give by chance; 0 to 1."""
    share = (a == b).mean(axis=1)
    chance = 2.0**-SAMPLE_BITS
    return np.where(empty_a | empty_b, np.where(empty_a & empty_b, 1.0, 0.0), np.maximum(0.0, (share - chance) / (1 - chance)))


def _written(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes().hex() for r in rows], pa.string())


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of ``text`` as hexadecimal digits to every row; a column named like it is replaced."""
    kept = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found, _ = fingerprint_rows(part.column(text))
                yield pa.RecordBatch.from_arrays([*part.columns, _written(found)], names=[*part.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())]))


def edited(text: str, following: str) -> str:
    """The text whose last quarter is replaced by as many first code points of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_MEASURED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _measured(texts: list[str], following: list[str], own: np.ndarray, empty: np.ndarray, after: np.ndarray, empty_after: np.ndarray) -> list[pa.Array]:
    """The result columns of texts, given those that follow them and the samples of both."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    other, empty_other = fingerprint_rows(pa.array(changed, pa.string()))
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    return [pa.array(list(map(len, texts)), pa.int64()), pa.array(digests, pa.string()), _written(own), _written(other),
            pa.array(likeness(own, other, empty, empty_other)), pa.array(likeness(own, after, empty, empty_after))]


def with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Rows are ranged by id and sorted, so a text meets the next one in its own task. The last text of a range needs the first of the
    next range: both are written, one of each a range, and joined afterwards.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(ranges, "_id").sortWithinPartitions("_id", "_text")
    kind = docs.schema[key].dataType
    names = ["_id", *_RESULT, "_edge", "_block", "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        held = None  # (id, text, samples, empty) of the last row

        def edge(which: str, row: tuple) -> pa.RecordBatch:
            nulls = [pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([row[0], *nulls, pa.array([which]), pa.array([block], pa.int32()), pa.array([row[1]], pa.string())], names=names)

        for batch in batches:
            for part in slices(batch, "_text"):
                ids, texts = part.column("_id"), part.column("_text").to_pylist()
                own, empty = fingerprint_rows(part.column("_text"))
                if held is None:
                    yield edge("first", (ids.slice(0, 1), texts[0]))
                else:
                    ids = pa.concat_arrays([held[0], ids])
                    texts, own, empty = [held[1], *texts], np.concatenate([held[2], own]), np.concatenate([held[3], empty])
                n = len(texts) - 1
                if n:
                    columns = _measured(texts[:n], texts[1:], own[:n], empty[:n], own[1:], empty[1:])
                    yield pa.RecordBatch.from_arrays([ids.slice(0, n), *columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()),
                                                      pa.nulls(n, pa.string())], names=names)
                held = ids.slice(n, 1), texts[n], own[n:], empty[n:]
        if held is not None:
            yield edge("last", held)

    fields = rows.schema["_id"].simpleString().split(":", 1)[1]
    found = written(ordered.mapInArrow(run, f"_id {fields}, {_MEASURED}, _edge string, _block int, _text string"), "measured")
    # one row per range: the next range that holds rows, and after the last the first
    firsts = found.filter("_edge = 'first'").select("_block", F.col("_text").alias("_next"))
    blocks = found.filter("_edge = 'first'").select("_block")
    order = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to = blocks.select("_block", F.coalesce(F.lead("_block").over(Window.orderBy("_block")), F.first("_block").over(order)).alias("_to"))
    lasts = found.filter("_edge = 'last'").select("_id", "_text", "_block").join(to, "_block").drop("_block")
    pairs = lasts.join(firsts, lasts["_to"] == firsts["_block"]).select("_id", "_text", "_next")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                both = [part.column("_text"), part.column("_next")]
                (own, empty), (after, empty_after) = map(fingerprint_rows, both)
                columns = _measured(both[0].to_pylist(), both[1].to_pylist(), own, empty, after, empty_after)
                yield pa.RecordBatch.from_arrays([part.column("_id"), *columns], names=["_id", *_RESULT])

    ends = pairs.mapInArrow(finish, f"_id {fields}, {_MEASURED}")
    inner = found.filter("_edge is null").select("_id", *_RESULT)
    return inner.union(ends).select(F.col("_id").cast(kind).alias(key), *_RESULT)
