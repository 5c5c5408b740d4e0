"""Helpers for Arrow batches inside tasks: texts in bounded slices, word and shingle hashes without a loop per word."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.operators.materialize import work_path

SLICE_BYTES = 1 << 19
SHINGLE = 5

_MASK = (1 << 64) - 1


def _mixed_int(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = _mixed_int(1) | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
# a random number per byte; capital ASCII letters share that of the small ones
_BYTES = np.array([_mixed_int(1000 + (b + 32 if 65 <= b <= 90 else b)) for b in range(256)], dtype=np.uint64)
_PLACES = np.array([_mixed_int(5000 + i) | 1 for i in range(SHINGLE)], dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_power_cache: dict[int, np.ndarray] = {}


def _cached_powers(base: int, n: int) -> np.ndarray:
    found = _power_cache.get(base)
    if found is None or len(found) < n:
        found = _powers(base, max(n, SLICE_BYTES + 1))
        if n <= 4 * SLICE_BYTES:
            _power_cache[base] = found
    return found


@contextmanager
def no_collection() -> Iterator[None]:
    """Millions of short strings and lists without a cycle: the search for cycles would take a third of the time."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 21


def written(df: DataFrame, name: str, rows: int = 1_000) -> DataFrame:
    """Write a table with Python stages in it, handing them ``rows`` rows or about ``BATCH_BYTES`` at a time: a batch of long texts stays small."""
    return saved(df, work_path(df.sparkSession, name), rows)


def saved(df: DataFrame, path: str, rows: int = 1_000) -> DataFrame:
    """The same to a path that was named before, so that the table outlives the work tables it is made from."""
    conf = df.sparkSession.conf
    before = {name: conf.get(name) for name in (BATCH_SETTING, BATCH_BYTES_SETTING)}
    conf.set(BATCH_SETTING, str(rows))
    conf.set(BATCH_BYTES_SETTING, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            conf.set(name, value)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def streamed(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """The rows of both tables by key, of each key those of ``left`` (_kind 0) before those of ``right`` (1); a task holds what it keeps of them, not a group."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = left.withColumn("_kind", F.lit(0)).unionByName(right.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(parts, on).sortWithinPartitions(on, "_kind")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores in front as it takes to be no column of the table."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice hold ``limit`` bytes at most, or the slice is one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


class Words(NamedTuple):
    """Words of several texts one after the other. rows[i]:rows[i+1] are those of text i; starts and ends are bytes."""

    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def words(texts: pa.Array) -> Words:
    """Words between ASCII white space, A-Z in lower case, each as a 64-bit hash."""
    raw, offsets = text_buffer(texts)
    n = len(raw)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), empty, empty, offsets)
    inside = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    edge[0] = edge[n] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, side="right")))
        low, high = starts[at], ends[to - 1]
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_BYTES[raw[low:high]] * _cached_powers(_BASE, high - low)[:high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = (sums[e] - sums[s]) * _cached_powers(_BASE_INVERSE, high - low)[s]
        at = to
    hashes += (ends - starts).astype(np.uint64) * np.uint64(_BASE)
    return Words(mix(hashes), np.searchsorted(starts, offsets, side="left"), starts, ends, offsets)


def shingles(found: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, rows): runs of ``size`` words in order; a text with fewer words is one run, one without words none."""
    counts = np.diff(found.rows)
    total = len(found.hashes)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(len(found.rows), np.int64)
    places = np.array([_mixed_int(5000 + i) | 1 for i in range(size)], dtype=np.uint64)
    padded = np.concatenate([found.hashes, np.zeros(size - 1, np.uint64)])
    sums = np.zeros(total, dtype=np.uint64)
    for i in range(size):
        sums += padded[i:i + total] * places[i]
    # a position holds a run if the run ends inside its text
    left = np.repeat(found.rows[1:], counts) - np.arange(total)
    kept = left >= size
    short = np.flatnonzero((counts > 0) & (counts < size))
    for r in short:
        a, b = found.rows[r], found.rows[r + 1]
        sums[a] = (found.hashes[a:b] * places[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
        kept[a] = True
    sizes = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return mix(sums[kept]), np.concatenate([[0], np.cumsum(sizes)])


def row_numbers(rows: np.ndarray) -> np.ndarray:
    """The text that each item belongs to."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def distinct_sorted(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of every text in ascending order, with new row offsets."""
    h = hashes.copy()
    edges = rows.tolist()
    for a, b in zip(edges, edges[1:]):
        h[a:b].sort()
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    new[rows[:-1][np.diff(rows) > 0]] = True
    return h[new], np.concatenate([[0], np.cumsum(new)])[rows]
