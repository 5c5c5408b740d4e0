"""Line deduplication by sharded minimal perfect hashes.

The key of a line is the line without white space at its ends, A-Z in lower case. Keys of ``least_chars`` code points or more that ``least_docs`` documents
hold lose all their lines but those of the document with the largest id.

1. Every document is written once with the 128-bit hashes of its long lines, in blocks of bounded size. A block counts its own distinct hashes, Spark adds up the
   blocks, so a line of all documents is one row a block.
2. The distinct hashes are cut into shards. A shard becomes a minimal perfect hash: in level after level each key has a bit of its own or goes on to the
   next, and the rank of its bit is its slot. By slot there are a 32-bit fingerprint and a count (16 bits, saturated), and for keys of ``least_docs`` documents
   the largest id. No hash and no line is stored.
3. The distinct hashes of a block go to the shards and probe the arrays; a shard is held alone while its blocks stream past. What is repeated goes back to the
   block, whose documents look up their lines there. A document of the same corpus is always in the index; for a foreign line the fingerprint
   fails to tell with a chance of 2^-32.

Defined cases: a null or empty text is one empty line; every row counts as a document, and rows that share the largest id all keep their lines; a null id is
smaller than any other, so lines that only such rows hold stay; a text of which all lines go is empty; an empty table gives no rows; other columns are kept as they are,
those named ``n_lines`` or ``n_dropped`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.batches import free_names, mix, slices, streamed, written
from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize

LEAST_CHARS = 40
LEAST_DOCS = 5
#: distinct hashes of a shard, and hashes of a block, at most about
SHARD_KEYS = 1 << 18
BLOCK_KEYS = 1 << 17
#: bits of a level for each key that is left
SPARSITY = 2
_SPACE = b" \t\n\x0b\x0c\r"
_NO_ID = np.iinfo(np.int64).min
_PAIR = np.dtype([("a", "<u8"), ("b", "<u8")])


def long_lines(text: bytes | None, least_chars: int = LEAST_CHARS) -> tuple[list[int], list[bytes]]:
    """(numbers, keys) of the lines whose key is long enough."""
    numbers, keys = [], []
    for i, line in enumerate((text or b"").split(b"\n")):
        key = line.strip(_SPACE).lower()
        # a code point has four bytes at most, so most lines need no decoding
        if len(key) >= least_chars and (len(key) >= 4 * least_chars or len(key.decode()) >= least_chars):
            numbers.append(i)
            keys.append(key)
    return numbers, keys


class PerfectHash(NamedTuple):
    """Bits of all levels one after the other; ``sizes`` says how many a level has."""

    sizes: np.ndarray
    bits: np.ndarray

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(a ^ mix(b + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        """A slot of its own for each of the distinct pairs (a, b)."""
        sizes, levels = [], []
        while len(a):
            size = -(-SPARSITY * len(a) // 8) * 8
            at = cls._place(a, b, len(sizes), size)
            crowd = np.bincount(at, minlength=size)
            levels.append(np.packbits(crowd == 1, bitorder="little"))
            sizes.append(size)
            left = crowd[at] > 1
            a, b = a[left], b[left]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, np.uint8))

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each pair; a pair that was not among the keys has any slot, or -1."""
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])
        out = np.full(len(a), -1, np.int64)
        left, base = np.arange(len(a)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = base + self._place(a[left], b[left], level, size)
            byte, bit = self.bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            below = np.bitwise_count(byte & ((np.uint8(1) << bit) - np.uint8(1)))
            out[left[hit]] = (before[at >> 3] + below)[hit]
            left, base = left[~hit], base + size
        return out


class Shard(NamedTuple):
    """A perfect hash with what it indexes: fingerprint and count by slot, and the largest ids of the repeated keys in the order of their slots."""

    keys: PerfectHash
    fingerprints: np.ndarray
    counts: np.ndarray
    last: np.ndarray
    least_docs: int

    @staticmethod
    def fingerprint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (mix(b ^ mix(a)) >> np.uint64(32)).astype(np.uint32)

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, n: np.ndarray, last: np.ndarray, least_docs: int) -> Shard:
        keys = PerfectHash.of(a, b)
        slot = keys.slots(a, b)
        fingerprints, counts, ids = np.zeros(len(a), np.uint32), np.zeros(len(a), np.uint16), np.zeros(len(a), np.int64)
        fingerprints[slot], counts[slot], ids[slot] = cls.fingerprint(a, b), np.minimum(n, 0xFFFF), last
        return cls(keys, fingerprints, counts, ids[counts >= least_docs], least_docs)

    def probe(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, last): the pairs that are repeated keys, and the largest id of each."""
        slot = self.keys.slots(a, b)
        which = np.flatnonzero(slot >= 0)
        which = which[self.fingerprints[slot[which]] == self.fingerprint(a[which], b[which])]
        repeated = self.counts >= self.least_docs
        which = which[repeated[slot[which]]]
        return which, self.last[np.cumsum(repeated)[slot[which]] - 1]

    def packed(self) -> list[bytes]:
        return [x.tobytes() for x in (self.keys.sizes, self.keys.bits, self.fingerprints, self.counts, self.last)]

    @classmethod
    def unpacked(cls, columns: list[bytes], least_docs: int) -> Shard:
        sizes, bits, fingerprints, counts, last = (np.frombuffer(x, t) for x, t in zip(columns, (np.int64, np.uint8, np.uint32, np.uint16, np.int64)))
        return cls(PerfectHash(sizes, bits), fingerprints, counts, last, least_docs)


_ARRAYS = ["_sizes", "_bits", "_fingerprints", "_counts", "_last"]
_INDEX = "_shard int, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def hashed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(_block, _id, _text_hash, _numbers, _keys) of every row that has long lines: their numbers as 32 bits and their hashes as 128 bits each."""
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.xxhash64(text).alias("_text_hash"), F.col(text).cast("binary").alias("_text")).filter("_text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in slices(batch, "_text"):
                at, blocks, numbers, hashes = [], [], [], []
                for row, value in enumerate(part.column("_text").to_pylist()):
                    of, keys = long_lines(value, least_chars)
                    if of:
                        if held >= BLOCK_KEYS:
                            block, held = block + 1, 0
                        held += len(of)
                        at.append(row)
                        blocks.append(block)
                        numbers.append(np.array(of, np.uint32).tobytes())
                        hashes.append(b"".join([blake2b(k, digest_size=16).digest() for k in keys]))
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), part.column("_id").take(take), part.column("_text_hash").take(take),
                                                  pa.array(numbers, pa.binary()), pa.array(hashes, pa.binary())],
                                                 names=["_block", "_id", "_text_hash", "_numbers", "_keys"])

    return rows.mapInArrow(run, "_block long, _id long, _text_hash long, _numbers binary, _keys binary")


class _Block(NamedTuple):
    """The distinct hashes of some documents: in how many of them each is, and the largest id."""

    a: np.ndarray
    b: np.ndarray
    n: np.ndarray
    last: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Block]]:
    """Distinct hashes of the blocks of a task, from rows (_block, _id, _keys); a block whose rows are apart gives several."""
    for batch in batches:
        blocks = batch.column("_block").to_numpy()
        ids = batch.column("_id").fill_null(_NO_ID).to_numpy()
        keys = batch.column("_keys").to_pylist()
        edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)] if len(blocks) else []
        for first, end in zip(edges, edges[1:]):
            pairs = np.frombuffer(b"".join(keys[first:end]), _PAIR)
            row = np.repeat(np.arange(first, end), [len(k) // 16 for k in keys[first:end]])
            order = np.lexsort((row, pairs["b"], pairs["a"]))
            a, b, row = pairs["a"][order], pairs["b"][order], row[order]
            other = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            start = np.flatnonzero(other)
            once = other | np.concatenate([[True], row[1:] != row[:-1]])  # a document counts once
            yield int(blocks[first]), _Block(a[start], b[start], np.add.reduceat(once.astype(np.int64), start), np.maximum.reduceat(ids[row], start))


def line_counts(lines: DataFrame) -> DataFrame:
    """(_a, _b, _n, _last): every distinct hash with the number of its documents and the largest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x.a.view(np.int64)), pa.array(x.b.view(np.int64)), pa.array(x.n), pa.array(x.last)], names=["_a", "_b", "_n", "_last"])

    found = lines.select("_block", "_id", "_keys").mapInArrow(run, "_a long, _b long, _n long, _last long")
    return found.groupBy("_a", "_b").agg(F.sum("_n").alias("_n"), F.max("_last").alias("_last"))


def line_index(counts: DataFrame, shards: int, least_docs: int = LEAST_DOCS) -> DataFrame:
    """One row of arrays per shard of the distinct hashes."""
    if not 0 < least_docs < 1 << 16:
        raise ValueError("counts have 16 bits")

    def build(key: tuple, group: pa.Table) -> pa.Table:
        a, b, n, last = (group.column(c).to_numpy() for c in ("_a", "_b", "_n", "_last"))
        shard = Shard.of(a.view(np.uint64), b.view(np.uint64), n, last, least_docs)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), *[pa.array([x], pa.binary()) for x in shard.packed()]], names=["_shard", *_ARRAYS])

    return counts.withColumn("_shard", F.pmod("_a", F.lit(shards)).cast("int")).groupBy("_shard").applyInArrow(build, _INDEX)


def _probed(lines: DataFrame, index: DataFrame, shards: int, least_docs: int) -> DataFrame:
    """(_block, _hits, _last): the repeated hashes of every block with their largest ids."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in _blocks(batches):
            of = (x.a.view(np.int64) % shards).astype(np.int32)
            order = np.argsort(of, kind="stable")
            pairs = np.empty(len(of), _PAIR)
            pairs["a"], pairs["b"] = x.a[order], x.b[order]
            start = np.flatnonzero(np.concatenate([[True], np.diff(of[order]) != 0]))
            edges = [*start.tolist(), len(of)]
            yield pa.RecordBatch.from_arrays([pa.array(of[order][start]), pa.array(np.full(len(start), block)),
                                              pa.array([pairs[i:j].tobytes() for i, j in zip(edges, edges[1:])], pa.binary())], names=["_shard", "_block", "_keys"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = -1, None
        for batch in batches:
            blocks, hits, last = [], [], []
            for row in batch.to_pylist():
                if row["_kind"] == 0:
                    number, shard = row["_shard"], Shard.unpacked([row[c] for c in _ARRAYS], least_docs)
                elif row["_shard"] == number:
                    pairs = np.frombuffer(row["_keys"], _PAIR)
                    which, ids = shard.probe(pairs["a"], pairs["b"])
                    if len(which):
                        blocks.append(row["_block"])
                        hits.append(pairs[which].tobytes())
                        last.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(hits, pa.binary()), pa.array(last, pa.binary())], names=["_block", "_hits", "_last"])

    asked = lines.select("_block", "_id", "_keys").mapInArrow(sent, "_shard int, _block long, _keys binary")
    return streamed(index, asked, "_shard").mapInArrow(probe, "_block long, _hits binary, _last binary")


def _dropped(lines: DataFrame, hits: DataFrame) -> DataFrame:
    """(_id, _text_hash, _n, _gone) of every row that loses lines: how many, and a byte for each line up to the last of them, 1 if it goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, last_of = -1, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["_block"] != block:
                    block, last_of = row["_block"], {}
                if row["_kind"] == 0:
                    hashes = row["_hits"]
                    last_of.update(zip([hashes[i:i + 16] for i in range(0, len(hashes), 16)], np.frombuffer(row["_last"], np.int64).tolist()))
                elif last_of:
                    own = _NO_ID if row["_id"] is None else row["_id"]
                    hashes, of = row["_keys"], last_of.get
                    gone = [j for j, i in enumerate(range(0, len(hashes), 16)) if of(hashes[i:i + 16], own) > own]
                    if gone:
                        numbers = np.frombuffer(row["_numbers"], np.uint32)[gone]
                        mask = np.zeros(int(numbers[-1]) + 1, np.uint8)
                        mask[numbers] = 1
                        out.append((row["_id"], row["_text_hash"], len(gone), mask.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["_id", "_text_hash", "_n", "_gone"])

    return streamed(hits, lines, "_block").mapInArrow(run, "_id long, _text_hash long, _n long, _gone binary")


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The rows of the table without their repeated lines, with n_lines (before) and n_dropped."""
    lines = written(hashed_lines(docs, key, text, least_chars), "lines")
    counts = materialize(line_counts(lines), "line_counts")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, -(-counts.count() // SHARD_KEYS))
    index = written(line_index(counts, shards, least_docs), "line_index")
    hits = written(_probed(lines, index, shards, least_docs), "line_hits", 2_000)
    gone = written(_dropped(lines, hits), "lines_gone", 2_000)

    row_id, row_null, row_hash, lost, mask = free_names(docs, "_row_id", "_row_null", "_row_hash", "_lost", "_mask")
    # rows that repeat id and text lose the same lines
    asked = gone.select(F.coalesce("_id", F.lit(0)).alias(row_id), F.col("_id").isNull().alias(row_null), F.col("_text_hash").alias(row_hash),
                        F.col("_n").alias(lost), F.col("_gone").alias(mask)).dropDuplicates([row_id, row_null, row_hash])
    own = F.col(f"`{key}`").cast("long")
    kept = docs.drop("n_lines", "n_dropped")
    keyed = kept.withColumns({row_id: F.coalesce(own, F.lit(0)), row_null: own.isNull(), row_hash: F.xxhash64(text)})
    marked = lookup_join(keyed, materialize(asked, "lines_asked"), [row_id, row_null, row_hash])
    whole = F.coalesce(F.col(text), F.lit(""))
    left = F.filter(F.split(whole, "\n", -1), lambda line, i: F.substring(F.col(mask), i + 1, F.lit(1)) != F.lit(b"\x01"))
    return marked.withColumns({text: F.when(F.col(mask).isNull(), whole).otherwise(F.array_join(left, "\n")),
                               "n_lines": F.size(F.split(whole, "\n", -1)).cast("long"), "n_dropped": F.coalesce(F.col(lost), F.lit(0))}).select(*kept.columns, "n_lines", "n_dropped")


def line_digests(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))
