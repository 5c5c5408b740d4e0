"""Packing by concatenate and cut.

Pass one tokenizes every document once and writes its ids with the number of tokens before it in its partition. The totals
of the partitions, one small row each, give every partition its global offset. Pass two adds the offset and cuts the stream at
multiples of the sequence length: a document that crosses such a boundary becomes several pieces, each with its place.
Only the last sequence of the whole table is not full.

Defined cases: a null or empty text is the end token alone; a text that spells a special token holds that token's id; the order of the stream is that of the rows in the partitions; rows are
treated one by one, so repeated rows and null ids give pieces of their own; an empty table gives no pieces. Of the input's
columns only ``key`` and ``text`` are read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.batches import slices, written
from lexforge.llm.tokens import PieceEncoder
from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize

SEQUENCE = 4096
END = 2
SLICE = 4 << 20
PIECE_FIELDS = ["start long", "length long", "doc_tokens long", "sequence_id long", "offset long", "ids binary"]


def tokenized(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END, special: bool = True) -> DataFrame:
    """(key, block, before, doc_tokens, ids): ids as unsigned 16-bit numbers where the vocabulary allows it, else 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer, special)
        width = _width(max(encoder.tokenizer.get_vocab_size(), end + 1))
        block, before = TaskContext.get().partitionId(), 0
        mark = np.array([end], width).tobytes()
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                ids, offsets = encoder.encode(part.column("_text"))
                raw = ids.astype(width).tobytes()
                at = (offsets * np.dtype(width).itemsize).tolist()
                sizes = np.diff(offsets) + 1
                upto = before + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([
                    part.column("_key"), pa.array(np.full(part.num_rows, block), pa.int64()), pa.array(upto - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array([raw[a:b] + mark for a, b in zip(at, at[1:])], pa.binary()),
                ], names=["_key", "_block", "_before", "doc_tokens", "_ids"])
                before = int(upto[-1]) if len(upto) else before

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    fields = [T.StructField(n, T.LongType()) for n in ("_block", "_before", "doc_tokens")]
    return rows.mapInArrow(run, T.StructType([rows.schema["_key"], *fields, T.StructField("_ids", T.BinaryType())]))


def _width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end: int = END,
         special: bool = True) -> DataFrame:
    """One row per piece: key, start (tokens of its document before it), length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are unsigned 32-bit numbers, little end first. Strings of special tokens in a text are those tokens, as the tokenizer's file has it, or plain text if
    ``special`` is off.
    """
    table = written(tokenized(docs, tokenizer, key, text, end, special), "tokens")
    # one row per partition of the input: the table of their offsets is small, and its size is checked before it is sent
    totals = table.groupBy("_block").agg(F.sum("doc_tokens").alias("_total"))
    upto = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(totals.select("_block", F.coalesce(F.sum("_total").over(upto), F.lit(0)).alias("_base")), "bases")
    placed = lookup_join(table, bases, ["_block"], "inner").select("_key", (F.col("_base") + F.col("_before")).alias("_at"), "doc_tokens", "_ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_ids", SLICE):
                rows, starts, sizes, places, ids = [], [], [], [], []
                counts = part.column("doc_tokens").to_pylist()
                for row, (at, n, raw) in enumerate(zip(part.column("_at").to_pylist(), counts, part.column("_ids").to_pylist())):
                    values = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4").tobytes()
                    start = 0
                    while start < n:
                        size = min(n - start, sequence - (at + start) % sequence)
                        rows.append(row)
                        starts.append(start)
                        sizes.append(size)
                        places.append(at + start)
                        ids.append(values[4 * start:4 * (start + size)])
                        start += size
                place = np.array(places, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column("_key").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(np.array(counts, dtype=np.int64)[rows], pa.int64()), pa.array(place // sequence), pa.array(place % sequence),
                    pa.array(ids, pa.binary()),
                ], names=["_key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    fields = [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    pieces = placed.mapInArrow(cut, T.StructType([placed.schema["_key"], *fields, T.StructField("ids", T.BinaryType())]))
    return pieces.withColumnRenamed("_key", key)


def packed_sequences(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """One row per sequence: its ids, and the documents and offsets at which its pieces begin. A group holds one sequence."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return pieces.groupBy("sequence_id").agg(rows.alias("_p")).select(
        "sequence_id", F.col("_p.offset").alias("offsets"), F.col("_p.doc_id").alias("doc_ids"),
        F.expr("unhex(array_join(transform(_p, p -> hex(p.ids)), ''))").alias("ids"))


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
