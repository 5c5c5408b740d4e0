"""Alignment of two tokenizers over the same texts.

Side A encodes a space and the text by a byte-level tokenizer, side B the text by a piece model that adds the space itself, so both cut the same bytes.

1. In every slice of texts the tokens of both sides become tables of (document, first byte). ``merge_asof`` finds for each token the one of the other side that covers its
   first byte; the union of both directions is all pairs of tokens that overlap. Bytes at which tokens of both sides end cut the tokens into groups.
2. Of each document its distinct id pairs are written with their number, not its links: a fifth of them. Blocks of documents count in how many of them a pair is,
   and Spark adds up the blocks. The partner that most documents link with an A id is found in a window of one A id, which holds no more rows than B has ids.
3. The counts go back to the blocks that hold the pair, and every document looks its pairs up in the counts of its block, which are bounded by the block's text.

Defined cases: a null or empty text, and one of which a side doesn't give back every byte (bytes that a model normalises), has no tokens, no groups and an empty string in place of them; every
row counts as a document, repeated rows and null ids included; an empty table gives no rows; strings of special tokens in a text are plain text; of the input
only ``key`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.batches import no_collection, slices, streamed, text_buffer, written
from lexforge.llm.bpe import gather
from lexforge.llm.tokens import byte_letters
from lexforge.operators.materialize import materialize

SLICE = 1 << 20
#: bytes of text of a block, at most about
BLOCK = 16 << 20
_SPACE_PIECE = "▁"


class Side(NamedTuple):
    """The bytes of each token: those of id i are bytes[offsets[i]:offsets[i + 1]]."""

    encode: object
    bytes: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, encode, tokens: list[bytes]) -> Side:
        return cls(encode, np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])]))

    @property
    def size(self) -> int:
        return len(self.offsets) - 1


#: the pattern by which byte-level tokenizers split a text
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _by_ranks(path: str, tokens: list[bytes]):
    """An encoder that looks up ranks, or None where the file's merges aren't in the order of its ids or it does more than to split and merge.

    It is three times as fast. Both split letters from other signs by Unicode's tables, whose versions may differ, so it is for texts below U+0100 alone.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    model, vocab = found["model"], found["model"]["vocab"]
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if (model.get("dropout") or found.get("normalizer") or (found["pre_tokenizer"] or {}) | plain != found["pre_tokenizer"]
            or [vocab[m] for m in merges] != list(range(256, 256 + len(merges)))):
        return None
    return tiktoken.Encoding("side", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens[:256 + len(merges)])}, special_tokens={})


@lru_cache(maxsize=2)
def byte_side(path: str) -> Side:
    """A tokenizer file whose tokens spell bytes as letters; it encodes a space and the text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    tokens = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab().items():
        tokens[number] = bytes([byte_of[c] for c in token]) if all(c in byte_of for c in token) else token.encode()
    ranks = _by_ranks(path, tokens)

    def latin(text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return ranks is not None

    def encode(texts: list[str]) -> list[list[int]]:
        out = [ranks.encode_ordinary(" " + t) if latin(t) else None for t in texts]
        others = [i for i, found in enumerate(out) if found is None]
        for i, found in zip(others, tokenizer.encode_batch_fast([" " + texts[i] for i in others], add_special_tokens=False)):
            out[i] = found.ids
        return out

    return Side.of(encode, tokens)


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    """A piece model with byte pieces; it adds the space before a text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_SPACE_PIECE, " ").encode() for i, p in enumerate(pieces)]
    return Side.of(lambda texts: model.encode(texts, num_threads=1), tokens)


class Tokens(NamedTuple):
    """The tokens of several texts one after the other: id, text, first byte and the byte after the last, counted over all texts."""

    ids: np.ndarray
    doc: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, side: Side, lists: list[list[int]], raw: np.ndarray, offsets: np.ndarray) -> tuple[Tokens, np.ndarray]:
        """The tokens, and for each text whether their bytes are the text's."""
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum()))
        spelled, ends_of = gather(side.bytes, side.offsets, ids, counts)
        good = np.diff(ends_of) == np.diff(offsets)
        if good.all():
            other = np.flatnonzero(spelled != raw)
            good[np.searchsorted(offsets, other, side="right") - 1] = False
        else:
            for i in np.flatnonzero(good).tolist():
                good[i] = np.array_equal(spelled[ends_of[i]:ends_of[i + 1]], raw[offsets[i]:offsets[i + 1]])
        doc = np.repeat(np.arange(len(lists)), counts)
        sizes = np.diff(side.offsets)[ids]
        ends = np.cumsum(sizes) + (offsets[:-1] - ends_of[:-1])[doc]
        return cls(ids, doc, ends - sizes, ends), good

    def only(self, good: np.ndarray) -> Tokens:
        kept = good[self.doc]
        return Tokens(*[x[kept] for x in self])


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(places in a, places in b) of all pairs of tokens whose bytes overlap, each once."""
    left = pd.DataFrame({"doc": a.doc, "at": a.starts, "i": np.arange(len(a.doc))})
    right = pd.DataFrame({"doc": b.doc, "at": b.starts, "j": np.arange(len(b.doc))})
    from_a = pd.merge_asof(left, right, on="at", by="doc")
    from_b = pd.merge_asof(right, left, on="at", by="doc")
    # tokens that start at the same byte find each other from both sides
    i, j = from_b["i"].to_numpy(), from_b["j"].to_numpy()
    apart = a.starts[i] != b.starts[j]
    return np.concatenate([from_a["i"].to_numpy(), i[apart]]), np.concatenate([from_a["j"].to_numpy(), j[apart]])


_ENDINGS = (b",", b"|", b";", b"")


@lru_cache(maxsize=1)
def _spelled_ids(n: int) -> pa.Array:
    """The decimal id with each ending, four to an id."""
    return pa.array([b"%d%s" % (i, end) for i in range(n) for end in _ENDINGS], pa.large_binary())


def grouped(a: Tokens, b: Tokens, n: int, size: int) -> tuple[np.ndarray, list[bytes]]:
    """(number of groups, groups) of each of n texts; groups are ``a1,a2|b1;a3|b2,b3``."""
    cuts = np.intersect1d(a.ends, b.ends, assume_unique=True)
    upto_a, upto_b = np.searchsorted(a.ends, cuts, side="right"), np.searchsorted(b.ends, cuts, side="right")
    group_a, group_b = np.searchsorted(cuts, a.ends), np.searchsorted(cuts, b.ends)
    codes = np.empty(len(a.ids) + len(b.ids), np.int64)
    # an A token comes after the B tokens of all groups before, a B token after the A tokens of its own group too
    codes[np.arange(len(a.ids)) + np.concatenate([[0], upto_b])[group_a]] = a.ids * 4 + (a.ends == cuts[group_a])
    last = np.concatenate([b.doc[1:] != b.doc[:-1], [True]]) if len(b.doc) else np.zeros(0, bool)
    ending = np.where(last, 3, np.where(b.ends == cuts[group_b], 2, 0))
    codes[np.arange(len(b.ids)) + upto_a[group_b]] = b.ids * 4 + ending
    edges = np.searchsorted(a.doc, np.arange(n + 1)) + np.searchsorted(b.doc, np.arange(n + 1))
    # one array of strings holds them one after the other
    spelled = _spelled_ids(size).take(pa.array(codes))
    upto = np.frombuffer(spelled.buffers()[1], np.int64, len(codes) + 1)[edges].tolist() if len(codes) else [0] * (n + 1)
    whole = (spelled.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    texts = [whole[i:j] for i, j in zip(upto, upto[1:])]
    at = b.doc[upto_b - 1] if len(cuts) else np.zeros(0, np.int64)
    return np.bincount(at, minlength=n), texts


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(docs: DataFrame, byte_tokenizer: str, piece_model: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(_block, key, n_a, n_b, n_groups, n_links, groups, _pairs, _times) of every row: groups as text, or as the SHA-256 of it.

    ``_pairs`` are the distinct id pairs as 64 bits, A's id times the size of B and B's id; ``_times`` says how often each is linked.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def of(texts: pa.Array) -> list[pa.Array]:
        a_side, b_side = byte_side(byte_tokenizer), piece_side(piece_model)
        given = texts.fill_null("").to_pylist()
        n = len(given)
        raw, offsets = text_buffer(pa.array([" " + t for t in given]))
        some = np.fromiter(map(bool, given), bool, n)
        a, good_a = Tokens.of(a_side, a_side.encode(given), raw, offsets)
        b, good_b = Tokens.of(b_side, b_side.encode(given), raw, offsets)
        good = some & good_a & good_b
        a, b = a.only(good), b.only(good)
        n_groups, groups = grouped(a, b, n, max(a_side.size, b_side.size))
        i, j = overlaps(a, b)
        # a text's pairs by number, all texts in one sort
        wide = a_side.size * b_side.size
        held, times = np.unique(a.doc[i] * wide + a.ids[i] * b_side.size + b.ids[j], return_counts=True)
        edges = np.searchsorted(held // wide, np.arange(n + 1)).tolist()
        pairs, times = (held % wide).tobytes(), times.astype(np.uint32).tobytes()
        if digest:
            groups = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
        else:
            groups = [g.decode() for g in groups]
        return [pa.array(x, pa.int64()) for x in (np.bincount(a.doc, minlength=n), np.bincount(b.doc, minlength=n), n_groups, np.bincount(a.doc[i], minlength=n))] + [
            pa.array(groups, pa.string()), pa.array([pairs[8 * p:8 * q] for p, q in zip(edges, edges[1:])], pa.binary()),
            pa.array([times[4 * p:4 * q] for p, q in zip(edges, edges[1:])], pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                if held > BLOCK:
                    block, held = block + 1, 0
                held += part.column("_text").nbytes
                with no_collection():
                    columns = of(part.column("_text"))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, block)), part.column("_key"), *columns],
                                                 names=["_block", "_key", *_COUNTS, "groups", "_pairs", "_times"])

    fields = [T.StructField("_block", T.LongType()), rows.schema["_key"], *[T.StructField(c, T.LongType()) for c in _COUNTS],
              T.StructField("groups", T.StringType()), T.StructField("_pairs", T.BinaryType()), T.StructField("_times", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType(fields))


def pair_counts(found: DataFrame) -> DataFrame:
    """(_block, _pair, _n): the distinct id pairs of every block, and how many of its documents hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, lists = batch.column("_block").to_numpy(), batch.column("_pairs").to_pylist()
            for block in np.unique(blocks).tolist():
                # a document holds a pair once, so this counts documents
                pairs, n = np.unique(np.frombuffer(b"".join([lists[i] for i in np.flatnonzero(blocks == block).tolist()]), np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(n)], names=["_block", "_pair", "_n"])

    rows = found.select("_block", "_pairs").mapInArrow(run, "_block long, _pair long, _n long")
    return rows.groupBy("_block", "_pair").agg(F.sum("_n").alias("_n"))


def align(docs: DataFrame, byte_tokenizer: str, piece_model: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every row.

    The count of a link is the number of documents in which its two ids are linked; n_best are the links whose count is the highest of their A id.
    """
    found = written(aligned(docs, byte_tokenizer, piece_model, key, text, digest), "aligned")
    entries = materialize(pair_counts(found), "pairs")
    size = piece_side(piece_model).size
    counts = entries.groupBy("_pair").agg(F.sum("_n").alias("_count"))
    # the rows of an A id are B's ids at most
    counts = counts.withColumn("_best", F.col("_count") == F.max("_count").over(Window.partitionBy(F.floor(F.col("_pair") / size))))
    counts = materialize(counts, "counts")
    known = entries.join(counts, "_pair").groupBy("_block").agg(F.collect_list(F.struct("_pair", "_count", "_best")).alias("_known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pairs, counted, best = -1, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            sums = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("_kind", "_block", "_pairs", "_times")))
            for at, (kind, of, held, times) in enumerate(rows):
                if kind == 0:
                    known = batch.column("_known").slice(at, 1).flatten()
                    block = of
                    pairs, counted, best = (known.field(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in ("_pair", "_count", "_best"))
                    order = np.argsort(pairs)
                    pairs, counted, best = pairs[order], counted[order], best[order]
                elif held:
                    if of != block:
                        raise ValueError("a block without counts")
                    place = np.searchsorted(pairs, np.frombuffer(held, np.int64))
                    n = np.frombuffer(times, np.uint32).astype(np.int64)
                    sums.append((int((n * best[place]).sum()), int((n * counted[place]).sum())))
                else:
                    sums.append((0, 0))
            documents = batch.filter(pc.equal(batch.column("_kind"), 1))
            yield pa.RecordBatch.from_arrays([*[documents.column(c) for c in ("_key", *_COUNTS, "groups")], *[pa.array([s[k] for s in sums], pa.int64()) for k in (0, 1)]],
                                             names=["_key", *_COUNTS, "groups", "n_best", "count_sum"])

    fields = [f for f in found.schema.fields if f.name in ("_key", *_COUNTS, "groups")]
    out = streamed(known, found, "_block").mapInArrow(run, T.StructType([*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]))
    return out.withColumnRenamed("_key", key)
