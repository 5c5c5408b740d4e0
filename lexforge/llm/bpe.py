"""Byte-level BPE by corpus-level merge replay.

A task gathers the distinct words of its texts, lays their bytes out in one array, and keeps an inverted index from the rank of
a token pair to the positions that hold it. Merges are applied in rank order, each to all its positions at once; only the
neighbours of a merged position are looked up again. Every word is encoded once however often it occurs, and word lists do not leave
the task, so nothing is shuffled. Words already known to the task are kept, up to ``KEPT_WORDS``; beyond that the task
starts a new list, which costs time only.

The rank file is read on the executors at ``vocabulary``, a path that must exist there. Defined cases: a null or empty text has no ids
and decodes to no bytes; rows are treated one by one, so repeated rows and null ids give rows of their own; a column of
the input named like a result column is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.batches import no_collection, slices

KEPT_WORDS = 400_000
SLICE = 8 << 20
_NONE = np.int64(1 << 40)


class Merges:
    """The pairs of a rank file: two tokens merge when their bytes together are a token; its rank is the pair's rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.width = len(self.tokens)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = rank
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys, self.ranks = keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.int64)
        # then a merge never gives a pair of its own or a lower rank, and all positions of a rank merge at once
        self.ordered = bool((self.ranks > np.maximum(keys // self.width, keys % self.width)).all())
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.whole = ranks
        lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.token_starts, self.token_sizes = np.cumsum(lengths) - lengths, lengths
        self.token_bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or _NONE; a negative token is the end of a word."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.ranks[at], _NONE)


@lru_cache(maxsize=4)
def load_merges(path: str) -> Merges:
    with open(path, "rb") as f:
        return Merges({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())})


def replay(merges: Merges, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of words: offsets[i]:offsets[i+1] are the ids of word i."""
    raw = np.frombuffer(b"".join(words), dtype=np.uint8)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    n = len(raw) + len(words)
    token = np.full(n + 1, -1, dtype=np.int64)  # one end mark after each word, and one in front of the first at place -1
    inner = np.ones(n + 1, dtype=bool)
    inner[starts + sizes] = False
    inner[n] = False
    token[inner] = merges.byte_ids[raw]
    after = np.arange(1, n + 2)
    before = np.arange(-1, n)
    rank = np.full(n + 1, _NONE, dtype=np.int64)
    rank[:n] = merges.rank_of(token[:n], token[1:])

    # the inverted index: rank -> positions, and the ranks in a heap
    index: dict[int, list[np.ndarray]] = defaultdict(list)

    def note(positions: np.ndarray) -> None:
        """Enter positions whose rank was just found."""
        of = rank[positions]
        order = np.argsort(of, kind="stable")
        positions, of = positions[order], of[order]
        positions, of = positions[: np.searchsorted(of, _NONE)], of[: np.searchsorted(of, _NONE)]
        if not len(of):
            return
        cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
        heads = of[np.concatenate([[0], cuts])].tolist()
        edges = [0, *cuts.tolist(), len(of)]
        for i, r in enumerate(heads):
            if r not in index:
                heapq.heappush(heap, r)
            index[r].append(positions[edges[i]:edges[i + 1]])

    heap: list[int] = []
    note(np.flatnonzero(rank < _NONE))
    while heap:
        r = heapq.heappop(heap)
        found = index.pop(r)
        at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        at = at[rank[at] == r]
        if not len(at):
            continue
        at = np.sort(at)
        if not merges.ordered:
            # the leftmost of each word; it may give a lower rank, which goes before the others
            word = np.searchsorted(starts, at, side="right")
            leftmost = np.concatenate([[True], word[1:] != word[:-1]])
            at, later = at[leftmost], at[~leftmost]
            note(later)
        # of pairs that share a token the leftmost merges: every other one of a run
        tied = np.concatenate([[False], after[at[:-1]] == at[1:]])
        if tied.any():
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(tied, 0, place))) % 2 == 0]
        gone = after[at]
        behind = after[gone]
        token[at] = r
        token[gone] = -2
        rank[gone] = _NONE
        after[at] = behind
        before[behind] = at
        touched = np.concatenate([at, before[at]])
        touched = np.unique(touched[touched >= 0])
        touched = touched[token[touched] >= 0]
        rank[touched] = merges.rank_of(token[touched], token[after[touched]])
        note(touched)
    kept = token >= 0
    ids = token[kept].astype(np.int32)
    upto = np.concatenate([[0], np.cumsum(kept)])
    return ids, np.concatenate([upto[starts], [len(ids)]])


class Encoder:
    """Encodes texts of one task; distinct words are replayed together, once."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.split = merges, regex.compile(pattern).findall
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if not new:
            return
        ids, offsets = replay(self.merges, [w.encode() for w in new])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.offsets = np.concatenate([self.offsets, offsets[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    @no_collection()
    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): offsets[i]:offsets[i+1] are the ids of text i."""
        if len(self.known) > KEPT_WORDS:
            self.reset()
        parts = [self.split(t) if t else [] for t in texts]
        self.learn(set().union(*parts))
        counts = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        known = self.known
        places = np.array(list(map(known.__getitem__, chain.from_iterable(parts))), dtype=np.int64)
        return gather(self.ids, self.offsets, places, counts)


def gather(items: np.ndarray, offsets: np.ndarray, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join the lists ``items[offsets[p]:offsets[p + 1]]`` of all places p; counts says how many places each row has."""
    sizes = offsets[places + 1] - offsets[places]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(upto[-1]) + np.repeat(offsets[places] - upto[:-1], sizes)
    return items[at], upto[np.concatenate([[0], np.cumsum(counts)])]


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids of ``text`` as an array; ``vocabulary`` is a file of ranks, ``pattern`` what splits a text into words."""
    kept = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_merges(vocabulary), pattern)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                ids, offsets = encoder.encode(part.column(text).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes of the ids; a null list gives no bytes."""
    kept = encoded.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load_merges(vocabulary)
        token_ends = np.concatenate([merges.token_starts, [len(merges.token_bytes)]])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(ids).fill_null([]) if part.column(ids).null_count else part.column(ids)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                raw, offsets = gather(merges.token_bytes, token_ends, flat, counts)
                whole = raw.tobytes()
                values = [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.binary())], names=[*part.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.BinaryType())]))


def bpe_digests(decoded: DataFrame) -> DataFrame:
    """Per document: the number of ids, and digests of the ids and of the decoded bytes."""
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
