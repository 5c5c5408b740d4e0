"""Periodic runs of words by recompression.

A run is a stretch of words with smallest period q, of ``least_exponent`` periods and ``least_length`` words or more, that no neighbouring word extends with that period.

1. A run of four periods holds four neighbours of every grid of step q, so the places of the grid where four words in a row are equal are the only
   candidates. All grids of a text together have n/1 + n/2 + ... places, so it takes n log n comparisons of words, done for many texts at once: texts are
   laid out by falling length, and a grid covers those only that are long enough.
2. Recompression turns the texts that hold candidates into a run-length grammar. Blocks of one symbol become a symbol, then every symbol is drawn to be a left or a
   right one and each left one followed by a right one becomes a symbol with it, and so on in turn until all symbols differ. Equal stretches are parsed
   equally but for their ends.
3. How far two places agree, forwards or backwards, is one climb and one descent in the grammar: a level compares one symbol of either place and either steps over the
   rest of its parent, or knows where within it the two differ. All candidates go through a level together.
4. The extension of a candidate in both directions is exact, so it is a run with period q or too short. A stretch found with several periods has the
   smallest. Steps come in doubling ranges; a candidate inside a known run whose period divides its step can't give another.

A text is treated whole, in memory in proportion to it: some 80 bytes a word where it holds candidates. Defined cases: a null or empty text, or one of white space alone,
has no words and no runs, and nothing is left of it; rows are treated one by one, so repeated rows and null ids give rows of their own; an empty table gives no rows;
of the input only ``key`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.batches import mix, no_collection, slices

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
SLICE = 2 << 20
RUNS = "array<struct<start: long, length: long, period: long>>"


class Level(NamedTuple):
    """The symbols of a level; ``first`` and ``parent`` lead to the next one and back. A parent is a block of one symbol or a pair."""

    symbols: np.ndarray
    first: np.ndarray
    parent: np.ndarray
    blocks: bool


def _renamed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the pairs of two arrays, equal for equal pairs."""
    return np.unique(left.astype(np.int64) * (int(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int32)


class Grammar:
    """The run-length grammar of a sequence whose first and last symbols occur once."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        current = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
        turn = 0
        while int(current.max(initial=-1)) + 1 < len(current):
            merges = self._blocks(current) if turn % 2 == 0 else self._pairs(current, turn)
            if merges.any():
                first = np.append(np.flatnonzero(~merges), len(current)).astype(np.int32)
                sizes = np.diff(first)
                self.levels.append(Level(current, first, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), turn % 2 == 0))
                begin = current[first[:-1]]
                # a block is told by its size, a pair by its second symbol
                current = _renamed(begin, sizes if turn % 2 == 0 else np.where(sizes == 2, current[first[1:] - 1] + 1, 0))
            turn += 1
        self.top = current

    @staticmethod
    def _blocks(x: np.ndarray) -> np.ndarray:
        """Symbols that join the one before them: equal ones."""
        return np.concatenate([[False], x[1:] == x[:-1]])

    @staticmethod
    def _pairs(x: np.ndarray, turn: int) -> np.ndarray:
        """Symbols that join the one before them: right ones after left ones."""
        kinds = mix(np.arange(int(x.max()) + 1, dtype=np.uint64) ^ (np.uint64(turn) << np.uint64(40))) >> np.uint64(63) == 1
        right = kinds[x]
        return np.concatenate([[False], right[1:] & ~right[:-1]])

    def agree(self, i: np.ndarray, j: np.ndarray, backwards: bool = False) -> np.ndarray:
        """How many symbols from i on and from j on are equal, both included; backwards, how many up to i and up to j. No i equals its j."""
        way = -1 if backwards else 1
        a, b, who = i.astype(np.int64), j.astype(np.int64), np.arange(len(i))
        stops: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for symbols, first, parent, blocks in self.levels:
            pa_, pb = parent[a].astype(np.int64), parent[b].astype(np.int64)
            rest_a = a - first[pa_] + 1 if backwards else first[pa_ + 1] - a
            rest_b = b - first[pb] + 1 if backwards else first[pb + 1] - b
            same = symbols[a] == symbols[b]
            up = same & (rest_a == rest_b)
            if not blocks:
                last = len(symbols) - 1
                up &= (rest_a == 1) | (symbols[np.clip(a + way, 0, last)] == symbols[np.clip(b + way, 0, last)])
            # places that are equal but whose parents end in different ways differ right behind
            step = np.where(same, np.minimum(rest_a, rest_b) if blocks else 1, 0)
            stay = ~up
            stops.append((who[stay], (a + way * step)[stay], (b + way * step)[stay]))
            a, b, who = pa_[up] + way, pb[up] + way, who[up]
        for level, (symbols, first, _, blocks) in zip(range(len(self.levels) - 1, -1, -1), reversed(self.levels)):
            size_a, size_b = first[a + 1] - first[a], first[b + 1] - first[b]
            a, b = (first[a + 1] - 1, first[b + 1] - 1) if backwards else (first[a], first[b])
            step = np.where(symbols[a] == symbols[b], np.minimum(size_a, size_b) if blocks else 1, 0)
            a, b = a + way * step, b + way * step
            who, a, b = (np.concatenate(x) for x in zip((who, a, b), stops[level]))
        out = np.empty(len(i), np.int64)
        out[who] = (a - i[who]) * way
        return out


def _candidates(symbols: np.ndarray, lengths: np.ndarray, least_length: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, steps) of grids at which ``least_exponent`` neighbours are equal, from texts laid out by falling length."""
    ends = np.cumsum(lengths)
    places, steps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    most = int(lengths[0]) // least_exponent if len(lengths) else 0
    # the texts that have room for a run of each step
    room = np.searchsorted(-lengths, -np.maximum(np.arange(1, most + 1) * least_exponent, least_length), side="right")
    for q, texts in enumerate(room.tolist(), 1):
        if texts == 0:
            break
        grid = symbols[:ends[texts - 1]:q]
        same = grid[1:] == grid[:-1]
        row = same
        for k in range(1, least_exponent - 1):
            row = row[:-1] & same[k:]
        at = np.flatnonzero(row)
        if len(at):
            places.append(at * q)
            steps.append(np.full(len(at), q))
    return np.concatenate(places), np.concatenate(steps)


def find_runs(texts: list[np.ndarray], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of the runs of several texts given as numbers of words, by text, start and period."""
    if least_exponent < 2:
        raise ValueError("a run has two periods or more")
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= max(least_length, least_exponent)]
    empty = np.zeros(0, np.int64)
    if not len(order):
        return empty, empty, empty, empty
    lengths = sizes[order]
    places, steps = _candidates(np.concatenate([texts[i] for i in order]), lengths, least_length, least_exponent)
    begins = np.cumsum(lengths) - lengths
    of = np.searchsorted(begins, places, side="right") - 1
    held = np.unique(of)
    if not len(held):
        return empty, empty, empty, empty
    # the texts with candidates, each between two symbols of its own
    ends = np.cumsum(lengths[held] + 1)
    moved = np.zeros(len(lengths), np.int64)
    moved[held] = ends - lengths[held]
    layout = np.empty(int(ends[-1]) + 1, np.int64)
    layout[np.concatenate([[0], ends])] = -1 - np.arange(len(held) + 1)
    for i, at in zip(held.tolist(), (ends - lengths[held]).tolist()):
        layout[at:at + lengths[i]] = texts[order[i]]
    grammar = Grammar(layout)
    places = places - begins[of] + moved[of]

    known_end, known_period = np.zeros(len(layout), np.int64), np.ones(len(layout), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    low = 1
    while low <= int(steps.max()):
        mine = (steps >= low) & (steps < 2 * low)
        at, q = places[mine], steps[mine]
        settled = (at + (least_exponent - 1) * q < known_end[at]) & (q % known_period[at] == 0)
        at, q = at[~settled], q[~settled]
        # neighbours of a text that it doesn't reach into are other texts: their ends keep them apart
        inside = at + q < len(layout)
        at, q = at[inside], q[inside]
        if len(at):
            start = at - grammar.agree(at - 1, at + q - 1, backwards=True)
            end = at + q + grammar.agree(at, at + q)
            long = end - start >= np.maximum(least_length, least_exponent * q)
            runs = np.unique(np.stack([start[long], end[long], q[long]]), axis=1)
            found.append(tuple(runs))
            for s, e, p in runs.T.tolist():
                part = known_end[s:e] < e
                known_end[s:e][part], known_period[s:e][part] = e, p
        low *= 2
    if not found:
        return empty, empty, empty, empty
    start, end, q = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((q, end, start))
    start, end, q = start[by], end[by], q[by]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])]) if len(start) else np.zeros(0, bool)
    start, end, q = start[least], end[least], q[least]
    which = np.searchsorted(ends, start, side="right")
    row = order[held[which]]
    at = start - (ends - lengths[held])[which]
    by = np.lexsort((q, at, row))
    return row[by], at[by], (end - start)[by], q[by]


def periodic_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document, told by the hash of its id, with a tail that repeats itself; the others unchanged."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    return words[:a] + words[a:a + p] * whole + words[a:a + rest]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT,
                  edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(key, runs, collapsed) of every row: runs by start and period, and the words joined by spaces without those that a run repeats.

    ``edit`` is applied to the words of each text before.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text"))

    def of(keys: list, values: list[bytes | None]) -> tuple[pa.Array, pa.Array]:
        words = [v.split() if v else [] for v in values]
        if edit:
            words = [edit(k, w) for k, w in zip(keys, words)]
        known: dict[bytes, int] = {}
        number = known.setdefault
        texts = [np.fromiter([number(w, len(known)) for w in ws], np.int32, len(ws)) for ws in words]
        row, start, length, period = find_runs(texts, least_length, least_exponent)
        offsets = np.searchsorted(row, np.arange(len(words) + 1))
        left = words
        for i in np.unique(row).tolist():
            kept = np.ones(len(words[i]), dtype=bool)
            for s, n, q in zip(*(x[offsets[i]:offsets[i + 1]].tolist() for x in (start, length, period))):
                kept[s + q:s + n] = False
            left[i] = [words[i][j] for j in np.flatnonzero(kept).tolist()]
        runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], names=["start", "length", "period"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), pa.array([b" ".join(w) for w in left], pa.binary()).cast(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                with no_collection():
                    runs, collapsed = of(part.column("_key").to_pylist(), part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("_key"), runs, collapsed], names=["_key", "runs", "collapsed"])

    found = rows.mapInArrow(run, T.StructType([rows.schema["_key"], *T.StructType.fromDDL(f"runs {RUNS}, collapsed string").fields]))
    return found.withColumnRenamed("_key", key)


def _greatest(runs: Column) -> Column:
    """The run with the greatest length in periods; of equals the first."""
    def larger(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.reduce(runs, F.get(runs, F.lit(0)), larger)


def run_digests(found: DataFrame) -> DataFrame:
    """Per document: the number of runs, the greatest, and digests of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("_best", _greatest(F.col("runs")))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
                       F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
