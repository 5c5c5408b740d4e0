"""Similarity join of documents by their n-gram sets: a blocked sparse product of document by n-gram incidence.

A set holds the distinct 5-word shingles of a text as 64-bit hashes. Two documents link when ``100 * |A & B| >= 75 * |A | B|``.

1. Sets with equal digests collapse: documents with the same set are one node.
2. A sketch of fixed size counts in how many sets the shingles of each of ``CELLS`` cells occur. Shingles of crowded cells come last in the
   order of columns. The order decides only which columns are multiplied, never what links.
3. A linked pair has ``ceil(0.75 n)`` shingles or more in common, so it meets in the first ``n - ceil(0.75 n) + 1`` columns of either
   set. Only these entries of the incidence matrix are shuffled, and columns with one entry go at once.
4. Products are summed per pair. A pair is discarded when its overlap so far and all that may follow stay below the overlap that its two
   sizes ask for; the others are compared by their whole sets. The same bound, with the columns that a node shares with anyone, keeps
   most of the entries of a crowded column apart before they meet.
5. Columns are blocked so that a group of thousands of near copies doesn't give all its pairs: two rounds pair each entry with one pivot of its
   column; their links give components; then only entries of different components meet in a column, and all of those do.
   So no link between different components is lost, and pairs inside one are not needed.

Defined cases: a null or empty text, or one of white space alone, has size 0 and links with nothing; a text of fewer words is one shingle of all of
them; a row with a null id has no component and links with nothing; rows that repeat an id are compared by their own texts, each in the
component of its own text, and those with one set share a node; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.llm.batches import SHINGLE, distinct_sorted, row_numbers, saved, shingles, slices, words, written
from lexforge.llm.components import components
from lexforge.operators.joins import fits_broadcast, lookup_join
from lexforge.operators.materialize import materialize, own_work_tables, work_path

PERCENT = 75
CELL_BITS = 20
CELLS = 1 << CELL_BITS
STRIPES = 64
STRIPE = CELLS // STRIPES
SEEN_SETS = 1 << 18
STAR_ROUNDS = 2


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The fewest shingles that a set of n shares with any set that it links with."""
    return -(-percent * n // 100)


def _sets(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_sorted(*shingles(words(part.column("_text")), size))


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


_ROW = "_id long, _hash long, n_shingles long, _digest binary, _mark long, _stripe int, _counts binary"


def _marks(digests: list[bytes | None]) -> pa.Array:
    """The first half of each digest as a number."""
    return pa.array([None if d is None else int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64())


def _digests(values: np.ndarray, rows: np.ndarray) -> list[bytes | None]:
    edges = rows.tolist()
    return [_digest(values[a:b]) if b > a else None for a, b in zip(edges, edges[1:])]


def _described(docs: DataFrame, size: int) -> DataFrame:
    """A row with size, digest and a number made of it for each document; and from each task, the counts of its cells in stripes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.uint32)
        names = ["_id", "_hash", "n_shingles", "_digest", "_mark", "_stripe", "_counts"]
        for batch in batches:
            for part in slices(batch, "_text"):
                values, rows = _sets(part, size)
                counts += np.bincount((values >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=CELLS).astype(np.uint32)
                digests = _digests(values, rows)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_hash"), pa.array(np.diff(rows)), pa.array(digests, pa.binary()), _marks(digests),
                                                  pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        found = [i for i in range(STRIPES) if counts[i * STRIPE:(i + 1) * STRIPE].any()]
        packed = [zlib.compress(counts[i * STRIPE:(i + 1) * STRIPE].tobytes(), 1) for i in found]
        n = len(found)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
                                          pa.array(found, pa.int32()), pa.array(packed, pa.binary())], names=names)

    return docs.mapInArrow(run, _ROW)


def crowded_cells(counts: DataFrame) -> np.ndarray:
    """A flag for each cell that holds far more sets than the mean cell: a table of fixed size, whatever the corpus.

    Stripes are summed on the executors, one at a time; a flag per cell comes to the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for stripe, packed in zip(batch.column("_stripe").to_pylist(), batch.column("_counts").to_pylist()):
                sums.setdefault(stripe, np.zeros(STRIPE, np.uint64))
                sums[stripe] += np.frombuffer(zlib.decompress(packed), np.uint32)
        for stripe, total in sums.items():
            mean = total.mean()
            flags = np.packbits(total > mean + 10 * np.sqrt(mean) + 64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([stripe], pa.int32()), pa.array([flags], pa.binary())], names=["_stripe", "_flags"])

    rows = counts.repartition(STRIPES, "_stripe").mapInArrow(run, "_stripe int, _flags binary").collect()
    crowded = np.zeros(CELLS, dtype=bool)
    for stripe, flags in rows:
        crowded[stripe * STRIPE:(stripe + 1) * STRIPE] = np.unpackbits(np.frombuffer(flags, np.uint8)).astype(bool)
    return crowded


def _entries(docs: DataFrame, crowded: np.ndarray, size: int, percent: int) -> DataFrame:
    """(_h, _node, _n): the entries of the incidence matrix in the columns where links of a document must meet.

    A task gives the entries of equal sets once as long as it remembers them.
    """
    flags = np.packbits(crowded).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.unpackbits(np.frombuffer(flags, np.uint8)).astype(bool)
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, "_text"):
                values, rows = _sets(part, size)
                edges = rows.tolist()
                kept = np.zeros(part.num_rows, dtype=bool)
                for i, (a, b) in enumerate(zip(edges, edges[1:])):
                    if b > a and (d := _digest(values[a:b])) not in seen:
                        seen.add(d)
                        kept[i] = True
                if len(seen) > SEEN_SETS:
                    seen.clear()
                owner = row_numbers(rows)
                order = np.lexsort((last[(values >> np.uint64(64 - CELL_BITS)).astype(np.int64)], owner))
                values = values[order]  # sorted by (crowded, hash) inside each document
                n = np.diff(rows)
                wanted = np.where(kept, n - least_overlap(n, percent) + 1, 0)
                mine = np.arange(len(values)) - rows[owner] < wanted[owner]
                ids = part.column("_node").take(pa.array(owner[mine]))
                yield pa.RecordBatch.from_arrays([pa.array(values[mine].view(np.int64)), ids, pa.array(n[owner[mine]])], names=["_h", "_node", "_n"])

    return docs.mapInArrow(run, "_h long, _node long, _n long")


def _shared(entries: DataFrame) -> DataFrame:
    """Entries of columns that hold two or more, by one pass over sorted rows; nothing is held but the row before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, again = None, False  # the last row, and whether its column came before
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            h = rows.column("_h").to_numpy()
            same = h[1:] == h[:-1]
            kept = np.concatenate([[again if held is not None else False], same]) | np.concatenate([same, [False]])
            again = bool(kept[-1])
            held = rows.slice(rows.num_rows - 1)
            yield rows.slice(0, rows.num_rows - 1).filter(pa.array(kept[:-1]))
        if held is not None and again:
            yield held

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(parts, "_h").sortWithinPartitions("_h").mapInArrow(run, "_h long, _node long, _n long")


def _need(a: Column, b: Column, percent: int) -> Column:
    """The fewest columns in which two sets of these sizes must have met if they link.

    They share ceil(p / (100 + p) * (a + b)) shingles or more; those that are not seen lie behind the columns of the larger set.
    """
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent)) - F.ceil(F.lit(percent) * F.greatest(a, b) / 100) + 1


def _alike(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _counted(products: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs whose summed products leave a link possible."""
    summed = products.groupBy("a", "b").agg(F.count("*").alias("_seen"), F.max("_na").alias("_na"), F.max("_nb").alias("_nb"))
    na, nb = F.col("_na"), F.col("_nb")
    return summed.filter(_alike(na, nb, percent) & (F.col("_seen") >= _need(na, nb, percent))).select("a", "b")


def _star_products(cells: DataFrame, turn: int) -> DataFrame:
    """Each entry with the pivot of its column.

    At first that is the node that shares the largest part of its columns with others, the middle of a group of near copies; then the
    node with the smallest hash of the round.
    """
    rank = -F.col("_s") / F.col("_n") if turn == 0 else F.lit(0.0)
    order = [rank.alias("_r"), F.xxhash64(F.lit(turn), "_node").alias("_p"), F.col("_node").alias("b"), F.col("_n").alias("_nb")]
    pivots = cells.groupBy("_h").agg(F.min(F.struct(*order)).alias("_f")).select("_h", "_f.b", "_f._nb")
    met = cells.join(pivots, "_h").filter("_node <> b")
    first = F.col("_node") < F.col("b")
    return met.select(F.least("_node", "b").alias("a"), F.greatest("_node", "b").alias("b"),
                      F.when(first, F.col("_n")).otherwise(F.col("_nb")).alias("_na"), F.when(first, F.col("_nb")).otherwise(F.col("_n")).alias("_nb"))


def _cross_products(cells: DataFrame, percent: int) -> DataFrame:
    """Entries of one column that lie in different components and whose sizes and shared columns leave a link possible.

    No pair shares more columns than either node shares with anyone (_s). Sizes of a column meet first, then components, then entries;
    each step keeps what some partner still needs.
    """
    sizes = cells.groupBy("_h", "_n").agg(F.max("_s").alias("_top"), F.min("_c").alias("_low"), F.max("_c").alias("_high"))
    others = sizes.toDF("_h", "_m", "_top2", "_low2", "_high2")
    need = _need(F.col("_n"), F.col("_m"), percent)
    several = F.least("_low", "_low2") < F.greatest("_high", "_high2")
    fits = _alike(F.col("_n"), F.col("_m"), percent) & (need <= F.least("_top", "_top2")) & several
    least = sizes.join(others, "_h").filter(fits).groupBy("_h", "_n").agg(F.min(need).alias("_least"))
    alive = materialize(cells.join(least, ["_h", "_n"]).filter("_s >= _least").drop("_least"), "alive")

    classes = materialize(alive.groupBy("_h", "_n", "_c").agg(F.max("_s").alias("_top")), "classes")
    facing = classes.toDF("_h", "_m", "_d", "_top2")
    pairs = classes.join(facing, "_h").filter((F.col("_c") < F.col("_d")) & _alike(F.col("_n"), F.col("_m"), percent)
                                              & (need <= F.least("_top", "_top2"))).select("_h", "_n", "_c", "_m", "_d", need.alias("_need"))
    left = alive.select("_h", "_n", "_c", F.col("_node").alias("_x"), F.col("_s").alias("_sx"))
    right = alive.select("_h", F.col("_n").alias("_m"), F.col("_c").alias("_d"), F.col("_node").alias("_y"), F.col("_s").alias("_sy"))
    met = pairs.join(left, ["_h", "_n", "_c"]).filter("_sx >= _need").join(right, ["_h", "_m", "_d"]).filter("_sy >= _need")
    first = F.col("_x") < F.col("_y")
    return met.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"),
                      F.when(first, F.col("_n")).otherwise(F.col("_m")).alias("_na"), F.when(first, F.col("_m")).otherwise(F.col("_n")).alias("_nb"))


def _verified(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose whole sets link."""
    needed = materialize(pairs.select("a").union(pairs.select("b")).distinct().toDF("_node"), "needed")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                values, rows = _sets(part, size)
                sets = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("_node"), sets], names=["_node", "_set"])

    sets = written(lookup_join(docs, needed, ["_node"], "inner").select("_node", "_text").mapInArrow(hashed, "_node long, _set array<long>"), "sets")
    with_sets = pairs.join(sets.toDF("a", "_sa"), "a").join(sets.toDF("b", "_sb"), "b")
    both = F.size(F.array_intersect("_sa", "_sb"))
    return with_sets.filter(100 * both >= percent * (F.size("_sa") + F.size("_sb") - both)).select("a", "b").distinct()


def _by_their_marks(docs: DataFrame, size: int) -> DataFrame:
    """Rows with ``_node``, the number made of their set's digest; those with an empty set go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                marks = _marks(_digests(*_sets(part, size)))
                yield pa.RecordBatch.from_arrays([marks, part.column("_text")], names=["_node", "_text"]).filter(marks.is_valid())

    return docs.select("_text").mapInArrow(run, "_node long, _text string")


def _grouped(docs: DataFrame, key: str, text: str, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The groups of linked rows as a written table; the work tables it is made from are deleted."""
    path = work_path(docs.sparkSession, "grouped")
    with own_work_tables(docs.sparkSession):
        return saved(_linked(docs, key, text, size, percent), path)


def _linked(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """(_id, _hash, n_shingles, _group, component_id) for every row: rows of one group are linked, directly or by others.

    A set is known by the smallest id that holds it, unless that id holds several sets: then each of these is known by its own digest.
    """
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    described = written(_described(rows.select("_id", F.xxhash64("_text").alias("_hash"), "_text"), size), "described")
    crowded = crowded_cells(described.filter("_stripe is not null").select("_stripe", "_counts"))
    listed = described.filter("_stripe is null").select("_id", "_hash", "n_shingles", "_digest", "_mark")
    held = listed.filter("_id is not null and _digest is not null")
    shared = held.groupBy("_id").agg((F.min("_digest") != F.max("_digest")).alias("_shared")).filter("_shared")
    shared = materialize(shared, "shared_ids")
    given = rows.filter("_id is not null").withColumn("_node", F.col("_id"))
    if shared.isEmpty():
        listed = listed.withColumn("_node", F.col("_id"))
    else:
        listed = lookup_join(listed, shared, ["_id"]).withColumn("_node", F.when(F.col("_shared"), F.col("_mark")).otherwise(F.col("_id"))).drop("_shared")
        marked = lookup_join(given, shared, ["_id"])
        given = written(marked.filter("_shared is null").select("_node", "_text").unionByName(_by_their_marks(marked.filter("_shared"), size)), "given", 200)
    # equal sets are one node
    copies = listed.filter("_id is not null and _digest is not null").groupBy("_digest").agg(
        F.min("_node").alias("_rep"), F.min("_id").alias("_least"), F.count("*").alias("_k"))
    copies = materialize(copies.filter("_k > 1").drop("_k"), "copies")
    named = lookup_join(listed, copies, ["_digest"]).select(
        "_id", "_hash", "n_shingles", "_node", F.when(F.col("_id").isNotNull(), F.coalesce("_rep", "_node")).alias("_rep"),
        F.when(F.col("_id").isNotNull(), F.coalesce("_least", "_id")).alias("_least"))
    named = materialize(named, "named")

    cells = written(_shared(_entries(given, crowded, size, percent)), "cells", 4_000)
    renamed = named.filter("n_shingles > 0 and _node <> _rep").select("_node", "_rep").distinct()
    cells = lookup_join(cells, renamed, ["_node"]).select("_h", F.coalesce("_rep", "_node").alias("_node"), "_n").distinct()
    cells = materialize(cells, "cells")
    cells = materialize(cells.join(cells.groupBy("_node").agg(F.count("*").alias("_s")), "_node"), "cells")

    links = None
    labelled = cells
    for turn in range(STAR_ROUNDS + 1):
        if turn < STAR_ROUNDS:
            products = _star_products(cells if turn == 0 else _of_mixed_columns(labelled), turn)
        else:
            products = _cross_products(labelled, percent)
        pairs = materialize(_counted(products, percent), "pairs")
        found = _verified(given, pairs, size, percent)
        links = materialize(found if links is None else links.union(found), "links")
        labels = components(links)
        labelled = lookup_join(cells, labels.withColumnRenamed("node", "_node"), ["_node"]).withColumn("_c", F.coalesce("component", "_node")).drop("component")
        labelled = materialize(labelled, "labelled") if turn < STAR_ROUNDS else labelled
    labels = labels.toDF("_rep", "_component")
    if shared.isEmpty():
        labels = labels.withColumn("_first", F.col("_component"))
    else:
        # the smallest id of a component is that of one of its sets, and no longer the smallest node
        least = labels.join(named.select("_rep", "_least").distinct(), "_rep").groupBy("_component").agg(F.min("_least").alias("_first"))
        labels = materialize(labels.join(least, "_component").select("_rep", "_component", "_first"), "labels")
    of_set = F.when(F.col("n_shingles") > 0, F.coalesce("_component", "_rep"))
    return lookup_join(named, labels, ["_rep"]).select("_id", "_hash", "n_shingles", of_set.alias("_group"),
                                                        F.when(F.col("n_shingles") > 0, F.coalesce("_first", "_least")).otherwise(F.col("_id")).alias("component_id"))


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) for every row; component_id is the smallest id that links reach."""
    return _grouped(docs, key, text, size, percent).select(F.col("_id").alias(key), "n_shingles", "component_id")


def _of_mixed_columns(labelled: DataFrame) -> DataFrame:
    """Entries of columns that hold more than one component; the rest is settled."""
    mixed = labelled.groupBy("_h").agg(F.min("_c").alias("_low"), F.max("_c").alias("_high")).filter("_low < _high").select("_h")
    return labelled.join(mixed, "_h").select("_h", "_node", "_n", "_s")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of linked rows: that of the smallest id, and of its texts in the group the one with the smallest hash.

    Rows are told apart by id and text, so a text goes only if a linked one stays. Of rows that repeat both one stays; rows with a null id all stay.
    """
    found = _grouped(docs, key, text).filter("_id is not null").select("_id", "_hash", "_group")
    linked = found.filter("_group is not null")
    kept = linked.groupBy("_group").agg(F.min(F.struct("_id", "_hash")).alias("_kept"), F.count("*").alias("_n")).filter("_n > 1").select("_group", "_kept")
    gone = lookup_join(linked, materialize(kept, "kept"), ["_group"], "inner").filter(F.struct("_id", "_hash") != F.col("_kept")).select("_id", "_hash").distinct()
    twice = found.groupBy("_id", "_hash").agg(F.count("*").alias("_k")).filter("_k > 1").select("_id", "_hash")
    left = without(docs, key, text, materialize(gone, "gone"))
    twice = materialize(twice, "twice")
    if twice.isEmpty():
        return left
    listed = F.broadcast(twice) if fits_broadcast(twice) else twice
    again = left.join(listed, _same_row(left, key, text, listed), "left_semi").dropDuplicates([key, text])
    return without(left, key, text, twice).unionByName(again)


def _same_row(docs: DataFrame, key: str, text: str, listed: DataFrame) -> Column:
    # the hash of a null is a number, and ids that are null equal none
    return (docs[key].cast("long") == listed["_id"]) & (F.xxhash64(docs[text]) == listed["_hash"])


def without(docs: DataFrame, key: str, text: str, rows: DataFrame) -> DataFrame:
    """The rows that are not in the table ``rows`` (_id, _hash of the text), which is sent to the tasks if its measured size allows it."""
    listed = F.broadcast(rows) if fits_broadcast(rows) else rows
    return docs.join(listed, _same_row(docs, key, text, listed), "left_anti")
