"""Exact top-k search by inner product: a KD-tree per shard, searched best first with bounds of boxes.

Vectors are dealt to shards of bounded size. Each shard is built into a tree by median splits of the widest side; every node keeps a
tight box. No vector of a box can score more for a query than the sum over the dimensions of the larger of ``q * low`` and ``q * high``,
so nodes are visited from the highest bound down, and a search ends when the bound is below the query's kth best score. A block of
queries goes down a tree together; its heap is ordered by the highest bound that any query still needs.

Two rounds: first each query meets one shard, which gives it a kth score; then it takes that score to all other shards, where
most boxes fall below it. The best of all shards are merged per query, at most k from each.

Scores are integers and exact up to 2**53. Ties go to the smaller id. Defined cases: vectors that are null or hold null or non-finite
components take no part, as rows with a null id; vectors of other lengths than the query's are no candidates of it; a query's own row is no candidate, and
repeated rows with its id neither; other repeated rows are candidates of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.operators.materialize import materialize

LEAF = 128
SHARD_ROWS = 8_192
QUERY_BLOCK = 256
BLOCK_ROWS = 16_384
SCALE = 256


class Node(NamedTuple):
    low: np.ndarray
    high: np.ndarray
    start: int
    end: int
    left: int
    right: int


class Tree:
    """Median splits of the widest side until LEAF rows are left."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.nodes: list[Node] = []
        stack = [(0, len(ids), -1, False)]
        links: list[list[int]] = []
        while stack:
            start, end, parent, right = stack.pop()
            rows = vectors[order[start:end]]
            low, high = rows.min(axis=0), rows.max(axis=0)
            at = len(self.nodes)
            self.nodes.append(Node(low, high, start, end, -1, -1))
            links.append([-1, -1])
            if parent >= 0:
                links[parent][right] = at
            if end - start > leaf and vectors.shape[1] and (high > low).any():
                side = int(np.argmax(high - low))
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(rows[:, side], middle, kind="introselect")]
                stack += [(start, start + middle, at, False), (start + middle, end, at, True)]
        self.nodes = [n._replace(left=a, right=b) for n, (a, b) in zip(self.nodes, links)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.lows = np.array([n.low for n in self.nodes])
        self.highs = np.array([n.high for n in self.nodes])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No vector of node j scores more for query i than bounds[i, j]."""
        return np.maximum(queries, 0) @ self.highs.T + np.minimum(queries, 0) @ self.lows.T

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best per query, in order, with -inf where there are fewer; scores below ``least`` may be left out."""
        n = len(queries)
        best = np.full((n, k), -np.inf)
        best_ids = np.full((n, k), np.iinfo(np.int64).max)
        bound = self.bounds(queries)
        heap = [(-bound[:, 0].max(), 0)]
        while heap:
            _, at = heapq.heappop(heap)
            # ties may still win by a smaller id, so equal bounds are searched
            wanted = np.flatnonzero(bound[:, at] >= np.maximum(best[:, -1], least))
            if not len(wanted):
                continue
            node = self.nodes[at]
            if node.left >= 0:
                for child in (node.left, node.right):
                    heapq.heappush(heap, (-bound[wanted, child].max(), child))
                continue
            ids = self.ids[node.start:node.end]
            for block in np.array_split(wanted, -(-len(wanted) // QUERY_BLOCK)):
                scores = queries[block] @ self.vectors[node.start:node.end].T
                scores[ids[None, :] == query_ids[block][:, None]] = -np.inf
                all_scores = np.concatenate([best[block], scores], axis=1)
                all_ids = np.concatenate([best_ids[block], np.broadcast_to(ids, scores.shape)], axis=1)
                order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                best[block] = np.take_along_axis(all_scores, order, axis=1)
                best_ids[block] = np.take_along_axis(all_ids, order, axis=1)
        return best_ids, best


def usable(table: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(_id, _v, _dim) of rows that take part; components become floor(scale * x), as whole doubles."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = table.select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    rows = rows.filter(F.col("_id").isNotNull() & F.col("_v").isNotNull() & F.forall("_v", finite))
    return rows.select("_id", F.transform("_v", lambda x: F.floor(x * scale).cast("double")).alias("_v"), F.size("_v").alias("_dim"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


_HITS = "_query long, _id long, _score double"


def _searched(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each shard for the queries that were sent to it. Both tables hold _shard and _block; queries also _least."""
    keys = ["_dim", "_shard", "_block"]
    grouped = vectors.groupBy(*keys).cogroup(queries.groupBy(*keys))

    def run(key: tuple, shard: pa.Table, asked: pa.Table) -> pa.Table:
        empty = pa.table({"_query": pa.array([], pa.int64()), "_id": pa.array([], pa.int64()), "_score": pa.array([], pa.float64())})
        if not shard.num_rows or not asked.num_rows:
            return empty
        dim = key[0].as_py()
        shard = shard.combine_chunks()
        tree = Tree(shard.column("_id").to_numpy(), _matrix(shard.column("_v").combine_chunks(), dim))
        out = [empty]
        for at in range(0, asked.num_rows, 4 * QUERY_BLOCK):
            part = asked.slice(at, 4 * QUERY_BLOCK).combine_chunks()
            own = part.column("_id").to_numpy()
            ids, scores = tree.search(own, _matrix(part.column("_v").combine_chunks(), dim), k, part.column("_least").to_numpy())
            kept = np.isfinite(scores)
            out.append(pa.table({"_query": np.broadcast_to(own[:, None], ids.shape)[kept], "_id": ids[kept], "_score": scores[kept]}))
        return pa.concat_tables(out)

    return grouped.applyInArrow(run, _HITS)


def _merged(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("_query").orderBy(F.desc("_score"), F.asc("_id"))
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(table: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, <key>, score): the k vectors with the highest inner product for each query row, ties to the smaller id.

    A query id that occurs in several rows is searched once, by the first of its vectors in their order. A group holds one shard and
    one block of queries, both of bounded size.
    """
    rows = usable(table, key, vector, scale)
    asking = usable(table.filter(is_query), key, vector, scale).groupBy("_id").agg(F.min("_v").alias("_v")).withColumn("_dim", F.size("_v"))
    asking = materialize(asking, "asking")
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-asking.count() // block_rows))
    # dealt once and written, so that both rounds see the same shards
    dealt = F.pmod(F.xxhash64("_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    vectors = materialize(rows.withColumn("_shard", dealt), "vectors")
    home = F.pmod(F.hash("_id"), F.lit(shards))
    first = _searched(vectors.withColumn("_block", F.lit(0)),
                      asking.withColumns({"_shard": home, "_block": F.lit(0), "_least": F.lit(float("-inf"))}), k)
    first = materialize(first, "first")
    # the kth score of the first round bounds the second
    kth = first.groupBy(F.col("_query").alias("_id")).agg(F.when(F.count("*") >= k, F.min("_score")).alias("_least"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)
    bounded = asking.join(kth, "_id", "left").withColumns({
        "_least": F.coalesce("_least", F.lit(float("-inf"))), "_block": F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int"),
        "_shard": F.explode(others)})
    facing = vectors.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    hits = first.unionByName(_searched(facing, bounded, k))
    return _merged(hits, k).select(F.col("_query").alias("query_id"), "rank", F.col("_id").alias(key), F.col("_score").cast("long").alias("score"))
