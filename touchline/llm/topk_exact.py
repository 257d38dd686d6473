"""Exact top-k inner products: ball-tree branch and bound per shard.

A shard's vectors form a tree of balls. The inner product of a query with any
vector of a ball is at most q·c + |q| r, so a ball whose bound lies below a
query's k-th score so far is left out for it. Queries that are near one another
(leaves of a tree over the queries) go through the tree together, the ball of
highest bound first.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, functions as F

from touchline.llm.vector_blocks import Best, all_finite, top_k

LEAF = 128
QUERY_LEAF = 64


class BallTree:
    """Nodes as (low, high, centre, radius, children) over a permutation of rows."""

    def __init__(self, x: np.ndarray, leaf: int) -> None:
        self.x, self.order, self.nodes = x.astype(np.float64), np.arange(len(x)), []
        self._build(0, len(x), leaf)

    def _build(self, low: int, high: int, leaf: int) -> int:
        at = len(self.nodes)
        rows = self.x[self.order[low:high]]
        centre = rows.mean(0)
        away = ((rows - centre) ** 2).sum(1)
        self.nodes.append([low, high, centre, float(np.sqrt(away.max())), ()])
        if high - low > leaf:
            a = rows[away.argmax()]
            b = rows[((rows - a) ** 2).sum(1).argmax()]
            middle = (high - low) // 2  # equal vectors are halved as well
            part = np.argpartition(rows @ (b - a), middle)
            self.order[low:high] = self.order[low:high][part]
            self.nodes[at][4] = (self._build(low, low + middle, leaf), self._build(low + middle, high, leaf))
        return at

    def leaves(self):
        return [self.order[n[0] : n[1]] for n in self.nodes if not n[4]]


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; through doubles while these hold every sum exactly."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def begin(query_ids: np.ndarray, queries: np.ndarray, best: Best):
    """A search for these queries, which shares one tree over them for all shards."""
    groups = BallTree(queries, QUERY_LEAF).leaves() if len(queries) else []
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))

    def shard(ids: np.ndarray, x: np.ndarray, _=None) -> None:
        tree = BallTree(x, LEAF)
        for group in groups:
            _search_group(tree, ids, x, group, query_ids, queries, lengths[group], best)

    return shard


def _search_group(tree, ids, x, group, query_ids, queries, length, best) -> None:
    q = queries[group].astype(np.float64)

    def bounds(node):
        # rounding may lower a bound by far less than this
        exact = q @ node[2] + length * node[3]
        return exact + 1e-9 * (1 + np.abs(exact))

    heap = [(-float(bounds(tree.nodes[0]).max()), 0)]
    while heap:
        _, at = heapq.heappop(heap)
        node = tree.nodes[at]
        wanted = np.flatnonzero(bounds(node) >= best.floors[group])
        if not len(wanted):
            continue
        if node[4]:
            for child in node[4]:
                heapq.heappush(heap, (-float(bounds(tree.nodes[child])[wanted].max()), child))
            continue
        rows = tree.order[node[0] : node[1]]
        asked = group[wanted]
        score = _products(queries[asked], x[rows])
        fits = (score >= best.floors[asked][:, None]) & (ids[rows][None, :] != query_ids[asked][:, None])
        r, c = np.nonzero(fits)
        best.add(asked[r], ids[rows[c]], score[r, c])


def search(ids, x, query_ids, queries, floors, k):
    """One shard: index of the query, id and score of its k best rows above the floors."""
    best = Best(len(queries), k, floors, np.int64)
    begin(query_ids, queries, best)(ids, x)
    return best.rows()


def exact_top_k(
    embeddings: DataFrame, k: int = 20, every: int = 20, id_column: str = "vec_id", vector: str = "embedding", scale: int = 64
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: each query's ``k`` highest
    integer inner products, ties to the smaller id.

    A component x becomes floor(scale * x). Queries are the rows whose id is
    divisible by ``every``, candidates all rows but those of the query's id.
    Vectors that are null, empty or hold null or non-finite components, and rows
    without an id, take no part. Of several rows with one id, the one of smallest
    vector takes part, as query and candidate. Scores must fit into 63 bits.
    """
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & all_finite("v"))
    whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return top_k(rows.withColumn("v", whole), F.col("vec_id") % every == 0, k, begin, "long", "topk")
