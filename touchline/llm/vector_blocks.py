"""Every query vector against every other vector, in blocks.

Vectors are stored once and stay where they lie. Queries are dealt into blocks of
bounded size; for each block a job passes over the stored vectors, whose tasks
search them shard by shard, so memory is bounded whatever the tables, and what is
shuffled are the k best of every task and query. A first pass searches one shard
only. The score a query's k-th result has there goes along as a floor to all
tasks, which may leave out what is surely below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import small_batches, stored
from touchline.session import scratch_dir

SHARD_ROWS = 16_384
BLOCK_QUERIES = 4_096

#: (query ids, queries, best) -> a function that searches a shard (ids, vectors, all
#: its columns) and adds what it finds to ``best``.
Begin = Callable[[np.ndarray, np.ndarray, "Best"], Callable[[np.ndarray, np.ndarray, pa.Table | None], None]]


def all_finite(vector: str) -> Column:
    """True for a vector without null, NaN or infinite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


class Best:
    """The k best (score, id) of each query: highest score, then smallest id."""

    def __init__(self, queries: int, k: int, floors: np.ndarray, dtype) -> None:
        self.k = k
        self.scores = np.zeros((queries, k), dtype=dtype)
        self.ids = np.zeros((queries, k), dtype=np.int64)
        self.filled = np.zeros(queries, dtype=np.int64)
        self.floors = floors.astype(np.float64)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(rows):
            return
        own = np.unique(rows)
        kept = np.arange(self.k) < self.filled[own][:, None]
        r = np.concatenate([rows, np.broadcast_to(own[:, None], kept.shape)[kept]])
        i = np.concatenate([ids, self.ids[own][kept]])
        s = np.concatenate([scores, self.scores[own][kept]])
        order = np.lexsort((i, -s, r))
        r, i, s = r[order], i[order], s[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        top = place < self.k
        self.scores[r[top], place[top]] = s[top]
        self.ids[r[top], place[top]] = i[top]
        self.filled[own] = np.minimum(self.k, np.bincount(r, minlength=own[-1] + 1)[own])
        full = own[self.filled[own] == self.k]
        self.floors[full] = np.maximum(self.floors[full], self.scores[full, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kept = np.arange(self.k) < self.filled[:, None]
        return np.nonzero(kept)[0], self.ids[kept], self.scores[kept]


def one_per_id(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``v`` and ``dim``: of several rows with one id, the smallest vector."""
    return vectors.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def matrix(column: pa.ChunkedArray, dim: int, number) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(number, copy=False).reshape(-1, dim)


def top_k(
    vectors: DataFrame, is_query: Column, k: int, begin: Begin, score_type: str, name: str,
    code: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best other rows.

    ``vectors`` has ``vec_id`` (long) and ``v`` (array of long or double), both
    without nulls; of several rows with one id, the one of smallest vector takes part.
    Vectors of different dimension do not meet. ``code`` may add columns before the
    vectors are stored.
    """
    rows = one_per_id(vectors)
    spark = rows.sparkSession
    rows = stored(code(rows) if code else rows, name)
    shards = 1 + rows.count() // SHARD_ROWS
    # a table of its own, so that the first pass reads no other rows
    home = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(shards)) == 0)
    home = stored(home, f"{name}_home") if shards > 1 else None
    queries = rows.where(is_query).select("vec_id", "v", "dim")
    blocks = 1 + queries.count() // BLOCK_QUERIES
    number_of = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    number = np.int64 if score_type == "long" else np.float64
    out = scratch_dir(spark, f"{name}_found")
    for block in range(blocks):
        # a block has a bounded number of queries, so it may travel with the tasks
        own = queries.where(number_of == block).orderBy("dim", "vec_id").toArrow()
        asked = {}
        for dim in own.column("dim").unique().to_pylist():
            part = own.filter(pc.equal(own.column("dim"), dim))
            asked[dim] = (part.column("vec_id").to_numpy(), matrix(part.column("v"), dim, number))
        floors: dict[int, float] = {}
        if home is not None:
            first = _best_of(_search(home, asked, {}, k, begin, score_type), k)
            least = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
            floors = {r["query_id"]: float(r["least"]) for r in least.where(F.col("n") >= k).collect()}
        found = _best_of(_search(rows, asked, floors, k, begin, score_type), k)
        found.write.parquet(f"{out}/block={block}")
    found = spark.read.schema(f"query_id long, rank int, vec_id long, score {score_type}, block int").parquet(out)
    return found.drop("block")


def _best_of(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, asked: dict, floors: dict[int, float], k: int, begin: Begin, score_type: str) -> DataFrame:
    """What each task finds best in its rows for every query of a block. A task reads
    a shard after the other; the k-th scores of one are floors for the next."""
    number = np.int64 if score_type == "long" else np.float64
    kind = pa.int64() if score_type == "long" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = {}
        for dim, (ids, vectors) in asked.items():
            low = np.array([floors.get(i, -np.inf) for i in ids.tolist()])
            best = Best(len(ids), k, low, number)
            work[dim] = (ids, best, begin(ids, vectors, best))
        held, size = [], 0

        def flush() -> None:
            shard = pa.Table.from_batches(held)
            for dim in shard.column("dim").unique().to_pylist():
                if dim in work:
                    part = shard.filter(pc.equal(shard.column("dim"), dim))
                    work[dim][2](part.column("vec_id").to_numpy(), matrix(part.column("v"), dim, number), part)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SHARD_ROWS:
                flush()
                held, size = [], 0
        if size:
            flush()
        for ids, best, _ in work.values():
            at, found, scores = best.rows()
            yield pa.record_batch({"query_id": pa.array(ids[at]), "vec_id": pa.array(found), "score": pa.array(scores, type=kind)})

    return small_batches(rows).mapInArrow(run, f"query_id long, vec_id long, score {score_type}")
