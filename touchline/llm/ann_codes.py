"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector's code is the signs of its rotated direction from a common mean, one bit
per dimension, made once and stored packed with two scalars: its distance from the
mean, and how well its code agrees with it. A query is rounded to a few levels, of
which each binary digit is a packed row of bits as well, so that the inner product
with a code is a few ANDs and bit counts. From it the inner product of the vectors is
estimated without bias, with a bound on the error that holds with high probability.
Vectors whose estimate plus error reaches the k-th score found so far are scored
on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from touchline.llm.common import bounded_ids, rows_of_ids, small_batches
from touchline.llm.vector_blocks import Best, all_finite, matrix, top_k

#: Standard deviations of the estimate that count as its error bound.
EPSILON = 2.0
QUERY_GROUP = 128

#: Pairs of a query and a vector that are reranked at once.
PAIRS = 8_192

#: Share of a block's pairs from which on they are summed as a block.
MANY = 0.02

#: Binary digits to which the components of a query are rounded.
BITS = 4
CODE_ROWS = 4096


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Packed codes of vectors, and the scalars that correct their estimates."""

    def __init__(self, x: np.ndarray, turn: np.ndarray, mean: np.ndarray | None = None) -> None:
        self.dim = x.shape[1]
        self.mean = x.mean(0) if mean is None else mean
        away = (x - self.mean) @ turn.T
        self.norm = np.sqrt((away**2).sum(1))
        direction = away / np.where(self.norm > 0, self.norm, 1)[:, None]
        self.packed = np.packbits(direction > 0, axis=1, bitorder="little")
        agree = np.abs(direction).sum(1) / np.sqrt(self.dim)
        self._with(np.where(agree > 0, agree, 1))

    @classmethod
    def of_stored(cls, dim: int, mean: np.ndarray, packed: np.ndarray, norm: np.ndarray, agree: np.ndarray) -> Codes:
        codes = cls.__new__(cls)
        codes.dim, codes.mean, codes.packed, codes.norm = dim, mean, packed, norm
        codes._with(agree)
        return codes

    def _with(self, agree: np.ndarray) -> None:
        self.agree = agree
        self.spread = np.sqrt(np.maximum(0, 1 - agree**2)) / agree / np.sqrt(max(1, self.dim - 1))
        self.words = _words(self.packed)
        self.ones = np.bitwise_count(self.words).sum(1, dtype=np.float32)

    def estimate(self, rows: slice, turned: np.ndarray, base: np.ndarray, length: np.ndarray):
        """Estimated inner products of queries with a slice of vectors, and the error."""
        planes = Planes(turned)
        root = np.sqrt(self.dim)
        scale = (self.norm / self.agree / root)[rows].astype(np.float32)
        guess = planes.sums(self.words[rows], self.ones[rows]) * scale + base[:, None].astype(np.float32)
        # what one bit loses, and what rounding the query to a few levels does; floats of 32 bits add little
        lost = length[:, None].astype(np.float32) * (EPSILON * self.norm * self.spread)[rows].astype(np.float32)
        error = lost + (EPSILON * planes.step * root / np.sqrt(12))[:, None].astype(np.float32) * scale
        return guess, error + 1e-5 * (np.abs(base) + length)[:, None].astype(np.float32)


def _words(packed: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of 64-bit words."""
    wide = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view("<u8")


class Planes:
    """Queries rounded to 2^BITS levels, as one packed row of bits per binary digit."""

    def __init__(self, turned: np.ndarray) -> None:
        self.low = turned.min(1).astype(np.float32)
        self.step = np.maximum((turned.max(1) - self.low) / (2**BITS - 1), 1e-30).astype(np.float32)
        levels = np.rint((turned - self.low[:, None]) / self.step[:, None]).clip(0, 2**BITS - 1).astype(np.uint8)
        self.planes = [_words(np.packbits(levels >> j & 1, axis=1, bitorder="little")) for j in range(BITS)]
        self.total = self.low * turned.shape[1] + self.step * levels.sum(1, dtype=np.float32)

    def sums(self, words: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Inner products of rounded queries with vectors of signs: where a bit is set,
        the sign is plus, so twice the sum over set bits less the sum over all."""
        shape = (len(self.low), len(words))
        met, count = np.zeros(shape, dtype=np.uint32), np.empty(shape, dtype=np.uint8)
        for j, plane in enumerate(self.planes):
            for w in range(words.shape[1]):
                np.bitwise_count(plane[:, w, None] & words[None, :, w], out=count)
                met += count.astype(np.uint32) << j if j else count
        return 2 * (self.low[:, None] * ones + self.step[:, None] * met.astype(np.float32)) - self.total[:, None]


def exact_products(q: np.ndarray, x: np.ndarray, asked: np.ndarray | None = None, rows: np.ndarray | None = None) -> np.ndarray:
    """Inner products of rows with rows (of those numbered, if given), summed in the
    order of dimensions."""
    asked = np.arange(len(q)) if asked is None else asked
    rows = np.arange(len(x)) if rows is None else rows
    total = np.zeros(len(asked))
    for d in range(q.shape[1]):
        total += q[asked, d] * x[rows, d]
    return total


def begin(means: dict[int, np.ndarray]):
    """The search of codes as stored by ``with_codes``."""

    def start(query_ids: np.ndarray, queries: np.ndarray, best: Best):
        dim = queries.shape[1]
        mean = means.get(dim, np.zeros(dim))
        turned = (queries @ rotation(dim).T).astype(np.float32)
        base, length = queries @ mean, np.sqrt((queries**2).sum(1))

        def rerank(asked, rows, ids, x, norms, fast=None):
            for at in range(0, len(asked), PAIRS):
                a, r = asked[at : at + PAIRS], rows[at : at + PAIRS]
                # a fast sum rules most out, the score itself is summed in order
                near = np.einsum("ij,ij->i", queries[a], x[r]) if fast is None else fast[at : at + PAIRS]
                good = near >= best.floors[a] - 1e-12 * length[a] * norms[r]
                a, r = a[good], r[good]
                score = exact_products(queries, x, a, r)
                good = score >= best.floors[a]
                best.add(a[good], ids[r[good]], score[good])

        def shard(ids: np.ndarray, x: np.ndarray, table: pa.Table) -> None:
            norms = np.sqrt((x**2).sum(1))
            packed = np.frombuffer(b"".join(table.column("code").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            codes = Codes.of_stored(dim, mean, packed, table.column("norm").to_numpy(), table.column("agree").to_numpy())
            for at in range(0, len(queries), QUERY_GROUP):
                group = np.arange(at, min(len(queries), at + QUERY_GROUP))
                for low in range(0, len(x), CODE_ROWS):
                    rows = slice(low, min(len(x), low + CODE_ROWS))
                    guess, error = codes.estimate(rows, turned[group], base[group], length[group])
                    same = ids[rows][None, :] == query_ids[group][:, None]
                    if (best.filled[group] < best.k).any():
                        # first the best guesses, so that there is a k-th score to compare with
                        some = min(2 * best.k, guess.shape[1])
                        top = np.argpartition(-guess, some - 1, axis=1)[:, :some]
                        first = np.zeros_like(same)
                        np.put_along_axis(first, top, True, 1)
                        r, c = np.nonzero(first & ~same)
                        rerank(group[r], low + c, ids, x, norms)
                        same |= first
                    chosen = (guess + error >= best.floors[group][:, None]) & ~same
                    r, c = np.nonzero(chosen)
                    # many chosen pairs of one block are cheaper to sum all together than one by one
                    fast = (queries[group] @ x[rows].T)[chosen] if len(r) > MANY * chosen.size else None
                    rerank(group[r], low + c, ids, x, norms, fast)

        return shard

    return start


def with_codes(rows: DataFrame, means: dict[int, np.ndarray]) -> DataFrame:
    """Rows (``vec_id``, ``v``, ``dim``) with their ``code``, ``norm`` and ``agree``."""
    schema = T.StructType([*rows.schema, *T.StructType.fromDDL("code binary, norm double, agree double")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for dim in table.column("dim").unique().to_pylist():
                part = table.filter(pc.equal(table.column("dim"), dim))
                codes = Codes(matrix(part.column("v"), dim, np.float64), rotation(dim), means.get(dim, np.zeros(dim)))
                made = {"code": [c.tobytes() for c in codes.packed], "norm": codes.norm, "agree": codes.agree}
                for name, column in made.items():
                    part = part.append_column(name, pa.array(column))
                yield from part.combine_chunks().to_batches()

    return small_batches(rows).mapInArrow(run, schema)


def approximate_top_k(
    embeddings: DataFrame, k: int = 20, every: int = 20, id_column: str = "vec_id", vector: str = "embedding",
    sample: int = 2_048,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` rows found nearest
    to each query by inner product in doubles, ties to the smaller id.

    Every row is coded, once; only the point that codes are taken from is the mean of
    at most ``sample`` rows. Queries are the rows whose id is divisible by ``every``,
    candidates all rows but those of the query's id. Vectors that are null, empty, zero
    or hold null or non-finite components, and rows without an id, take no part. Of
    several rows with one id, the one of smallest vector takes part, as query and
    candidate.
    """
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    zero = F.forall("v", lambda x: x == 0)
    rows = rows.where(F.col("vec_id").isNotNull() & all_finite("v") & ~zero)
    rows = rows.withColumn("v", F.transform("v", lambda x: x.cast("double")))
    by_dim: dict[int, list] = {}
    for r in rows_of_ids(rows, "vec_id", bounded_ids(rows, "vec_id", sample)).groupBy("vec_id").agg(F.min("v").alias("v")).collect():
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    means = {dim: np.array(v).mean(0) for dim, v in by_dim.items()}
    return top_k(rows, F.col("vec_id") % every == 0, k, begin(means), "double", "ann", lambda df: with_codes(df, means))
