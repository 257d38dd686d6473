"""Hard-negative mining by angular triangle filtering.

Every vector stores its norm and its angles to a few reference directions. For two
vectors with angles s and t to one direction, their own angle lies between |s - t|
and min(s + t, 2 pi - s - t). The tightest such bounds over all directions give an
interval of the cosine, and with the norms one of the score. Stored rows are sorted
by nearest direction and angle, so that neighbours share narrow angles: a chunk of
neighbours has one interval per anchor, widened for rounding, and only where that
interval meets a window of scores still wanted are integer products taken.

Anchors are dealt into blocks of bounded size. For each block one pass over the
stored rows finds positives, and a second one the negatives in the windows these
span. A task holds a block, a batch and the best rows so far; what it found meets
that of the others in a shuffle of a few rows per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from touchline.llm.common import bounded_ids, rows_of_ids, small_batches, stored
from touchline.llm.vector_blocks import Best, all_finite
from touchline.session import scratch_dir

#: Reference directions per dimension, found in at most so many sampled rows. They
#: change how many products are taken, never the result.
DIRECTIONS = 24
SAMPLE_ROWS = 2_048

BLOCK_ANCHORS = 2_048
PART_ROWS = 8_192
CHUNK = 64

#: Angles are wrong by less than this: the arc cosine turns an error e of a cosine
#: near one into the square root of 2 e.
SLACK = 1e-6


@dataclass
class Vectors:
    """Rows of one dimension."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    norms: np.ndarray
    angles: np.ndarray


def directions(sample: np.ndarray) -> np.ndarray:
    """Unit vectors far from one another: each next one is the sampled row with the
    largest angle to its nearest chosen one."""
    norms = np.sqrt((sample**2).sum(1))
    unit = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    centre = unit.mean(0)
    chosen = [int((unit @ centre).argmax())]
    nearest = unit @ unit[chosen[0]]
    while len(chosen) < min(DIRECTIONS, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles_to(v: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to unit vectors; a zero vector, whose scores are all zero,
    has angle zero to all."""
    x = v.astype(np.float64)
    norms = np.sqrt((x**2).sum(1))
    cosines = (x @ units.T) / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(np.where(norms[:, None] > 0, cosines, 1), -1, 1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; through doubles while these hold every sum exactly."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def score_bounds(anchors: Vectors, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray):
    """Lowest and highest possible score of every anchor with every chunk, whose
    angles lie in [low, high] and norms in [least, most]."""
    shape = (len(anchors.ids), len(least))
    near, far = np.zeros(shape), np.full(shape, np.pi)
    for r in range(anchors.angles.shape[1]):
        own, lo, hi = anchors.angles[:, r][:, None], low[:, r], high[:, r]
        near = np.maximum(near, np.maximum(own - hi, lo - own))
        far = np.minimum(far, np.minimum(own + hi, 2 * np.pi - own - lo))
    near, far = np.clip(near - SLACK, 0, np.pi), np.clip(far + SLACK, 0, np.pi)
    top, bottom = np.cos(near), np.cos(far)
    length = anchors.norms[:, None]
    top = length * np.where(top > 0, most, least) * top
    bottom = length * np.where(bottom > 0, least, most) * bottom
    room = 1 + 1e-9 * length * most
    return bottom - room, top + room


class WindowSearch:
    """The ``k`` best rows of every window of scores.

    ``low`` and ``high`` (anchors x windows) are the scores that a window admits;
    ``same`` tells whether rows of the anchor's label are wanted, or those of others.
    ``scored`` of ``pairs`` met in a product.
    """

    def __init__(self, anchors: Vectors, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> None:
        self.anchors, self.low, self.high, self.same = anchors, low, high, same
        self.best = Best(low.size, k, low.ravel(), np.int64)
        self.scored = self.pairs = 0

    def add(self, rows: Vectors) -> None:
        anchors, windows = self.anchors, self.low.shape[1]
        starts = np.arange(0, len(rows.ids), CHUNK)
        ends = np.minimum(starts + CHUNK, len(rows.ids))
        ranges = [f.reduceat(rows.angles, starts, axis=0) for f in (np.minimum, np.maximum)]
        norms = [f.reduceat(rows.norms, starts) for f in (np.minimum, np.maximum)]
        bottom, top = score_bounds(anchors, *ranges, *norms)
        self.pairs += len(anchors.ids) * len(rows.ids)
        for c, (start, end) in enumerate(zip(starts, ends)):
            floors = self.best.floors.reshape(-1, windows)
            asked = np.flatnonzero(((top[:, c][:, None] >= floors) & (bottom[:, c][:, None] <= self.high)).any(1))
            if not len(asked):
                continue
            self.scored += len(asked) * int(end - start)
            ids, labels = rows.ids[start:end], rows.labels[start:end]
            score = products(anchors.v[asked], rows.v[start:end])
            fits = ((labels == anchors.labels[asked][:, None]) == self.same) & (ids != anchors.ids[asked][:, None])
            low, high, floors = self.low[asked], self.high[asked], floors[asked]
            found = []
            for w in range(windows):
                inside = fits & (score >= np.maximum(low, floors)[:, w][:, None]) & (score <= high[:, w][:, None])
                r, i = np.nonzero(inside)
                found.append((asked[r] * windows + w, ids[i], score[r, i]))
            self.best.add(*(np.concatenate(x) for x in zip(*found)))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the anchor, number of its window, id and score."""
        slot, ids, scores = self.best.rows()
        return slot // self.low.shape[1], slot % self.low.shape[1], ids, scores


def _parts(batch: pa.RecordBatch | pa.Table) -> Iterator[Vectors]:
    """Rows by dimension, in their order."""
    flat = lambda name: np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in _chunks(batch.column(name))])
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    if not len(dims):
        return
    v, angles = flat("v"), flat("angles")
    sizes = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in _chunks(batch.column("angles"))])
    at, beside = np.concatenate([[0], np.cumsum(dims)]), np.concatenate([[0], np.cumsum(sizes)])
    one = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "label", "norm")}
    cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1), len(dims)]
    for a, b in zip(cuts, cuts[1:]):
        yield Vectors(
            one["vec_id"][a:b], one["label"][a:b], v[at[a] : at[b]].reshape(b - a, -1), one["norm"][a:b],
            angles[beside[a] : beside[b]].reshape(b - a, int(sizes[a])),
        )


def _chunks(column) -> list[pa.Array]:
    return column.chunks if isinstance(column, pa.ChunkedArray) else [column]


_STORED = "vec_id long, label long, v array<long>, dim int, norm double, angles array<double>, nearest int, angle double"


def with_angles(rows: DataFrame, units: dict[int, np.ndarray]) -> DataFrame:
    """Rows (``vec_id``, ``label``, ``v``, ``dim``) with their norm and angles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, dims = pa.Table.from_batches([batch]), batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part = table.filter(pa.array(dims == dim))
                v = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                own = units.get(int(dim), np.zeros((0, int(dim))))
                norms, angles = angles_to(v, own)
                nearest = angles.argmin(1) if len(own) else np.zeros(len(v), dtype=np.int64)
                angle = angles.min(1) if len(own) else np.zeros(len(v))
                for name, made in (
                    ("norm", pa.array(norms)), ("angles", pa.array(list(angles), type=pa.list_(pa.float64()))),
                    ("nearest", pa.array(nearest.astype(np.int32))), ("angle", pa.array(angle)),
                ):
                    part = part.append_column(name, made)
                yield from part.combine_chunks().to_batches()

    return small_batches(rows).mapInArrow(run, _STORED)


def hard_negatives(
    embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``.

    A component x becomes floor(scale * x); a score is an integer inner product, and of
    equal scores the smaller id comes first. Anchors are the rows whose id is divisible
    by ``every``, an anchor's positives its first ``positives`` other rows of its label.
    For each, the first ``negatives`` rows of other labels follow whose score is ``low``
    to ``high`` hundredths of the positive's; a negative score of a positive leaves none.

    Rows with a null id or label, and vectors that are null, empty or hold null or
    non-finite components, take no part. Of several rows with one id, the one of smallest
    label, then vector, takes part. Vectors of different dimension do not meet. Labels
    are integers. A hundredfold score must fit into 63 bits. Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & all_finite("v"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    whole = F.transform("row.v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    rows = stored(rows.select("vec_id", "row.label", whole.alias("v"), F.size("row.v").alias("dim")), "whole_vectors")

    by_dim: dict[int, list] = {}
    for r in rows_of_ids(rows, "vec_id", bounded_ids(rows, "vec_id", SAMPLE_ROWS)).select("dim", "v").collect():
        by_dim.setdefault(r["dim"], []).append(r["v"])
    units = {dim: directions(np.array(v, dtype=np.float64)) for dim, v in sorted(by_dim.items())}
    parts = 1 + rows.count() // PART_ROWS
    order = ["dim", "nearest", "angle", "vec_id"]
    angled = with_angles(rows, units).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    angled = stored(angled, "angled_vectors").drop("nearest", "angle")

    anchors = angled.where(F.col("vec_id") % every == 0)
    blocks = 1 + anchors.count() // BLOCK_ANCHORS
    number = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    out = scratch_dir(spark, "hard_negatives")
    for block in range(blocks):
        own = [p for p in _parts(anchors.where(number == block).orderBy("dim", "vec_id").toArrow())]
        _mine(angled, own, positives, negatives, low, high).write.parquet(f"{out}/block={block}")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, block int"
    return spark.read.schema(schema).parquet(out).drop("block")


def _search(rows: DataFrame, wanted: list[tuple[Vectors, np.ndarray, np.ndarray]], same: bool, k: int) -> DataFrame:
    """``anchor_id``, ``window``, ``vec_id``, ``score`` and ``rank`` of the ``k`` best rows of
    every window; ``wanted`` has the anchors of each dimension with their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {a.v.shape[1]: WindowSearch(a, low, high, same, k) for a, low, high in wanted}
        for batch in batches:
            for part in _parts(batch):
                if part.v.shape[1] in searches:
                    searches[part.v.shape[1]].add(part)
        for search in searches.values():
            anchor, window, ids, scores = search.found()
            yield pa.record_batch({
                "anchor_id": pa.array(search.anchors.ids[anchor]), "window": pa.array(window.astype(np.int32)),
                "vec_id": pa.array(ids), "score": pa.array(scores),
            })

    found = small_batches(rows).mapInArrow(run, "anchor_id long, window int, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _mine(rows: DataFrame, anchors: list[Vectors], positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The hard negatives of one block of anchors, given by dimension. Positives of a
    block are a bounded number, so the driver may hand them to the second pass."""
    bottom, top = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    whole = [(a, np.full((len(a.ids), 1), bottom), np.full((len(a.ids), 1), top)) for a in anchors]
    first = {}
    for r in _search(rows, whole, True, positives).collect():
        first[r["anchor_id"], r["rank"]] = (r["vec_id"], r["score"])

    wanted = []
    for a in anchors:
        # an empty window where an anchor has fewer positives
        least, most = np.full((len(a.ids), positives), top), np.full((len(a.ids), positives), bottom)
        for n, anchor in enumerate(a.ids.tolist()):
            for w in range(positives):
                if (anchor, w + 1) in first:
                    score = first[anchor, w + 1][1]
                    least[n, w], most[n, w] = -(-low * score // 100), high * score // 100
        wanted.append((a, least, most))
    found = _search(rows, wanted, False, negatives)
    pairs = rows.sparkSession.createDataFrame(
        [(anchor, w - 1, *pair) for (anchor, w), pair in first.items()],
        "anchor_id long, window int, positive_id long, positive_score long",
    )
    # a block has a bounded number of positives
    return found.join(F.broadcast(pairs), ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
