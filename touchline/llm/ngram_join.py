"""N-gram Jaccard join by parity sketches.

The shingles of a document are hashed into blocks, and each block is the XOR of
what fell into it: a parity sketch, equal in two documents unless a shingle of
the block is in one only. Two sets whose Jaccard index is 3/4 or more differ in
at most a third of the smaller one's size, so with more blocks than that some
must be equal (pigeonhole); the number of blocks belongs to a band of sizes.

A document with K filled blocks and d possible differences shares at least K - d
filled blocks with a partner, so its d + 1 rarest filled blocks are enough as
keys. Rareness comes from a histogram of fixed size, whose only role is to order
keys alike everywhere; the result does not depend on it. Passages that many
documents share thus rarely become keys.

Documents with equal sets are one node. Of the nodes sharing a key, each is
first compared with one of them only; what is then still apart within a key is
compared across. A bit sketch whose Hamming distance is at most the difference
of the sets goes before the exact comparison of the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import _slices, map_texts, small_batches, stored, worker_cache
from touchline.llm.components import connected
from touchline.llm.shingles import mix, shingle_sets

WIDTH = 5
_U = np.uint64
_LEAST_BITS = 1024
_COUNTERS = 1 << 18
_PER_ROW = 1 << 12
_MARKS = 1 << 23  # bits of the membership bitmap


def _levels(n: int) -> list[int]:
    """Bands a set of n belongs to: its own, and the next when a partner there
    can be similar enough. Band j holds the sizes from 4**j to 4**(j+1) - 1."""
    j = (n.bit_length() - 1) // 2
    return [j, j + 1] if 4 * n >= 3 * 4 ** (j + 1) else [j]


def blocks_of(level: int) -> int:
    return max(64, -(-6 * 4 ** (level + 1) // 10))


def most_differences(n: int, level: int) -> int:
    """The largest symmetric difference of a set of n with a partner met in a band."""
    return min(n // 3, (n + 4 ** (level + 1) - 1) // 7)


def _filled(tokens: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Filled blocks of sorted tokens, and their keys."""
    block = ((tokens >> _U(32)) * _U(blocks_of(level))) >> _U(32)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    sketch = np.bitwise_xor.reduceat(mix(tokens ^ _U(0x5851F42D4C957F2D)), first)
    return block[first], _keys(sketch, block[first], level)


def _keys(sketch: np.ndarray, block: np.ndarray, level: int) -> np.ndarray:
    return mix(sketch + mix(block * _U(64) + _U(level + 1)))


def join_keys(tokens: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """The keys under which a set meets every set similar to it."""
    n, made = len(tokens), []
    if not n:
        return np.empty(0, dtype=np.uint64)
    for level in _levels(n):
        d = most_differences(n, level)
        filled, keys = _filled(tokens, level)
        if len(keys) > d:
            count = counters[(keys & _U(_COUNTERS - 1)).astype(np.int64)]
            made.append(keys[np.lexsort((keys, count))[: d + 1]])
        else:  # too few filled blocks: equal empty ones count as well
            empty = np.setdiff1d(np.arange(blocks_of(level), dtype=np.uint64), filled)
            made += [keys, _keys(np.zeros(len(empty), dtype=np.uint64), empty, level)]
    return np.concatenate(made)


def _bit_sketch(tokens: np.ndarray) -> list[int]:
    """Parity of the tokens per bit, with at least a bit per token."""
    bits = max(_LEAST_BITS, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((mix(tokens + _U(99)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _fingerprint(tokens: np.ndarray) -> bytes:
    again = mix(tokens ^ _U(0xD1342543DE82EF95))
    ends = [np.bitwise_xor.reduce(again), again.sum(dtype=np.uint64) + _U(len(tokens))]
    return np.array(ends, dtype=np.uint64).tobytes()


_PROFILE = "doc_id long, n long, fp binary, bits array<long>, part int, counts binary"


def _profile(docs: DataFrame) -> DataFrame:
    """A row per document with its size, fingerprint and bit sketch, and rows with
    each task's share of the histogram (``part`` and ``counts``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("ngram_join")
        counters = np.zeros(_COUNTERS, dtype=np.uint32)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for start, end in _slices(sizes):
                ids = batch.column(0).slice(start, end - start)
                sets = shingle_sets(batch.column(1).slice(start, end - start).to_pylist(), WIDTH)
                seen = [
                    (_filled(s, level)[1] & _U(_COUNTERS - 1)).astype(np.int64)
                    for s in sets if len(s) for level in _levels(len(s))
                ]
                if seen:
                    counters += np.bincount(np.concatenate(seen), minlength=_COUNTERS).astype(np.uint32)
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([_bit_sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                        none.cast(pa.int32()),
                        none.cast(pa.binary()),
                    ],
                    names=["doc_id", "n", "fp", "bits", "part", "counts"],
                )
        parts = [
            (k, row.tobytes()) for k, row in enumerate(counters.reshape(-1, _PER_ROW)) if row.any()
        ]
        none = pa.nulls(len(parts))
        yield pa.RecordBatch.from_arrays(
            [
                none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.list_(pa.int64())),
                pa.array([k for k, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary()),
            ],
            names=["doc_id", "n", "fp", "bits", "part", "counts"],
        )

    return small_batches(docs).mapInArrow(run, _PROFILE)


def _histogram(profile: DataFrame) -> np.ndarray:
    """The tasks' counters summed by Spark; their number is fixed."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(counts, dtype=np.int64 if len(counts) == 8 * _PER_ROW else np.uint32)
                total[part] = total.get(part, 0) + own.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())],
            names=["part", "counts"],
        )

    shares = profile.where("part is not null").select("part", "counts")
    summed = shares.mapInArrow(add, "part int, counts binary").repartition("part").mapInArrow(add, "part int, counts binary")
    counters = np.zeros(_COUNTERS, dtype=np.int64)
    for row in summed.collect():
        at = row["part"] * _PER_ROW
        counters[at : at + _PER_ROW] = np.frombuffer(row["counts"], dtype=np.int64)
    return np.minimum(counters, (1 << 31) - 1).astype(np.int32)


def _folded(a: str, b: str) -> Column:
    """Sketch ``a``, halved by XOR when ``b`` has half its bits. Sizes that may be
    similar are never further apart."""
    half = (F.size(a) / 2).cast("int")
    folded = F.zip_with(F.slice(a, 1, half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(a) > F.size(b), folded).otherwise(F.col(a))


def _hamming(a: str, b: str) -> Column:
    apart = F.zip_with(_folded(a, b), _folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda total, x: total + x)


def _alike_in_size(n_a: str, n_b: str) -> Column:
    return 4 * F.least(n_a, n_b) >= 3 * F.greatest(n_a, n_b)


#: Parts of a bit sketch folded to 256 bits, which travel with every shared key.
_FOLDS = ("s0", "s1", "s2", "s3")


def _folds(bits: str) -> list[Column]:
    part = lambda k: F.filter(bits, lambda x, i: i % 4 == k)
    none = F.lit(0).cast("long")
    return [F.aggregate(part(k), none, lambda a, b: a.bitwiseXOR(b)).alias(name) for k, name in enumerate(_FOLDS)]


def _close_folds() -> Column:
    """The folded sketches alone do not rule the pair out."""
    apart = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in _FOLDS), F.lit(0))
    return 7 * apart <= F.col("n_a") + F.col("n_b")


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that neither sizes nor bit sketches rule out."""
    for end in "ab":
        own = nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
        pairs = pairs.join(own, end)
        if end == "b":
            pairs = pairs.where(_alike_in_size("n_a", "n_b"))
    close = 7 * _hamming("bits_a", "bits_b") <= F.col("n_a") + F.col("n_b")
    return pairs.where(close).select("a", "b").distinct()


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id may be in ``ids``: a bitmap of fixed size goes to
    every task, so that texts nobody asks for are not shuffled."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_MARKS)) + 1
    maps = ids.select(place.alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket"))
    maps = stored(maps.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bitmap")), "marks")
    rows = docs.withColumn("p", place).withColumn("bucket", F.expr("bitmap_bucket_number(p)"))
    rows = rows.join(F.broadcast(maps), "bucket")
    byte = F.expr("conv(hex(substring(bitmap, cast(bitmap_bit_position(p) div 8 + 1 as int), 1)), 16, 10)")
    on = F.expr("bit_get(value, cast(bitmap_bit_position(p) % 8 as int)) = 1")
    return rows.withColumn("value", byte.cast("int")).where(on).select(*docs.columns)


def _links(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard index of 3/4 or more."""

    def make():
        return lambda texts: ([s.view(np.int64) for s in shingle_sets(texts, WIDTH)],)

    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    sets = map_texts(_marked(docs, ids), ["doc_id"], "text", make, "tokens array<long>")
    both = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("of_b")), "b")
    both = both.join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("of_a")), "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    return both.where(100 * shared >= 75 * union).select("a", "b")


def jaccard_join(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Two documents link when their sets of 5-word shingles have a Jaccard index
    of 3/4 or more; ``component_id`` is the smallest id reachable by links. A
    null text, or one without words, has no shingles and links with nothing.
    Rows with one id are one document with several texts. A null id takes no
    part: its component is null.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    profile = stored(_profile(docs), "profile")
    counters = _histogram(profile)
    rows = profile.where("part is null").select("doc_id", "n", "fp", "bits")
    known = rows.where("doc_id is not null and n > 0")
    classes = stored(
        known.groupBy("fp").agg(F.min(F.struct("doc_id", "n", "bits")).alias("r")).select("fp", "r.*"), "classes"
    )
    nodes = classes.select(F.col("doc_id").alias("node"), "n", "bits")
    order = spark.sparkContext.broadcast(counters)

    def make():
        worker_cache("ngram_join")
        return lambda texts: ([join_keys(s, order.value).view(np.int64) for s in shingle_sets(texts, WIDTH)],)

    keys = map_texts(docs.where("doc_id is not null"), ["doc_id"], "text", make, "keys array<long>")
    keys = keys.join(classes.select("doc_id").distinct(), "doc_id", "left_semi")
    keys = keys.select(F.col("doc_id").alias("node"), F.explode("keys").alias("key"))
    same = Window.partitionBy("key")
    shared = stored(
        keys.withColumn("pivot", F.min("node").over(same)).withColumn("last", F.max("node").over(same))
        .where("pivot != last").drop("last"),
        "shared_keys",
    )

    # first, every node with the one pivot it shares most keys with
    ties = shared.where("node != pivot").groupBy("node", "pivot").count()
    ties = ties.groupBy("node").agg(F.max(F.struct("count", -F.col("pivot"))).alias("m"))
    ties = ties.select(F.col("node").alias("b"), (-F.col("m")["col2"]).alias("a"))
    first = stored(_links(stored(_possible(ties, nodes), "pairs"), docs), "links")
    joined = stored(connected(first), "joined")

    # then what is still apart within a key, the smaller parts against all
    apart = shared.select("key", "node").join(joined, "node", "left")
    apart = apart.withColumn("component", F.coalesce("component", "node"))
    sizes = apart.groupBy("key", "component").count()
    main = sizes.groupBy("key").agg(
        F.max(F.struct("count", "component")).alias("m"), F.count(F.lit(1)).alias("parts")
    )
    main = stored(main.where("parts > 1").select("key", F.col("m")["component"].alias("main")), "mixed_keys")
    apart = apart.join(main, "key").join(nodes.select("node", "n", *_folds("bits")), "node")
    own = ["node", "component", "n", *_FOLDS]
    apart = stored(apart.select("key", "main", *own), "apart")
    one = apart.where("component != main").select("key", *(F.col(c).alias(f"{c}_b") for c in own))
    other = apart.select("key", "main", *(F.col(c).alias(f"{c}_a") for c in own))
    across = one.join(other, "key").where(
        (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_a") == F.col("main")) | (F.col("node_a") < F.col("node_b")))
        & _alike_in_size("n_a", "n_b")
        & _close_folds()
    )
    across = stored(across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "across")
    pairs = stored(_possible(across, nodes), "pairs")
    second = _links(pairs, docs)
    of = joined.select(F.col("node"), F.col("component"))
    lifted = second.join(of.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left")
    lifted = lifted.join(of.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left")
    lifted = lifted.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))

    # rows with one id hold their sets together
    member = rows.join(classes.select("fp", F.col("doc_id").alias("rep")), "fp", "left")
    member = stored(
        member.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")).alias("rep")),
        "members",
    ).join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
    member = member.select("doc_id", "n", F.coalesce("component", "rep").alias("part"))
    held = member.where("doc_id is not null").groupBy("doc_id").agg(F.min("part").alias("a"), F.max("part").alias("z"))
    held = stored(held.where("a != z").select("doc_id", "a"), "repeated_ids")
    held = member.join(held, "doc_id").select("a", F.col("part").alias("b"))
    final = connected(lifted.unionByName(held))
    member = member.join(final.select(F.col("node").alias("part"), F.col("component")), "part", "left")
    return member.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "part")).alias("component_id"),
    )
