"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches of rising id. A batch keeps each of its line keys once,
with the smallest id that holds it, and merge-anti-joins all earlier runs; what
is left is a new run. A line stays when its key stands in the run of its own
batch under its own document. Runs are bucketed and sorted by hash, so a later
batch meets them bucket by bucket without moving them. As soon as ``fanout`` runs
stand on a level, they are merged into one run of the next, so a batch meets a
number of runs that grows with the logarithm of the number of batches.

Only hashes travel until the end, when the places of dropped lines meet their
documents once. A key is two independent 64-bit hashes. Everything is DataFrame
work, without Python workers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.llm.common import remove_folder
from touchline.session import scratch_dir

#: White space at the ends of a line that its key leaves out.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A key with at least this share of a batch's lines is a heavy one; there are
#: at most so many of them, so they may be broadcast.
HEAVY_KEYS = 2_000

_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() changes nothing but A-Z in a text of one-byte characters
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id``, ``text_id``, ``pos`` and the key's hashes of every line whose key
    has at least ``least`` characters; ``docs`` has ``doc_id`` and ``text``. The
    place of a line belongs to a text, named by its hash, so that several texts
    under one id do not mix."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc_id", "text_id", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= least).select(
        "doc_id", "text_id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


class LineRuns:
    """The keys of all lines seen so far, as levels of sorted runs.

    Runs are tables of one file per bucket in the shared scratch folder. Batches
    must come in the order in which the first one wins.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3) -> None:
        if fanout < 2:
            raise ValueError("fanout must be 2 at least")
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self._paths: dict[str, str] = {}

    def runs(self) -> list[DataFrame]:
        """All runs, the largest first."""
        return [self.spark.table(name) for level in reversed(self.levels) for name in level]

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self._paths[name] = scratch_dir(self.spark, name)
        (
            rows.repartition(self.buckets, *_HASH).write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH)
            .option("path", self._paths[name]).format("parquet").saveAsTable(name)
        )
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        remove_folder(self.spark, self._paths.pop(name))

    def close(self) -> None:
        """Remove all runs."""
        for name in list(self._paths):
            self._drop(name)
        self.levels = [[]]

    def compact(self) -> None:
        """Merge the runs of every full level into one run of the next. Runs share
        no key, so merging needs no further look at their rows."""
        for at, level in enumerate(self.levels):
            if len(level) < self.fanout:
                continue
            if at + 1 == len(self.levels):
                self.levels.append([])
            merged = self.spark.table(level[0])
            for name in level[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self.levels[at + 1].append(self._write(merged))
            for name in level:
                self._drop(name)
            self.levels[at] = []

    def add(self, lines: DataFrame, path: str) -> None:
        """Write the lines (as ``hashed_lines`` gives them) that an earlier batch or
        a smaller id of this batch holds to ``path``, and add a run of the rest.

        Keys of very many lines are looked up in a small broadcast table; their
        lines are then spread over all tasks of the join instead of meeting in one.
        """
        total = lines.count()
        if not total:
            lines.select("doc_id", "text_id", "pos").write.parquet(path)
            return
        self.compact()
        counted = lines.groupBy(*_HASH).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
        batch = self._write(counted)
        fresh = self.spark.table(batch)
        for run in self.runs():
            fresh = fresh.join(run.select(*_HASH), _HASH, "left_anti")
        own = self._write(fresh.select(*_HASH, "first"))
        self.levels[0].append(own)

        firsts = self.spark.table(own).withColumn("own", F.lit(True))
        often = self.spark.table(batch).where(F.col("n") >= max(200, total / HEAVY_KEYS)).select(*_HASH)
        heavy = often.join(firsts, _HASH, "left").select(
            *_HASH, F.lit(True).alias("heavy"), F.col("own").alias("heavy_own"), F.col("first").alias("heavy_first")
        )
        at_home = lambda own, first: F.coalesce(F.col(own), F.lit(False)) & F.col(first).eqNullSafe(F.col("doc_id"))
        sure = F.col("heavy").isNotNull()
        left = lines.join(F.broadcast(heavy), _HASH, "left").where(~(sure & at_home("heavy_own", "heavy_first")))
        spread = left.select(
            "doc_id", "text_id", "pos", sure.alias("sure"),
            F.when(sure, F.xxhash64("doc_id", "text_id", "pos")).otherwise(F.col("h1")).alias("h1"),
            F.when(sure, F.lit(0).cast("long")).otherwise(F.col("h2")).alias("h2"),
        )
        dropped = spread.join(firsts, _HASH, "left").where(F.col("sure") | ~at_home("own", "first"))
        dropped.select("doc_id", "text_id", "pos").write.parquet(path)
        self._drop(batch)


def _batch(bounds: Sequence[float]) -> Column:
    """The number of bounds below an id; rows without an id come last."""
    number = F.lit(0)
    for bound in bounds:
        number = number + F.when(F.col("doc_id").cast("double") > bound, 1).otherwise(0)
    return F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(number)


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = 10, batches: int = 4, fanout: int = 3,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every row with ``doc_id``, ``n_lines``, ``n_dropped`` and ``kept``, its text
    without the lines that a document of smaller id holds; and the columns
    ``keep``, one named like a result as ``in_<name>``.

    Lines end at ``\\n``. A line's key leaves out white space at both ends and
    writes A-Z small; keys below ``least`` characters always stay. Within the
    smallest id that holds a key all its lines stay, also repeated ones. A null or
    empty text is one empty line, kept as an empty text. Rows with the same id are
    one document; rows without an id are one document behind all others. A long
    text is exploded into lines in its task. ``batches`` changes the work, never
    the result.
    """
    spark = docs.sparkSession
    names = {c: f"in_{c}" if c in ("doc_id", "n_lines", "n_dropped", "kept") else c for c in keep}
    kept = [F.col(f"`{c}`").alias(f"_keep{n}") for n, c in enumerate(names)]
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), *kept,
    )
    shares = [n / batches for n in range(1, batches)]
    bounds = sorted(set(rows.approxQuantile("doc_id", shares, 0.01))) if shares else []
    hashes = scratch_dir(spark, "line_hashes")
    hashed_lines(rows, least).withColumn("batch", _batch(bounds)).write.partitionBy("batch").parquet(hashes)
    schema = "doc_id long, text_id long, pos int, h1 long, h2 long, batch int"
    lines = spark.read.schema(schema).parquet(hashes)

    places = scratch_dir(spark, "dropped_lines")
    runs = LineRuns(spark, fanout)
    for number in range(len(bounds) + 2):
        runs.add(lines.where(F.col("batch") == number).drop("batch"), f"{places}/batch={number}")
    runs.close()
    remove_folder(spark, hashes)

    dropped = spark.read.schema("doc_id long, text_id long, pos int, batch int").parquet(places)
    gone = dropped.groupBy(F.col("doc_id").alias("gone_id"), F.col("text_id").alias("gone_text")).agg(F.collect_set("pos").alias("gone"))
    # split before the join, so that the lines are made once and not per line kept
    whole = rows.withColumn("text_id", F.xxhash64("text")).withColumn("lines", split_lines(F.col("text"))).drop("text")
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_id") == F.col("gone_text"))
    met = whole.join(gone, same, "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text_kept = F.array_join(F.when(F.size("gone") == 0, F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i))), "\n")
    return met.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
        text_kept.alias("kept"), *(F.col(f"_keep{n}").alias(names[c]) for n, c in enumerate(names)),
    )
