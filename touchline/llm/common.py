"""Helpers the operators share: Arrow passes over texts, written tables, the fold."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from touchline.session import scratch_dir

#: Bytes of text a Python task handles at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

#: Bytes of an Arrow batch between Spark and a Python task.
BATCH_BYTES = 4 << 20


_CACHES: dict[str, dict] = {}


def worker_cache(operator: str) -> dict:
    """What an operator keeps in a Python worker from task to task. A worker
    keeps that of one operator only: the next operator's task drops it, so a
    worker that serves many stages needs no more memory than the largest."""
    if operator not in _CACHES:
        _CACHES.clear()
        _CACHES[operator] = {}
    return _CACHES[operator]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(column: str = "doc_id") -> Column:
    """True for the rows no model may learn from; a null id counts as learnable
    by nothing, so it is held out too."""
    remainder = F.crc32(F.col(column).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(True))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: later steps
    then restart from files that every executor sees."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(docs: DataFrame) -> DataFrame:
    """Let the session send texts to Python in small batches: the default counts
    rows, and ten thousand long texts at once would fill a worker."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def _slices(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > SLICE_BYTES:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def map_texts(
    docs: DataFrame,
    keep: Sequence[str],
    text: str,
    make: Callable[[], Callable[[list], Sequence[Sequence]]],
    out: str,
) -> DataFrame:
    """Columns ``keep`` of every row, and the columns ``out`` made of its text.

    ``make()`` runs once per task and gives a function from a list of texts
    (None for null) to one list per column of ``out``. Rows come in slices of
    about a megabyte, so a task's memory follows its longest text. A text that
    is kept as well goes to Python once.
    """
    schema = T.StructType([*(docs.schema[k] for k in keep), *T.StructType.fromDDL(out)])
    arrow = to_arrow_schema(schema)
    kept = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = batch.column(at)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for start, end in _slices(sizes):
                made = work(texts.slice(start, end - start).to_pylist())
                columns = [batch.column(i).slice(start, end - start) for i in range(len(kept))]
                columns += [pa.array(m, type=arrow.field(len(kept) + i).type) for i, m in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    own = "_text"
    while own in kept:
        own += "_"
    whole = text in kept and docs.schema[text].dataType == T.StringType()
    at = kept.index(text) if whole else len(kept)
    sent = small_batches(docs).select(*kept, *([] if whole else [F.col(text).cast("string").alias(own)]))
    return sent.mapInArrow(run, schema)


def bounded_ids(df: DataFrame, column: str, most: int) -> list:
    """At most ``most`` ids, those of smallest hash: the same ones on every run.
    The result has a fixed bound, so the driver may hold it."""
    picked = df.select(column).where(F.col(column).isNotNull())
    picked = picked.orderBy(F.xxhash64(column), column).limit(most)
    return [r[0] for r in picked.collect()]


def rows_of_ids(docs: DataFrame, column: str, ids: list) -> DataFrame:
    """The rows with one of these ids; the list is bounded, so it is broadcast."""
    spark, kind = docs.sparkSession, docs.schema[column].dataType
    picked = spark.createDataFrame([(i,) for i in ids], T.StructType([T.StructField(column, kind)]))
    return docs.join(F.broadcast(picked), column, "left_semi")
