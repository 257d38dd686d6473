"""Row numbers of keys of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.session import scratch_dir

_PART = "_part"


def ranged_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """The rows by ranges of key and order, with the number of their range. They are
    written to the shared folder: ranges are cut by a sample, so another run of the
    same job could cut elsewhere."""
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "ranged")
    df.repartitionByRange(n, *keys, *order).withColumn(_PART, F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(f"{_ddl(df)}, {_PART} int").parquet(path)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rn", parts: int | None = None
) -> DataFrame:
    """``row_number()`` per key in ``order``, whatever share of the rows a key has.

    Rows are cut into ranges of (key, order), numbered within range and key, and then
    moved up by the rows of their key in earlier ranges. A range ends inside one key at
    most, so these offsets are fewer than the ranges and may be broadcast. ``order``
    should have no ties; of rows that tie, any may come first.
    """
    rows = ranged_rows(df, keys, order, parts)
    within = Window.partitionBy(_PART, *keys).orderBy(*order)
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(_PART, *keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(F.col(_PART).alias("_at"), *(F.col(k).alias(f"_of_{k}") for k in keys), F.sum("_n").over(before).alias("_before"))
    offsets = offsets.where("_before is not null")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.col(_PART) == F.col("_at"))
    local = rows.withColumn(name, F.row_number().over(within)).join(F.broadcast(offsets), same, "left")
    moved = (F.col(name) + F.coalesce("_before", F.lit(0))).cast("bigint").alias(name)
    return local.select(*df.columns, moved)
