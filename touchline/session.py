"""Session settings the operators rely on, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_OPEN_COST = "spark.sql.files.openCostInBytes"


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators need.

    Statistics maps follow "a later entry replaces the value of an earlier one
    and keeps its position", which is Spark's LAST_WIN policy. Under the default
    policy the same plans fail on a duplicate key instead of giving a wrong row.

    The JVM leaves methods above 8000 bytes of code interpreted. Parsing several
    statistics in one projection generates such methods; with the limit Spark
    compiles their expressions as smaller ones.

    A layer has many small partitions. Spark lists folders with a task for each, up
    to a number of tasks, and joins what it writes to tasks of a megabyte; with the
    limits here there are some tasks for each core instead, in both cases. A file to
    open counts as 64 KB of a task's input, not as 4 MB: tasks read small files by the
    hundreds, where they read four with input of 16 MB for a task.
    """
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    most = int(spark.conf.get(_LISTING_TASKS))
    spark.conf.set(_LISTING_TASKS, str(min(most, 4 * spark.sparkContext.defaultParallelism)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    # the value is as it was set, with or without a unit
    cost = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_OPEN_COST))
    spark.conf.set(_OPEN_COST, str(min(cost, 64 * 1024)))
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: executors
    of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="touchline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/touchline/{name}-{uuid.uuid4().hex}"
