"""Writers of the lake."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline import schemas
from touchline.functions.stats import keep_home_away, keep_struct_stats
from touchline.sources.lake import list_folder

PARTITIONS = ("season", "matchweek")


def by_partition(df: DataFrame, partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """Bring rows of a partition together before a write.

    REBALANCE splits a hot partition over several tasks and joins small ones,
    which a plain repartition on the same columns would not.
    """
    return df.hint("rebalance", *[F.col(c) for c in partitions])


def run_stamp(at: datetime | None = None) -> str:
    """Name of a run: ``20250816_100000_000000``. Later runs sort later."""
    return (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S_%f")


def write_layer(df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS) -> None:
    """K1, K8: Parquet by season and matchweek. Only the partitions that occur in
    ``df`` are replaced."""
    (
        by_partition(df, partitions).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """K2: UTF-8 documents, one per line; members that are NULL are written."""
    df.write.mode(mode).option("ignoreNullFields", "false").option("compression", compression).json(path)


def write_bundles(docs: DataFrame, path: str) -> None:
    """K3: the documents of each season and matchweek together, as JSON lines of
    one partition. Nothing gathers a matchweek in one row or task."""
    (
        by_partition(docs).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false")
        .partitionBy(*PARTITIONS).json(path)
    )


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BRONZE).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """K4, K6: header CSV with doubled quotes; NULL is an empty field."""
    (
        df.write.mode(mode).option("header", "true").option("quote", '"').option("escape", '"')
        .option("emptyValue", "").option("compression", compression).csv(path)
    )


def long_rows(docs: DataFrame) -> DataFrame:
    """K5: one row per raw statistic with both values."""
    info = F.col("match_info")
    return docs.select(
        "match_id",
        info["home_team"].alias("home_team"),
        info["away_team"].alias("away_team"),
        F.explode(keep_struct_stats(F.col("statistics"))).alias("stat_name", "_json"),
    ).select(
        "match_id", "home_team", "away_team", "stat_name", keep_home_away(F.col("_json")).alias("_pair")
    ).select(
        "match_id", "home_team", "away_team", "stat_name",
        F.col("_pair.home").alias("home_value"), F.col("_pair.away").alias("away_value"),
    )


def write_csv_long(docs: DataFrame, path: str, compression: str = "none") -> None:
    write_csv(long_rows(docs), path, compression=compression)


def flat_row(docs: DataFrame) -> DataFrame:
    """K6: a document without statistics as one flat row; nested members as JSON."""

    def flat(name: str, kind: str) -> Column:
        c = F.col(name)
        return (F.to_json(c) if kind.startswith(("struct", "map", "array")) else c).alias(name)

    none = F.coalesce(F.size("statistics"), F.lit(0)) == 0
    return docs.where(none).select(*[flat(n, t) for n, t in docs.dtypes if n != "statistics"])


def csv_columns(df: DataFrame) -> DataFrame:
    """A table for a CSV export: nested columns as JSON."""
    nested = ("struct", "map", "array")
    return df.select(*[(F.to_json(c) if t.startswith(nested) else F.col(c)).alias(c) for c, t in df.dtypes])


def write_formats(
    docs: DataFrame, path: str, formats: Sequence[str] = ("json",), compression: str = "none"
) -> dict[str, str]:
    """K7: the documents in each wanted format; returns format -> path. Statistics
    repeat their names in every row, so ``gzip`` makes a small part of them.

    The JSON table is written first and read back for the CSV, so the input is
    computed once and no cache has to survive the loss of an executor.
    """
    out = {}
    source = docs
    if "json" in formats:
        out["json"] = f"{path}/json"
        write_json(docs, out["json"], compression=compression)
        source = docs.sparkSession.read.schema(docs.schema).json(out["json"])
    if "csv" in formats:
        out["csv"] = f"{path}/csv"
        write_csv_long(source, out["csv"], compression)
    return out


def write_snapshot(df: DataFrame, path: str, stamp: str | None = None) -> str:
    """K9: a new version next to the older ones; returns its folder."""
    folder = f"{path.rstrip('/')}/run_id={stamp or run_stamp()}"
    df.write.mode("error").parquet(folder)
    return folder


def complete_snapshots(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions that were written to the end, in order."""
    runs = [n for n in list_folder(spark, path) if n.startswith("run_id=")]
    return [n for n in runs if "_SUCCESS" in list_folder(spark, f"{path.rstrip('/')}/{n}")]


def latest_snapshot(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete version. Versions are named by the time of
    their run, so names sort as they were made."""
    base = path.rstrip("/")
    for name in reversed([n for n in list_folder(spark, base) if n.startswith("run_id=")]):
        if "_SUCCESS" in list_folder(spark, f"{base}/{name}"):
            return f"{base}/{name}"
    return None


def _bucket_note(spark: SparkSession, folder: str):
    note = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_buckets")
    return note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), note


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest state table; empty before the first run.

    A version written in buckets is read as a bucketed table, which this makes known to
    the session's catalog under a name of its own: joins on ``match_id`` then leave the
    state where it lies."""
    folder = latest_snapshot(spark, path)
    if folder is None:
        return spark.createDataFrame([], schemas.STATE)
    fs, note = _bucket_note(spark, folder)
    if not fs.exists(note):
        return spark.read.schema(schemas.STATE).parquet(folder)
    stream = fs.open(note)
    buckets = stream.readInt()
    stream.close()
    name = f"touchline_state_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
    where = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schemas.STATE}) USING parquet "
        f"CLUSTERED BY (match_id) SORTED BY (match_id) INTO {buckets} BUCKETS LOCATION '{where}'"
    )
    return spark.table(name)


def write_state(state: DataFrame, path: str, stamp: str | None = None, buckets: int | None = None) -> str:
    """The state as a new version, bucketed and sorted by match. The old one stays
    readable while it is the source of the new one. An upsert of a bucketed state
    comes in buckets already, so nothing is shuffled here."""
    spark = state.sparkSession
    folder = f"{path.rstrip('/')}/run_id={stamp or run_stamp()}"
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"touchline_state_{uuid.uuid4().hex}"
    (
        state.write.mode("error").format("parquet").bucketBy(number, "match_id").sortBy("match_id")
        .option("path", folder).saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay
    fs, note = _bucket_note(spark, folder)
    out = fs.create(note, True)
    out.writeInt(number)
    out.close()
    return folder
