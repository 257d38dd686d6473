"""Readers of the lake: JSON documents, CSV tables, Parquet layers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from touchline import schemas
from touchline.functions.scores import json_score_text
from touchline.functions.stats import is_object
from touchline.session import scratch_dir

INGESTED, FILE, BLOCK, POSITION = schemas.LINEAGE

# Order of rows as they lie in the lake: file, part of the file, row.
SOURCE_ORDER = (FILE, BLOCK, POSITION)

# Order of versions of a row: the file that landed last wins.
LATEST_ORDER = (INGESTED, *SOURCE_ORDER)


def season_folder(season: str) -> str:
    return season.replace("/", "-")


def layer_path(
    root: str,
    layer: str,
    season: str | None = None,
    matchweek: int | None = None,
    match_id: int | None = None,
    ext: str = "json",
    stamp: str = "",
) -> str:
    """K1: where an object of a layer lives."""
    base = f"{root.rstrip('/')}/{layer if layer in schemas.LAYERS else schemas.LAYERS[0]}"
    if not season:
        return f"{base}/misc/{stamp}.{ext}"
    base = f"{base}/{season_folder(season)}"
    if not matchweek:
        return f"{base}/data/{stamp}.{ext}"
    if not match_id:
        return f"{base}/aggregates/mw{matchweek:02d}_{stamp}.{ext}"
    return f"{base}/matchweek_{matchweek:02d}/match_{match_id}.{ext}"


def layer_path_column(root: str, layer: str, match_id: Column, season: Column, matchweek: Column) -> Column:
    """K1 for a whole table: the path of each match document."""
    base = f"{root.rstrip('/')}/{layer if layer in schemas.LAYERS else schemas.LAYERS[0]}/"
    return F.concat(
        F.lit(base), F.replace(season, F.lit("/"), F.lit("-")),
        F.format_string("/matchweek_%02d/match_%d.json", matchweek, match_id),
    )


def bundle_path_column(layer: str, season: Column, matchweek: Column, stamp: str, ext: str = "json") -> Column:
    """K1: below the root, where the bundle of each matchweek lives."""
    return F.concat(
        F.lit(f"{layer if layer in schemas.LAYERS else schemas.LAYERS[0]}/"), F.replace(season, F.lit("/"), F.lit("-")),
        F.lit("/aggregates/mw"), F.format_string("%02d", matchweek), F.lit(f"_{stamp}.{ext}"),
    )


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none when it does not exist."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _with_source(df: DataFrame, *columns: Column) -> DataFrame:
    """Add the source order where the table does not store it. Rows of one
    part of a file are read by one task in file order, so the running number
    orders them."""
    source = {
        FILE: F.col("_metadata.file_path"),
        BLOCK: F.col("_metadata.file_block_start"),
        POSITION: F.monotonically_increasing_id(),
        INGESTED: F.col("_metadata.file_modification_time"),
    }
    return df.select(*columns, *[c.alias(n) for n, c in source.items() if n not in df.columns])


def _match_folders(root: str, layer: str, season: str, matchweek: int | None) -> str:
    base = f"{root.rstrip('/')}/{layer}/{season_folder(season)}"
    return f"{base}/matchweek_{matchweek:02d}" if matchweek else base


def scan_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    seasons: str | Sequence[str],
    matchweek: int | None = None,
    ext: str = "json",
) -> DataFrame:
    """Objects of a layer for one or more seasons; without a matchweek,
    everything below the season. The content of the objects is not read."""
    seasons = [seasons] if isinstance(seasons, str) else list(seasons)
    paths = [p for s in seasons if path_exists(spark, p := _match_folders(root, layer, s, matchweek))]
    return _listing(spark, paths, ext)


def scan_folder(spark: SparkSession, root: str, layer: str, seasons: str | Sequence[str], folder: str,
                ext: str = "csv") -> DataFrame:
    """S2 with ``aggregates``, S3 with ``analytics``: table files per season."""
    return _listing(spark, table_folders(spark, root, layer, seasons, folder), ext)


def table_folders(spark: SparkSession, root: str, layer: str, seasons: str | Sequence[str], folder: str) -> list[str]:
    seasons = [seasons] if isinstance(seasons, str) else list(seasons)
    paths = [f"{root.rstrip('/')}/{layer}/{season_folder(s)}/{folder}" for s in seasons]
    return [p for p in paths if path_exists(spark, p)]


def _listing(spark: SparkSession, paths: list[str], ext: str) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{ext}")
        .load(paths)
    )
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_documents(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, unreadable: DataFrame | None = None
) -> DataFrame:
    """Match documents with the declared schema.

    With ``multi_line`` a file holds one document or an array of documents, in
    any layout; without it, one document per line, and large files are split.
    A member of the wrong type is NULL, the rest of the document stays. Rows
    without match id are rejects (``rejects``, ``accepted``).

    A truncated or unreadable file ends the job, unless ``unreadable`` names it (a
    table as ``files.unreadable_files`` gives it): of these files no document is
    accepted, each is one reject with its reason, and all others are read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = (
        spark.read.schema(schemas.BRONZE_JSON)
        .option("multiLine", str(multi_line).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("recursiveFileLookup", "true")
    )
    # what a damaged file still gives is read and then left out as a whole
    raw = (reader if unreadable is None else reader.option("ignoreCorruptFiles", "true")).json(paths)
    info = F.from_json(F.when(is_object(F.col("match_info")), F.col("match_info")), schemas.STAT_MAP)
    kept = [F.col(c) for c in ("match_id", "url", "season", "matchweek", "scraped_at")]
    rest = [F.col(c) for c in ("statistics", "detailed_statistics", "events", "lineups", schemas.CORRUPT)]
    docs = _with_source(raw, *kept, F.col("match_info").alias("_raw_info"), info.alias("match_info"), *rest)
    docs = docs.withColumn("match_info", _whole_scores(F.col("_raw_info"), F.col("match_info"))).drop("_raw_info")
    if unreadable is None:
        return docs
    reason = F.concat(F.lit("unreadable file: "), "reason").alias(schemas.CORRUPT)
    bad = unreadable.select(F.col("source_file").alias(FILE), reason)
    return docs.join(bad, FILE, "left_anti").select(docs.columns).unionByName(bad, allowMissingColumns=True)


def _whole_scores(raw: Column, info: Column) -> Column:
    return F.transform_values(
        info,
        lambda k, v: F.when(k == "home_score", json_score_text(raw, info, "home_score"))
        .when(k == "away_score", json_score_text(raw, info, "away_score"))
        .otherwise(v),
    )


def accepted(docs: DataFrame) -> DataFrame:
    """Documents with a match id."""
    return docs.where(F.col("match_id").isNotNull())


def rejects(docs: DataFrame) -> DataFrame:
    """What could not be read as a document, with its file."""
    return docs.where(F.col("match_id").isNull()).select(FILE, schemas.CORRUPT)


def read_csv_table(
    spark: SparkSession, paths: str | Sequence[str], types: dict[str, str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Header CSV files, plain or gzip, by column name, with declared types.

    Files may have different columns in different order. Columns without a type
    in ``types`` are text. Missing-value texts are NULL, and ``2.0`` in an
    integer column is 2. A row with more fields than its header is a reject
    (``csv_rejects``). Without ``multi_line`` no field may hold a line break,
    and large files are split.
    """
    rows, names = _csv_rows(spark, paths, multi_line)
    values = lambda n: F.get("_values", F.array_position("_names", F.lit(n)).cast("int") - 1)
    # a name the file lacks has position 0, and index -1 gives NULL
    columns = [typed_text(values(n), (types or {}).get(n)).alias(n) for n in names]
    return rows.where(~_overlong()).select(*columns, *LATEST_ORDER)


def csv_rejects(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Rows with more fields than their header, all of their fields, and their file."""
    rows, _ = _csv_rows(spark, paths, multi_line)
    fields = F.when(F.col(schemas.CORRUPT).isNull(), F.col("_values")).otherwise(_record_fields(F.col(schemas.CORRUPT)))
    return rows.where(_overlong()).select(FILE, F.transform(fields, lambda f: F.coalesce(f, F.lit(""))).alias("fields"))


def _field(i: Column) -> Column:
    return F.col("record")[F.concat(F.lit("_c"), i.cast("string"))]


def _record_fields(record: Column) -> Column:
    """All fields of a CSV record: quoted ones with doubled quotes, or up to a comma."""
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(
        found,
        lambda f: F.when(F.startswith(f, F.lit('"')), F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f),
    )


def _overlong() -> Column:
    """True for a record with more fields than its header, empty ones included.

    The reader has as many columns as the widest header. A record of just so many
    fields comes without its text; of any other the text is there and has the last
    word, looked into only where it holds enough commas."""
    text, width = F.col(schemas.CORRUPT), F.size("_names")
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    return F.when(text.isNull(), F.size("_values") > width).otherwise((commas >= width) & (F.size(_record_fields(text)) > width))


def _csv_rows(spark: SparkSession, paths: str | Sequence[str], multi_line: bool) -> tuple[DataFrame, list[str]]:
    """The rows of CSV files as ``_values`` beside the ``_names`` of their file,
    and all names.

    The headers are the first records of the files, read by the CSV grammar. They
    stay a table, however many files and layouts there are; the driver only
    learns the distinct names, which the result has as columns anyway. One scan
    then reads all files.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)

    def reader(header: bool):
        return (
            spark.read.option("header", str(header).lower()).option("quote", '"').option("escape", '"')
            .option("multiLine", str(multi_line).lower()).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.{csv,csv.gz}")
        )

    first = (
        reader(False).option("singleVariantColumn", "record").csv(paths)
        .where(F.col("_metadata.file_block_start") == 0)
        .select(
            F.col("_metadata.file_path").alias(FILE),
            F.expr("cast(record as map<string,string>)").alias("record"),
            F.monotonically_increasing_id().alias(POSITION),
        )
        .withColumn("names", F.transform(F.sequence(F.lit(0), F.size("record") - 1), _field))
        .where(F.exists("names", lambda n: n.isNotNull() & (n != "")))
    )
    headers = first.groupBy(FILE).agg(F.min_by("names", POSITION).alias("names"))
    clean = F.transform("names", lambda n: F.regexp_replace(F.coalesce(n, F.lit("")), "^\\ufeff", ""))
    path = scratch_dir(spark, "csv_headers")
    headers.select(FILE, clean.alias("_names")).write.parquet(path)
    headers = spark.read.schema(f"{FILE} string, _names array<string>").parquet(path)
    names = [r[0] for r in headers.select(F.explode("_names").alias("n")).where("n != ''").distinct().orderBy("n").collect()]
    if not names:
        raise ValueError("no CSV table found")
    width = headers.agg(F.max(F.size("_names"))).first()[0]
    fields = [f"_c{i}" for i in range(width)]
    raw = (
        reader(True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .schema(", ".join(f"{f} string" for f in [*fields, schemas.CORRUPT])).csv(paths)
    )
    rows = _with_source(raw, F.array(*fields).alias("_values"), F.col(schemas.CORRUPT))
    return rows.join(headers, FILE), names


def typed_text(c: Column, kind: str | None) -> Column:
    """A CSV text as its declared type; missing-value texts are NULL."""
    text = F.when(~c.isin(*schemas.CSV_MISSING), c)
    if kind in ("int", "bigint"):
        number = text.try_cast("double")
        return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    if kind == "double":
        number = text.try_cast("double")
        return F.when(~F.isnan(number), number)
    return text if kind in (None, "string") else text.try_cast(kind)


def read_layer(
    spark: SparkSession,
    path: str,
    seasons: Sequence[str] | None = None,
    matchweeks: Sequence[int] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """A Parquet layer; season and matchweek prune partitions. Source order
    columns are added unless the layer stores them."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    raw = reader.parquet(path)
    # The filters come before the row positions: Spark moves no filter below
    # those, and would read every partition.
    if seasons is not None:
        raw = raw.where(F.col("season").isin(*seasons))
    if matchweeks is not None:
        raw = raw.where(F.col("matchweek").isin(*matchweeks))
    return _with_source(raw, *[F.col(c) for c in raw.columns])


def read_folders(spark: SparkSession, path: str, folders: Iterable[str], schema: str) -> DataFrame:
    """Some partitions of a Parquet layer, with source order; at least one."""
    raw = spark.read.schema(schema).option("basePath", path).parquet(*sorted(folders))
    return _with_source(raw, *[F.col(c) for c in raw.columns])


def try_read_layer(spark: SparkSession, path: str, **kw) -> DataFrame | None:
    """A layer, or nothing when it does not exist or has no files."""
    try:
        return read_layer(spark, path, **kw)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
