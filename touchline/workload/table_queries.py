"""Queries for sources, sinks, joins, aggregates, extraction and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import dedupe, extract, masters
from touchline.operators import state as state_ops
from touchline.operators.counts import goal_count, layer_counts, player_count
from touchline.operators.documents import clean_documents, flatten_documents, merge_stat_maps
from touchline.operators.gold import all_perspectives, team_alias_match, team_record
from touchline.operators.ranking import numbered
from touchline.operators.silver import stat_pivot, to_long, to_wide
from touchline.plans import medallion as jobs
from touchline.session import scratch_dir
from touchline.sources import lake, objects, seasons, sinks
from touchline.sources.files import unreadable_files
from touchline.sources.pages import with_elements
from touchline.streaming import incremental
from touchline.workload import oracle as o
from touchline.workload.registry import query
from touchline.workload.scalar_queries import _LATEST_STATE
from touchline.workload.tables import (
    BASE_URL, STAT_NAMES, TEAM, card_pages, documents, full_documents, matches, raw_pages, raw_stats, result_pages,
    season_requests, state, table,
)

_FIXED_SQL = o.with_(o.MATCHES) + f"SELECT {o.FIXED} FROM matches"
_COUNT_SQL = o.with_(o.MATCHES) + """SELECT season, matchweek, count(*) AS n_rows FROM matches GROUP BY season, matchweek"""
_TYPES = {**schemas.SILVER_FIXED_TYPES}


def _silver(spark, sf):
    return jobs.bronze_to_silver(documents(spark, sf))


def _written_json(spark, sf, name):
    path = scratch_dir(spark, name)
    sinks.write_json(full_documents(spark, sf), path)
    return lake.read_documents(spark, path, multi_line=False)


# --- sources ------------------------------------------------------------------


def _seasons_of(df):
    """The seasons a table has: a value per year, so the driver may hold them."""
    return sorted(r[0] for r in df.select("season").distinct().collect())


@query("s1_scan_layer", _COUNT_SQL)
def s1(spark, sf):
    """Documents whose files the listing of their season's folder has."""
    root = scratch_dir(spark, "s1")
    docs = full_documents(spark, sf).withColumn("week", F.col("matchweek"))
    found = _seasons_of(matches(spark, sf))
    for season in found:
        own = docs.where(F.col("season") == season)
        own.write.partitionBy("week").json(f"{root}/bronze/{lake.season_folder(season)}")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    listed = lake.scan_layer(spark, root, "bronze", found).select(plain("path").alias("path"))
    read = lake.read_documents(spark, [f"{root}/bronze/{lake.season_folder(s)}" for s in found], multi_line=False)
    return layer_counts(read.withColumn("path", plain(lake.FILE)).join(listed, "path", "left_semi"))


def _csv_halves(spark, sf, root):
    """Two weekly tables with different columns: with and without scores."""
    m = matches(spark, sf)
    played = F.col("home_score").isNotNull()
    folder = f"{root}/silver/{lake.season_folder('1995/96')}/aggregates"
    sinks.write_csv(m.where(played), f"{folder}/mw01")
    sinks.write_csv(m.where(~played).select("away_team", "home_team", "referee", "venue", "date", "matchweek", "season", "match_id"),
                    f"{folder}/mw02")
    return lake.table_folders(spark, root, "silver", ["1995/96", "1996/97"], "aggregates")


@query("s2_scan_aggregates", _FIXED_SQL)
def s2(spark, sf):
    folders = _csv_halves(spark, sf, scratch_dir(spark, "s2"))
    return lake.read_csv_table(spark, folders, _TYPES).select(*schemas.SILVER_FIXED)


@query("s3_scan_gold", o.with_(o.MATCHES) + o.gold(names=(), source="matches"))
def s3(spark, sf):
    """Gold tables of the seasons that have any."""
    root = scratch_dir(spark, "s3")
    gold = team_record(matches(spark, sf), TEAM, ())
    sinks.write_csv(gold, f"{root}/gold/1995-96/analytics/t_mw1")
    types = {"match_id": "bigint", "matchweek": "int", "is_home": "boolean", "goals_scored": "int",
             "goals_conceded": "int", "score": "int"}
    folders = lake.table_folders(spark, root, "gold", ["1994/95", "1995/96"], "analytics")
    return lake.read_csv_table(spark, folders, types).select(*gold.columns)


@query("s4_read_json_doc", _FIXED_SQL)
def s4(spark, sf):
    return jobs.bronze_to_silver(_written_json(spark, sf, "s4")).select(*schemas.SILVER_FIXED)


@query("s5_scan_bronze_docs", o.with_(o.MATCHES) + f"""SELECT match_id, '{BASE_URL}/match/' || CAST(match_id AS VARCHAR) AS url,
  season, matchweek, date || 'T10:00:00.000000' AS scraped_at, 8 AS n_stats FROM matches""")
def s5(spark, sf):
    docs = _written_json(spark, sf, "s5")
    return docs.select("match_id", "url", "season", "matchweek", "scraped_at", F.size("statistics").alias("n_stats"))


@query("s6_read_csv_table", """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag,
  CAST(l_quantity AS INTEGER) AS quantity, CASE WHEN l_linestatus = 'O' THEN l_discount END AS discount FROM lineitem""")
def s6(spark, sf):
    """Missing-value texts become NULL and ``2.0`` an integer."""
    path = scratch_dir(spark, "s6")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", "N/A").otherwise(F.col("l_returnflag")).alias("flag"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.when(F.col("l_linestatus") == "O", F.col("l_discount").cast("string")).otherwise("NaN").alias("discount"),
    )
    sinks.write_csv(rows, path)
    types = {"l_orderkey": "bigint", "l_linenumber": "int", "quantity": "int", "discount": "double"}
    return lake.read_csv_table(spark, path, types).select("l_orderkey", "l_linenumber", "flag", "quantity", "discount")


@query("s7_skip_empty_inputs", o.with_(o.MATCHES) + """SELECT 'document' AS kind, count(*) AS n FROM matches
  UNION ALL SELECT 'reject', count(*) FROM conversations""")
def s7(spark, sf):
    """Texts that are no documents lie between the documents."""
    path = scratch_dir(spark, "s7")
    sinks.write_json(full_documents(spark, sf), path)
    table(spark, sf, "conversations").select(F.concat(F.lit("not json "), F.regexp_replace("text", r"\s", " "))).write.mode("append").text(f"{path}/more")
    docs = lake.read_documents(spark, path, multi_line=False)
    kinds = [("document", lake.accepted(docs)), ("reject", lake.rejects(docs))]
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in kinds]
    return rows[0].unionByName(rows[1])


_UNREADABLE = """texts AS (SELECT conv_id % 40 AS part, count(*) AS n FROM conversations GROUP BY 1)"""


@query("s4_unreadable_files", f"WITH {_UNREADABLE} " + """SELECT 'document' AS kind, part, n FROM texts WHERE part % 5 <> 0
  UNION ALL SELECT 'reject', part, 1 FROM texts WHERE part % 5 = 0""")
def s4_unreadable(spark, sf):
    """Compressed files of which every fifth is cut: each of these is one reject, and
    all documents of the others are read."""
    path = scratch_dir(spark, "s4_unreadable")
    part = F.col("conv_id") % 40
    docs = table(spark, sf, "conversations").select(
        part.alias("match_id"), F.concat(F.lit("p"), part.cast("string")).alias("url"), F.lit(1).alias("matchweek"), "text"
    )
    # one file per folder; the number of its folder names it
    docs.repartition("match_id").withColumn("part", F.col("match_id")).write.partitionBy("part").option("compression", "gzip").json(path)
    packed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("part", "content")
    cut = F.when(F.col("part") % 5 == 0, F.substring("content", 1, (F.length("content") / 2).cast("int"))).otherwise(F.col("content"))
    files_of = scratch_dir(spark, "s4_cut")
    objects.put_files(packed.select(F.format_string("%02d.json.gz", F.col("part").cast("int")).alias("path"), cut.alias("content")), files_of)
    docs = lake.read_documents(spark, files_of, multi_line=False, unreadable=unreadable_files(spark, files_of))
    number = F.regexp_extract(lake.FILE, r"(\d+)\.json\.gz$", 1).cast("bigint").alias("part")
    kinds = [("document", lake.accepted(docs)), ("reject", lake.rejects(docs))]
    counted = [df.groupBy(number).agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "part", "n") for k, df in kinds]
    return counted[0].unionByName(counted[1])


@query("s7_csv_rejects", """SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'reject' ELSE 'row' END AS kind, l_orderkey, CAST(l_linenumber AS BIGINT) AS line,
  CASE WHEN l_linenumber = 3 THEN '3|' || l_returnflag || ',"x"||' WHEN l_linenumber = 6 THEN '6|' || l_returnflag || '|||'
    ELSE CAST(l_linenumber AS VARCHAR) END AS fields FROM lineitem""")
def s7_csv(spark, sf):
    """Records with more fields than their header, of which the surplus ones may be
    empty, or commas and quotes stand in quoted ones: whole records become rejects."""
    path = scratch_dir(spark, "s7_csv")
    n = F.col("l_linenumber")
    rest = F.when(n == 3, F.concat(F.lit(',"'), "l_returnflag", F.lit(',""x""",,'))).when(n == 6, F.concat(F.lit(","), "l_returnflag", F.lit(",,,")))
    record = F.concat_ws(",", "l_orderkey", n.cast("string"))
    lines = table(spark, sf, "lineitem").select(F.concat(record, F.coalesce(rest, F.lit(""))).alias("l_orderkey,line"))
    # the records as they are: no quoting by the writer
    lines.write.option("header", "true").option("sep", "\x01").option("quote", "").csv(path)
    rows = lake.read_csv_table(spark, path, {"l_orderkey": "bigint", "line": "bigint"})
    rejects = lake.csv_rejects(spark, path)
    number = lambda i: F.col("fields")[i].cast("bigint")
    left = rejects.select(F.lit("reject").alias("kind"), number(0).alias("l_orderkey"), number(1).alias("line"),
                          F.concat_ws("|", F.slice("fields", 2, 99)).alias("fields"))
    return rows.select(F.lit("row").alias("kind"), "l_orderkey", "line", F.col("line").cast("string").alias("fields")).unionByName(left)


@query("s8_rows_to_table", o.SILVER + f"SELECT match_id, {o.val('v_home_rating_grade')} AS grade_value, "
       f"{o.text('v_home_rating_grade')} AS grade_text, {o.val('v_away_shots')} AS shots FROM flat")
def s8(spark, sf):
    """A declared schema keeps numbers, texts and columns without any value."""
    flat = _silver(spark, sf)
    grade = F.col("stats")["rating_grade"]["home"]
    return flat.select("match_id", grade["value"].alias("grade_value"), grade["text"].alias("grade_text"),
                       F.col("stats")["shots"]["away"]["value"].alias("shots"))


_KEYS = ["l_orderkey", "l_linenumber"]
_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def _keep_last_sql(source: str, columns: str = _LINE) -> str:
    order = ", ".join(f"{c} DESC" for c in _ORDER)
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
  FROM {source}) WHERE rn = 1"""


@query("s9_source_order", _keep_last_sql("lineitem"))
def s9(spark, sf):
    """The last row per key as the rows lie in the files of a sorted table."""
    path = scratch_dir(spark, "s9")
    table(spark, sf, "lineitem").select(*_LINE.split(", "), "l_shipdate").orderBy(*_ORDER).write.parquet(path)
    return dedupe.keep_last(lake.read_layer(spark, path), _KEYS, lake.SOURCE_ORDER).select(*_LINE.split(", "))


_DIM = "(VALUES " + ", ".join(
    f"('{y}/{(y + 1) % 100:02d}', {y}, {i})" for y, i in schemas.SEASON_START_MATCH_ID.items()
) + ") AS dim(season, season_id, start_match_id)"
_REQUESTS = f"requests AS (SELECT DISTINCT {o.SEASON.format(d='o_orderdate', k=12)} AS season, {o.WEEK} AS matchweek FROM orders)"


@query("s10_season_dim", o.with_(_REQUESTS) + f"""SELECT r.season, CAST(season_id AS INTEGER) AS season_id,
  CAST(start_match_id AS BIGINT) AS start_match_id, count(*) AS n_weeks FROM requests r JOIN {_DIM} ON r.season = dim.season
  GROUP BY r.season, season_id, start_match_id""")
def s10(spark, sf):
    known = season_requests(spark, sf).join(F.broadcast(seasons.season_dim(spark)), "season")
    return known.groupBy("season", "season_id", "start_match_id").agg(F.count("*").alias("n_weeks"))


@query("s11_match_ids_for_matchweek", o.with_(_REQUESTS) + f"""SELECT r.season, matchweek,
  CAST(start_match_id + (matchweek - 1) * 10 + i AS BIGINT) AS match_id FROM requests r JOIN {_DIM} ON r.season = dim.season,
  unnest(generate_series(0, 9)) AS g(i)""")
def s11(spark, sf):
    return seasons.match_ids(season_requests(spark, sf), spark)


@query("s12_all_matchweeks", o.with_(o.MATCHES) + """SELECT season, CAST(i AS INTEGER) AS matchweek
  FROM (SELECT DISTINCT season FROM matches), unnest(generate_series(1, 38)) AS g(i)""")
def s12(spark, sf):
    return seasons.all_matchweeks(matches(spark, sf).select("season").distinct())


# --- sinks --------------------------------------------------------------------


@query("k1_layer_path", o.with_(o.MATCHES) + """SELECT match_id, 'lake/bronze/' || replace(season, '/', '-') || '/matchweek_' ||
  lpad(CAST(matchweek AS VARCHAR), 2, '0') || '/match_' || CAST(match_id AS VARCHAR) || '.json' AS path FROM matches""")
def k1(spark, sf):
    path = lake.layer_path_column("lake", "unknown", F.col("match_id"), F.col("season"), F.col("matchweek"))
    return matches(spark, sf).select("match_id", path.alias("path"))


@query("k1_objects", o.with_(o.MATCHES) + """SELECT 'object' AS kind, 'bronze/' || replace(season, '/', '-') || '/matchweek_' || lpad(CAST(matchweek AS VARCHAR), 2, '0') ||
  '/match_' || CAST(match_id AS VARCHAR) || '.json' AS path, match_id, home_team, 8 AS n_stats FROM matches
  UNION ALL SELECT 'bundle', 'bronze/' || replace(season, '/', '-') || '/aggregates/mw' || lpad(CAST(matchweek AS VARCHAR), 2, '0') || '_t.json',
  match_id, home_team, 8 FROM matches""")
def k1_objects(spark, sf):
    """One JSON object per match and one JSON array per matchweek, at their paths: the
    listing has them, and the reader gives their documents."""
    root = scratch_dir(spark, "k1_objects")
    docs = full_documents(spark, sf)
    docs.write.parquet(f"{root}_docs")
    docs = spark.read.schema(docs.schema).parquet(f"{root}_docs")
    objects.write_objects(docs, root, lake.layer_path_column("", "bronze", F.col("match_id"), F.col("season"), F.col("matchweek")))
    objects.write_arrays(docs, root, lake.bundle_path_column("bronze", F.col("season"), F.col("matchweek"), "t"), F.col("match_id"))
    found = _seasons_of(docs)
    listed = lake.scan_layer(spark, root, "bronze", found).select(F.col("path").alias(lake.FILE))
    read = lake.read_documents(spark, [f"{root}/bronze/{lake.season_folder(s)}" for s in found])
    read = read.join(listed, lake.FILE, "left_semi")
    below = F.regexp_extract(lake.FILE, "(bronze/.*)$", 1).alias("path")
    team = F.trim(F.regexp_replace(F.col("match_info")["home_team"], r"\s", "")).alias("home_team")
    return read.select(F.when(F.contains(lake.FILE, F.lit("/aggregates/")), "bundle").otherwise("object").alias("kind"), below, "match_id", team,
                       F.size("statistics").alias("n_stats"))


@query("k2_write_json", _FIXED_SQL)
def k2(spark, sf):
    path = scratch_dir(spark, "k2")
    m = matches(spark, sf)
    sinks.write_json(m, path)
    return spark.read.schema(m.schema).json(path)


@query("k3_write_bundle", o.with_(o.MATCHES) + """SELECT season, matchweek, count(*) AS n_docs,
  CAST(sum(match_id) AS BIGINT) AS id_sum FROM matches GROUP BY season, matchweek""")
def k3(spark, sf):
    path = scratch_dir(spark, "k3")
    sinks.write_bundles(documents(spark, sf), path)
    bundles = sinks.read_bundles(spark, path).groupBy("season", "matchweek")
    return bundles.agg(F.count("*").alias("n_docs"), F.sum("match_id").alias("id_sum"))


@query("k4_write_csv_flat", "SELECT doc_id, text, lang, source FROM documents")
def k4(spark, sf):
    """Whole texts with quotes and line breaks come back as they were."""
    path = scratch_dir(spark, "k4")
    sinks.write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), path)
    return (
        spark.read.schema("doc_id bigint, text string, lang string, source string")
        .option("header", "true").option("escape", '"').option("multiLine", "true").option("lineSep", "\n").csv(path)
    )


_LONG_CSV = o.with_(o.MATCHES, o.RAW, o.ORDER_STATS, o.JOINED) + " UNION ALL ".join(
    f"SELECT match_id, home_team, away_team, '{v}' AS stat_name, trim(h{k}) AS home_value, trim(a{k}) AS away_value FROM joined"
    for k, v in o.STAT_OF_LINE.items())


def _clean_long(df):
    strip = [F.btrim(F.col(c), F.lit(" \t\n")).alias(c) for c in ("home_team", "away_team")]
    values = [F.trim(c).alias(c) for c in ("home_value", "away_value")]
    return df.select("match_id", *strip, "stat_name", *values)


@query("k5_write_csv_long", _LONG_CSV)
def k5(spark, sf):
    path = scratch_dir(spark, "k5")
    sinks.write_csv_long(documents(spark, sf), path)
    return _clean_long(lake.read_csv_table(spark, path, {"match_id": "bigint"}))


@query("k6_write_csv_single", o.with_(o.MATCHES) + "SELECT match_id, season, matchweek, home_team FROM matches WHERE home_score IS NULL")
def k6(spark, sf):
    """Documents without statistics become one flat row each."""
    path = scratch_dir(spark, "k6")
    m = matches(spark, sf)
    none = F.when(F.col("home_score").isNotNull(), F.create_map(F.lit("a"), F.lit("{}")))
    sinks.write_csv(sinks.flat_row(m.withColumn("statistics", none)), path)
    return lake.read_csv_table(spark, path, _TYPES).select("match_id", "season", "matchweek", "home_team")


@query("k7_write_multi_format", _LONG_CSV.replace("WITH", "WITH", 1))
def k7(spark, sf):
    """Both formats hold the same statistics, neither one more."""
    path = scratch_dir(spark, "k7")
    made = sinks.write_formats(full_documents(spark, sf), path, ("json", "csv"), "gzip")
    from_csv = _clean_long(lake.read_csv_table(spark, made["csv"], {"match_id": "bigint"}))
    from_json = _clean_long(sinks.long_rows(lake.read_documents(spark, made["json"], multi_line=False)))
    # what one of them has more often shows up as further rows
    sides = [rows.withColumn("_n", F.lit(n)) for rows, n in ((from_csv, 1), (from_json, -1))]
    more = sides[0].unionByName(sides[1]).groupBy(*from_csv.columns).agg(F.abs(F.sum("_n")).cast("int").alias("_n")).where("_n > 0")
    return from_csv.unionByName(more.withColumn("_n", F.explode(F.array_repeat(F.lit(1), F.col("_n")))).drop("_n"))


@query("k8_write_silver", o.SILVER + f"SELECT {o.FIXED}, {o.wide()} FROM flat")
def k8(spark, sf):
    path = scratch_dir(spark, "k8")
    wide = to_wide(_silver(spark, sf), STAT_NAMES)
    sinks.write_layer(wide, path)
    return spark.read.schema(wide.schema).parquet(path).select(*wide.columns)


@query("k9_versioned_snapshot", _FIXED_SQL)
def k9(spark, sf):
    """The newest of two versions is read; the older one stays."""
    path = scratch_dir(spark, "k9")
    m = matches(spark, sf)
    sinks.write_snapshot(m.withColumn("referee", F.lit("old")), path, "20250101_000000_000000")
    sinks.write_snapshot(m, path, "20250102_000000_000000")
    return spark.read.parquet(sinks.latest_snapshot(spark, path))


@query("k10_write_state", o.with_(_LATEST_STATE) + "SELECT match_id, status, epoch_us(ts) AS updated FROM latest")
def k10(spark, sf):
    """A stream's version, then a job's: the job's is read."""
    path = scratch_dir(spark, "k10")
    new = state(spark, sf).drop("event_id")
    early = new.withColumn("status", F.lit("EARLIER")).withColumn("last_updated", F.to_timestamp(F.lit("1970-01-01")))
    stream = f"{sinks.run_stamp()}_stream_0123456789ab_000000000007"
    sinks.write_state(state_ops.upsert_state(sinks.read_state(spark, path), early), path, stream)
    sinks.write_state(state_ops.upsert_state(sinks.read_state(spark, path), new), path)
    return sinks.read_state(spark, path).select("match_id", "status", F.unix_micros("last_updated").alias("updated"))


# --- joins --------------------------------------------------------------------


@query("j1_state_anti_join", o.with_(o.MATCHES, _LATEST_STATE) + """SELECT match_id, season, matchweek, home_team FROM matches m
  WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.match_id = m.match_id AND l.status = 'PLAYED')""")
def j1(spark, sf):
    keyed = dedupe.keep_last(state(spark, sf), ["match_id"], ["last_updated", "status"])
    return state_ops.skip_played(matches(spark, sf).select("match_id", "season", "matchweek", "home_team"), keyed)


@query("j2_season_lookup", o.with_(_REQUESTS) + f"""SELECT r.season, matchweek, CAST(season_id AS INTEGER) AS season_id,
  CAST(start_match_id AS BIGINT) AS start_match_id FROM requests r JOIN {_DIM} ON r.season = dim.season""")
def j2(spark, sf):
    return seasons.season_lookup(season_requests(spark, sf), spark)


@query("j3_state_upsert", o.with_(o.MATCHES, _LATEST_STATE) + """SELECT coalesce(m.match_id, l.match_id) AS match_id,
  CASE WHEN m.match_id IS NULL THEN l.status WHEN m.home_score IS NULL THEN 'SCHEDULED' ELSE 'PLAYED' END AS status
  FROM matches m FULL JOIN latest l ON m.match_id = l.match_id""")
def j3(spark, sf):
    """Matches replace the states that events of the same id left."""
    old = dedupe.keep_last(state(spark, sf).drop("event_id"), ["match_id"], ["last_updated", "status"])
    new = state_ops.match_states(documents(spark, sf), F.to_timestamp("scraped_at"))
    return state_ops.upsert_state(old, new).select("match_id", "status")


def _stored_state(spark, sf):
    """One state per id, as the last run wrote it: bucketed by match."""
    path = scratch_dir(spark, "state")
    sinks.write_state(dedupe.keep_last(state(spark, sf).drop("event_id"), ["match_id"], ["last_updated", "status"]), path)
    return sinks.read_state(spark, path)


@query("j1_bucketed_state", o.with_(o.MATCHES, _LATEST_STATE) + """SELECT match_id, season, matchweek, home_team FROM matches m
  WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.match_id = m.match_id AND l.status = 'PLAYED')""")
def j1_bucketed(spark, sf):
    """The stored state stays in its buckets; only the work list moves."""
    return state_ops.skip_played(matches(spark, sf).select("match_id", "season", "matchweek", "home_team"), _stored_state(spark, sf))


@query("j3_bucketed_state", o.with_(o.MATCHES, _LATEST_STATE) + """SELECT coalesce(m.match_id, l.match_id) AS match_id,
  CASE WHEN m.match_id IS NULL THEN l.status WHEN m.home_score IS NULL THEN 'SCHEDULED' ELSE 'PLAYED' END AS status
  FROM matches m FULL JOIN latest l ON m.match_id = l.match_id""")
def j3_bucketed(spark, sf):
    """The stored state after an upsert, written and read again."""
    path = scratch_dir(spark, "state_after")
    new = state_ops.match_states(documents(spark, sf), F.to_timestamp("scraped_at"))
    sinks.write_state(state_ops.upsert_state(_stored_state(spark, sf), new), path)
    return sinks.read_state(spark, path).select("match_id", "status")


_BOTH_SIDES = """sides AS (SELECT match_id, home_team AS team, away_team AS opponent, home_score AS gs, away_score AS gc FROM matches
  UNION ALL SELECT match_id, away_team, home_team, away_score, home_score FROM matches)"""


@query("j4_team_alias_match", o.with_(o.MATCHES, _BOTH_SIDES) + """SELECT match_id, team, opponent, r_name AS club, gs AS goals_scored
  FROM sides JOIN nation ON team = n_name JOIN region ON n_regionkey = r_regionkey""")
def j4(spark, sf):
    """Every nation is an alias of its region."""
    alias = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    alias = alias.select(F.col("n_name").alias("alias"), F.col("r_name").alias("club"))
    rows = team_alias_match(all_perspectives(matches(spark, sf)), alias)
    return rows.select("match_id", "team", "opponent", "club", "goals_scored")


# --- aggregation and de-duplication -------------------------------------------

@query("a1_dedupe_keep_last_silver", _keep_last_sql("lineitem"))
def a1(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE.split(", "), "l_shipdate")
    return masters_keep(rows).drop("l_shipdate")


def masters_keep(rows):
    return dedupe.keep_last(rows, _KEYS, _ORDER)


@query("a2_dedupe_keep_last_gold", "SELECT match_id, last_event, value FROM (SELECT user_id AS match_id, event_id AS last_event, value, "
       "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def a2(spark, sf):
    rows = table(spark, sf, "events").select(F.col("user_id").alias("match_id"), F.col("event_id").alias("last_event"), "value", "ts")
    return masters.gold_master(rows, ["ts", "last_event"]).drop("ts")


@query("a3_merge_stat_maps", o.with_(o.MATCHES, o.RAW, o.ORDER_STATS, o.JOINED) + """SELECT match_id,
  CASE WHEN venue = 'MACHINERY' THEN 11 ELSE 8 END AS n_stats, h1 AS passes_home, a5 AS xg_home, h5 AS xg_away FROM joined""")
def a3(spark, sf):
    merged = documents(spark, sf).select(
        "match_id", merge_stat_maps(F.col("statistics"), F.col("detailed_statistics")).alias("m"))
    home, away = (lambda n: F.get_json_object(F.col("m")[n], "$.home")), (lambda n: F.get_json_object(F.col("m")[n], "$.away"))
    return merged.select("match_id", F.size("m").alias("n_stats"), home("Passes Completed (%)").alias("passes_home"),
                         home("XG").alias("xg_home"), away("XG").alias("xg_away"))


@query("a4_stat_name_collision", o.SILVER_LONG + """SELECT match_id, side, stat, value, pct, text FROM long
  WHERE stat IN ('passes_completed', 'shots')""")
def a4(spark, sf):
    long = to_long(_silver(spark, sf))
    return long.where(F.col("stat").isin("passes_completed", "shots")).select("match_id", "side", "stat", "value", "pct", "text")


@query("a5_layer_counts", _COUNT_SQL)
def a5(spark, sf):
    return layer_counts(matches(spark, sf))


@query("a6_event_lineup_counts", o.with_(o.MATCHES) + """SELECT match_id,
  CAST(coalesce(home_score, 0) + coalesce(away_score, 0) AS INTEGER) AS goals, 11 AS home_players, 11 AS away_players FROM matches""")
def a6(spark, sf):
    docs = extract.assemble_documents(extract.extract_tabs(with_elements(raw_pages(spark, sf, ("main", "lineups")).drop("season", "matchweek"))))
    return docs.select("match_id", goal_count(F.col("events")).alias("goals"),
                       player_count(F.col("lineups.home")).alias("home_players"), player_count(F.col("lineups.away")).alias("away_players"))


@query("a7_first_per_id", "SELECT conv_id, role, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS rn "
       "FROM conversations) WHERE rn = 1")
def a7(spark, sf):
    return dedupe.keep_first(table(spark, sf, "conversations"), ["conv_id", "role"], ["turn", "text"]).select("conv_id", "role", "turn")


_PIVOT = ", ".join(
    f"max({v}) FILTER (WHERE stat_name = '{n}') AS {side}_{s}, max({p}) FILTER (WHERE stat_name = '{n}') AS {side}_{s}_pct"
    for side in ("home", "away")
    for n, s in zip(o.STAT_OF_LINE.values(), STAT_NAMES)
    for v, p in [(o.val(side), o.pct(side))])


@query("a8_stat_pivot", o.with_(o.RAW) + f"SELECT match_id, {_PIVOT} FROM raw GROUP BY match_id")
def a8(spark, sf):
    """Raw rows of every line item, parsed, into one row per match."""
    from touchline.functions.stats import pair_percent, stat_value
    from touchline.functions.text import normalize_stat_name

    sides = F.map_from_arrays(F.array(F.lit("home"), F.lit("away")), F.array("home", "away"))
    rows = raw_stats(spark, sf).select("match_id", "stat_name", F.explode(sides).alias("side", "raw"))
    long = rows.select("match_id", "side", normalize_stat_name(F.col("stat_name")).alias("stat"),
                       stat_value(F.col("raw")).alias("value"), pair_percent(F.col("raw")).alias("pct"))
    return stat_pivot(long, STAT_NAMES)


# --- windows, sorts, limits, set operations -----------------------------------


@query("w1_row_number", "SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS INTEGER) AS rn FROM events")
def w1(spark, sf):
    """Row number per type and user, the window behind A1, A2, A7 and O2."""
    rows = numbered(table(spark, sf, "events"), ["event_type", "user_id"], ["ts", "event_id"])
    return rows.select("event_id", "user_id", F.col("rn").cast("int").alias("rn"))


@query("w1_hot_key", "SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY event_type = 'error' ORDER BY ts DESC, event_id) AS BIGINT) AS rn FROM events")
def w1_hot(spark, sf):
    """Two keys, of which one has most of the rows: it splits over the tasks."""
    events = table(spark, sf, "events").withColumn("key", F.col("event_type") == "error")
    return numbered(events, ["key"], [F.col("ts").desc(), F.col("event_id").asc()]).select("event_id", "user_id", "rn")


@query("o1_sort_master", _FIXED_SQL + " ORDER BY season, matchweek, match_id")
def o1(spark, sf):
    return masters.sort_master(matches(spark, sf))


@query("o2_top10_by_id", o.with_(o.MATCHES) + """SELECT match_id, season, matchweek, home_team FROM (SELECT *,
  row_number() OVER (PARTITION BY season, matchweek ORDER BY match_id) AS rn FROM matches) WHERE rn <= 10""")
def o2(spark, sf):
    return dedupe.top_by_id(matches(spark, sf).select("match_id", "season", "matchweek", "home_team"))


@query("o3_slice_lineup", """SELECT c_custkey, CASE WHEN c_custkey % 30 >= 22 THEN 11 ELSE 0 END AS n_home,
  CASE WHEN c_custkey % 30 >= 22 THEN 'P22' END AS last_away FROM customer""")
def o3(spark, sf):
    """Lists of 0 to 29 players."""
    n = (F.col("c_custkey") % 30).cast("int")
    player = lambda i: F.struct(F.concat(F.lit("P"), i.cast("string")).alias("name"), F.lit(None).cast("string").alias("number"))
    players = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), player)).otherwise(
        F.array().cast("array<struct<name:string,number:string>>"))
    home, away = extract.slice_lineup(players)
    return table(spark, sf, "customer").select(
        "c_custkey", F.size(home).alias("n_home"), F.try_element_at(away, F.lit(-1))["name"].alias("last_away"))


@query("o4_first_container", """SELECT page_id, regexp_extract(html, '<li><a href="([^"]*)"', 1) AS first_href,
  CAST(least(len(regexp_extract_all(html, '<li>')), 2) AS INTEGER) AS n_taken FROM pages""")
def o4(spark, sf):
    """The first link inside a list item, and at most two list items."""
    from touchline.functions.dom import is_tag, select_all

    pages = with_elements(table(spark, sf, "pages").select("page_id", "html"), links=True)
    items = select_all(F.col("elements"), is_tag("li"))
    link = select_all(F.col("elements"), is_tag("a"), F.get(items, F.lit(0)))
    return pages.select("page_id", F.get(link, F.lit(0))["href"].alias("first_href"), F.size(F.slice(items, 1, 2)).alias("n_taken"))


_UNION = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_tax FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL BY NAME SELECT l_shipdate, l_extendedprice, l_quantity, l_suppkey, l_partkey, l_linenumber, l_orderkey FROM lineitem WHERE l_linestatus <> 'O')"""


def _union(spark, sf):
    lines = table(spark, sf, "lineitem").select(*_LINE.split(", "), "l_shipdate", "l_tax", "l_linestatus")
    is_open = F.col("l_linestatus") == "O"
    return masters.union_tables([lines.where(is_open).drop("l_linestatus"), lines.where(~is_open).drop("l_linestatus", "l_tax")])


@query("u1_union_silver", f"SELECT {_LINE}, l_tax FROM {_UNION}")
def u1(spark, sf):
    return _union(spark, sf).drop("l_shipdate")


@query("u2_union_gold", o.with_(o.MATCHES) + " UNION ALL BY NAME ".join(
    f"SELECT match_id, team, result, opponent, score{extra} FROM ({o.gold(team, (), 'matches')})"
    for team, extra in (("NATION_3", ", venue"), ("NATION_4", ""))))
def u2(spark, sf):
    """Gold of two teams, the second without venue."""
    keep = ["match_id", "team", "result", "opponent", "score"]
    a, b = (team_record(matches(spark, sf), [t], ()) for t in ("NATION_3", "NATION_4"))
    return masters.union_tables([a.select(*keep, "venue"), b.select(*keep)])


_U3 = o.gold(names=(), source="matches")


@query("u3_append_gold", o.with_(o.MATCHES) + f"""SELECT 'all' AS part, match_id, result, matchweek, venue FROM ({_U3})
  UNION ALL SELECT 'week', match_id, result, matchweek, venue FROM ({_U3}) WHERE matchweek = 7
  UNION ALL SELECT 'kept', match_id, result, matchweek, venue FROM ({_U3})
  UNION ALL SELECT 'kept', match_id, result, matchweek, 'old' FROM ({_U3})""")
def u3(spark, sf):
    """Two runs over a season: the later row of each match, those of one week,
    and all rows when duplicates are wanted."""
    gold = team_record(matches(spark, sf), TEAM, ())
    at = lambda day: F.to_timestamp(F.lit(f"2025-01-0{day}"))
    runs = masters.union_tables([
        gold.withColumn("ingested_at", at(2)), gold.withColumn("venue", F.lit("old")).withColumn("ingested_at", at(1)),
    ])
    parts = {
        "all": masters.append_gold(runs), "week": masters.append_gold(runs, 7),
        "kept": masters.append_gold(runs, unique=False),
    }
    return masters.union_tables([
        df.select(F.lit(name).alias("part"), "match_id", "result", "matchweek", "venue") for name, df in parts.items()
    ])


# --- page extraction ----------------------------------------------------------


def _elements(spark, sf, tab):
    return with_elements(raw_pages(spark, sf, (tab,)).drop("season", "matchweek"))


_MATCH_HEAD = "match_id, home_team, away_team, home_score, away_score, date"


@query("x1_extract_match_cards", o.with_(o.MATCHES) + f"""SELECT {_MATCH_HEAD}, 'all' AS season,
  CAST(match_id // 12 AS INTEGER) AS matchweek FROM matches""")
def x1(spark, sf):
    """Pages with many cards, each of them twice."""
    return extract.extract_match_cards(with_elements(card_pages(spark, sf)))


@query("x2_extract_match_header", o.with_(o.MATCHES) + f"SELECT {_MATCH_HEAD}, venue, referee FROM matches")
def x2(spark, sf):
    info = _elements(spark, sf, "stats").select("match_id", extract.match_header(F.col("elements")).alias("i"))
    scores = [F.col("i")[c].cast("int").alias(c) for c in ("home_score", "away_score")]
    return info.select("match_id", *scores, *[F.col("i")[c].alias(c) for c in ("home_team", "away_team", "date", "venue", "referee")])


_PAGE_STATS = [("Passes Completed (%)", 1, "attack"), ("XG", 5, "attack"), ("undefined x", 4, "attack"),
               ("Distance Covered", 2, "physical"), ("Possession", 3, "physical")]


@query("x3_extract_stat_rows", o.with_(o.MATCHES, o.RAW, o.ORDER_STATS, o.JOINED) + " UNION ALL ".join(
    f"SELECT match_id, '{n}' AS stat_name, coalesce(trim(h{k}), '0') AS home, coalesce(trim(a{k}), '0') AS away, "
    f"coalesce(nullif(regexp_extract(coalesce(trim(h{k}), '0'), '^([0-9.]+)', 1), ''), trim(h{k})) AS home_parsed FROM joined"
    for n, k, _ in _PAGE_STATS))
def x3(spark, sf):
    rows = _elements(spark, sf, "stats").select("match_id", F.explode(extract.stat_rows(F.col("elements"))).alias("stat_name", "j"))
    return rows.select("match_id", "stat_name", F.from_json("j", "home string, away string, home_parsed string").alias("p")).select(
        "match_id", "stat_name", "p.*")


@query("x4_extract_stats_by_category", o.with_(o.MATCHES, o.RAW, o.ORDER_STATS, o.JOINED) + " UNION ALL ".join(
    f"SELECT match_id, '{c}' AS category, '{n}' AS stat_name, coalesce(trim(h{k}), '0') AS home, coalesce(trim(a{k}), '0') AS away FROM joined"
    for n, k, c in _PAGE_STATS if "undefined" not in n))
def x4(spark, sf):
    pair = "map<string,struct<home:string,away:string>>"
    rows = _elements(spark, sf, "stats").select("match_id", F.explode(extract.stats_by_category(F.col("elements"))).alias("category", "j"))
    return rows.select("match_id", "category", F.explode(F.from_json("j", pair)).alias("stat_name", "p")).select(
        "match_id", "category", "stat_name", "p.*")


_INFO = """date || ' 15:00' AS kickoff, venue AS stadium, CAST(match_id * 3 AS VARCHAR) AS attendance,
  CASE WHEN match_id % 2 = 0 THEN 'Ann ' || venue END AS referee"""


@query("x5_extract_match_info", o.with_(o.MATCHES) + f"SELECT match_id, {_INFO} FROM matches")
def x5(spark, sf):
    info = _elements(spark, sf, "match_info").select(
        "match_id", extract.match_info_tab(F.col("elements"), F.col("visible_text")).alias("i"))
    return info.select("match_id", *[F.col("i")[k].alias(k) for k in ("kickoff", "stadium", "attendance", "referee")])


_LINEUP = """'4-' || CAST(match_id % 4 + 1 AS VARCHAR) || '-2' AS home_formation, '3-5-2' AS away_formation,
  'Ann ' || venue AS home_manager, 'Bo Li' AS away_manager, 11 AS n_home, 11 AS n_away, 'A 11' AS last_away,
  CASE WHEN match_id % 2 = 0 THEN '11' END AS last_number, home_team || ' sub' AS home_subs, away_team || ' sub,two' AS away_subs"""


def _lineup_columns(c):
    home, away = c["home"], c["away"]
    names = lambda a: F.array_join(F.transform(a, lambda s: s["name"]), ",")
    last = F.try_element_at(away["starting_xi"], F.lit(-1))
    return [
        home["formation"].alias("home_formation"), away["formation"].alias("away_formation"),
        home["manager"].alias("home_manager"), away["manager"].alias("away_manager"),
        F.size(home["starting_xi"]).alias("n_home"), F.size(away["starting_xi"]).alias("n_away"),
        last["name"].alias("last_away"), last["number"].alias("last_number"),
        names(home["substitutes"]).alias("home_subs"), names(away["substitutes"]).alias("away_subs"),
    ]


@query("x6_extract_lineups", o.with_(o.MATCHES) + f"SELECT match_id, {_LINEUP} FROM matches")
def x6(spark, sf):
    lineups = _elements(spark, sf, "lineups").select(
        "match_id", extract.lineups_tab(F.col("elements"), F.col("visible_text")).alias("l"))
    return lineups.select("match_id", *_lineup_columns(F.col("l")))


_EVENTS = """CAST(coalesce(home_score, 0) AS VARCHAR) || '-' || CAST(coalesce(away_score, 0) AS VARCHAR) AS half_time,
  CAST(coalesce(home_score, 0) AS INTEGER) AS n_home_goals, CAST(coalesce(away_score, 0) AS INTEGER) AS n_away_goals,
  CASE WHEN home_score > 0 THEN 'H 1''' END AS first_scorer, CASE WHEN away_score > 1 THEN 'A plain 2' END AS second_scorer,
  venue || ' 40''' AS yellow, referee AS red, 0 AS n_home_red"""


def _event_columns(e):
    return [
        e["half_time_score"].alias("half_time"), F.size(e["home_goals"]).alias("n_home_goals"), F.size(e["away_goals"]).alias("n_away_goals"),
        F.get(e["home_goals"], F.lit(0))["scorer"].alias("first_scorer"), F.get(e["away_goals"], F.lit(1))["scorer"].alias("second_scorer"),
        F.array_join(e["home_yellow_cards"], ",").alias("yellow"), F.array_join(e["away_red_cards"], ",").alias("red"),
        F.size(e["home_red_cards"]).alias("n_home_red"),
    ]


@query("x7_extract_events", o.with_(o.MATCHES) + f"SELECT match_id, {_EVENTS} FROM matches")
def x7(spark, sf):
    events = _elements(spark, sf, "main").select("match_id", extract.match_events(F.col("elements")).alias("e"))
    return events.select("match_id", *_event_columns(F.col("e")))


_DOC = f"""match_id, matchweek AS page_matchweek, home_team, home_score, {_INFO.replace('AS referee', 'AS final_referee')},
  {_EVENTS}, {_LINEUP}, 5 AS n_stats, CAST(2 AS INTEGER) AS n_physical"""


def _document_columns():
    info = F.col("match_info")
    picked = [info[k].alias(k) for k in ("home_team", "kickoff", "stadium", "attendance")]
    physical = F.from_json(F.col("detailed_statistics")["physical"], schemas.STAT_MAP)
    return [*picked, info["home_score"].cast("int").alias("home_score"), info["referee"].alias("final_referee"),
            *_event_columns(F.col("events")), *_lineup_columns(F.col("lineups")),
            F.size("statistics").alias("n_stats"), F.size(physical).alias("n_physical")]


@query("x8_assemble_document", o.with_(o.MATCHES) + f"SELECT {_DOC} FROM matches")
def x8(spark, sf):
    tabs = extract.extract_tabs(with_elements(raw_pages(spark, sf).drop("season", "matchweek")))
    return extract.assemble_documents(tabs).select("match_id", "page_matchweek", *_document_columns())


@query("x8_recaptured_pages", o.with_(o.MATCHES) + f"""SELECT {_DOC.replace('home_score,', 'CASE WHEN match_id % 2 = 0 THEN 4 ELSE home_score END AS home_score,', 1)} FROM matches""")
def x8_recaptured(spark, sf):
    """Every page was captured twice before, with other scores; of these captures none
    is parsed. The newest captures of even matches have a score of their own."""
    path = scratch_dir(spark, "x8_pages")
    now = raw_pages(spark, sf).drop("season", "matchweek")
    scored = lambda home: F.regexp_replace("html", r'(match-header__score">)[^<]*<', f"$1{home} – 1<")
    now = now.withColumn("html", F.when(F.col("match_id") % 2 == 0, scored(4)).otherwise(F.col("html")))
    old = now.withColumn("fetched_at", F.col("fetched_at") - F.expr("interval 30 days")).withColumn("html", scored(7))
    older = old.withColumn("fetched_at", F.col("fetched_at") - F.expr("interval 30 days")).withColumn("html", scored(9))
    now.unionByName(old).unionByName(older).write.option("compression", "zstd").parquet(path)
    pages = extract.newest_captures(spark.read.schema(now.schema).parquet(path), stored=True)
    docs = extract.assemble_documents(extract.extract_tabs(with_elements(pages)))
    return docs.select("match_id", "page_matchweek", *_document_columns())


# --- jobs ---------------------------------------------------------------------


@query("m1_bronze_to_silver", o.SILVER_LONG + "SELECT match_id, season, matchweek, side, stat, value, pct, text FROM long")
def m1(spark, sf):
    return jobs.silver_long(documents(spark, sf))


@query("m2_silver_to_gold", o.SILVER + o.gold())
def m2(spark, sf):
    return jobs.silver_to_gold(_silver(spark, sf), TEAM, STAT_NAMES, order=["date"])


@query("m3_global_masters", o.SILVER + f"""SELECT 'silver' AS master, match_id, season, matchweek, referee, {o.val('v_home_shots')} AS shots,
  CAST(NULL AS VARCHAR) AS team, CAST(NULL AS VARCHAR) AS result FROM flat
  UNION ALL SELECT 'gold', match_id, season, matchweek, NULL, NULL, team, result FROM ({o.gold(names=())})
  UNION ALL SELECT 'gold', match_id, season, matchweek, NULL, NULL, team, result FROM ({o.gold('NATION_4', ())})""")
def m3(spark, sf):
    """Both masters of Silver that has every match twice, the later one right,
    and of Gold of two teams that meet each other."""
    at = lambda day: F.to_timestamp(F.lit(f"2025-01-0{day}"))
    path = scratch_dir(spark, "m3")
    # Silver is a table, as in the lake: each master reads the columns it needs and no document anew
    made = _silver(spark, sf)
    made.write.parquet(path)
    now = spark.read.schema(made.schema).parquet(path).withColumn("ingested_at", at(2))
    silver = now.unionByName(now.withColumn("referee", F.lit("old")).withColumn("ingested_at", at(1)))
    gold = masters.union_tables([
        jobs.silver_to_gold(silver, [team], (), unique=False, lineage=["ingested_at"]) for team in (*TEAM, "NATION_4")
    ])
    whole, own = jobs.global_masters(silver, gold, ["ingested_at"])
    shots = F.col("stats")["shots"]["home"]["value"].alias("shots")
    keys = ["match_id", "season", "matchweek"]
    return masters.union_tables([
        whole.select(F.lit("silver").alias("master"), *keys, "referee", shots),
        own.select(F.lit("gold").alias("master"), *keys, "team", "result"),
    ])


@query("m3_key_order", o.with_(o.MATCHES) + """SELECT 'silver' AS master, match_id, 'mw9' AS venue, CAST(NULL AS VARCHAR) AS team FROM matches
  UNION ALL SELECT 'gold', match_id, 'mw9', home_team FROM matches WHERE home_team = 'NATION_3' OR away_team = 'NATION_3'""")
def m3_key_order(spark, sf):
    """Every match in two objects whose names sort as texts, and once more in a season
    that was read before; the later landing of the other versions does not count."""
    m = matches(spark, sf)
    found = _seasons_of(m)
    row = lambda name, season: m.withColumn("venue", F.lit(name)).withColumn("season", season).withColumns({
        lake.INGESTED: F.to_timestamp(F.lit(f"2025-01-{'01' if name == 'mw9' else '02'}")), lake.FILE: F.lit(name),
        lake.BLOCK: F.lit(0).cast("bigint"), lake.POSITION: F.col("match_id"),
    })
    own = F.col("season")
    silver = masters.union_tables([row("mw9", own), row("mw10", own), row("zz", F.lit("0000/01"))])
    gold = silver.withColumn("team", F.col("home_team")).withColumn("is_home", F.lit(True))
    gold = gold.where(F.col("home_team").isin(*TEAM) | F.col("away_team").isin(*TEAM))
    whole, own_rows = jobs.global_masters(silver, gold, keep="key_order", seasons=["0000/01", *found])
    return masters.union_tables([
        whole.select(F.lit("silver").alias("master"), "match_id", "venue", F.lit(None).cast("string").alias("team")),
        own_rows.select(F.lit("gold").alias("master"), "match_id", "venue", "team"),
    ])


@query("m4_clean_document", o.SILVER + f"""SELECT match_id, home_team, home_score, away_score,
  CASE WHEN venue = 'MACHINERY' THEN 10 ELSE 7 END AS n_stats, {o.val('h1')} AS first_value, {o.pct('h1')} AS first_pct,
  {o.val('a5')} AS xg_home FROM flat""")
def m4(spark, sf):
    cleaned = clean_documents(documents(spark, sf))
    first, xg = F.col("stats")[0]["home"], F.col("stats")[4]["home"]
    return cleaned.select("match_id", F.col("match_info")["home_team"].alias("home_team"), "home_score", "away_score",
                          F.size("stats").alias("n_stats"), first["value"].alias("first_value"), first["pct"].alias("first_pct"),
                          xg["value"].alias("xg_home"))


@query("m5_flatten_document", o.SILVER + f"SELECT {o.FIXED}, {o.wide()} FROM flat")
def m5(spark, sf):
    return to_wide(flatten_documents(clean_documents(documents(spark, sf))), STAT_NAMES)


@query("m6_team_record", o.SILVER + o.gold())
def m6(spark, sf):
    return team_record(_silver(spark, sf), TEAM, STAT_NAMES)


_ALL_TEAMS = """sides AS (SELECT match_id, season, matchweek, home_team AS team, away_team AS opponent, home_score AS goals_scored,
  away_score AS goals_conceded, v_home_rating_grade AS grade FROM flat UNION ALL
  SELECT match_id, season, matchweek, away_team, home_team, away_score, home_score, v_away_rating_grade FROM flat)"""


@query("m2_silver_to_gold_all", o.with_(o.MATCHES, o.RAW, o.ORDER_STATS, o.JOINED, o.FLAT, _ALL_TEAMS) + f"""SELECT match_id, season,
  matchweek, team, opponent, {o.WDL} AS result, goals_scored, {o.text('grade')} AS grade FROM sides""")
def m2_all(spark, sf):
    """Every match for both of its teams, statistics as they are in Gold by default."""
    rows = jobs.silver_to_gold_all(_silver(spark, sf))
    grade = F.col("stats")["rating_grade"]["text"].alias("grade")
    return rows.select("match_id", "season", "matchweek", "team", "opponent", "result", "goals_scored", grade)


# A season table that has all orders: match n is match n % 380 of season n // 380.
def _season_table(spark, sf):
    number = F.floor(F.col("o_orderkey") / 380).cast("int")
    known = table(spark, sf, "orders").select(number.alias("season_id")).distinct()
    season = F.format_string("%d/%02d", F.col("season_id"), F.pmod(F.col("season_id") + 1, F.lit(100)))
    return known.select(season.alias("season"), "season_id", (F.col("season_id") * 380).cast("bigint").alias("start_match_id"))


def _all_pages(spark, sf):
    return raw_pages(spark, sf).drop("season", "matchweek")


def _recaptured(spark, sf):
    """The pages as a later visit finds them: every match played, 4 - 1."""
    score = F.regexp_replace("html", r'(match-header__score">)[^<]*<', "$14 – 1<")
    later = F.col("fetched_at") + F.expr("interval 30 days")
    return _all_pages(spark, sf).withColumn("html", score).withColumn("fetched_at", later)


_PLACED = """placed AS (SELECT *, CAST(match_id // 380 AS VARCHAR) || '/' || lpad(CAST((match_id // 380 + 1) % 100 AS VARCHAR), 2, '0')
  AS own_season, CAST(match_id % 380 // 10 + 1 AS INTEGER) AS own_week FROM matches)"""
_VISITED = f"""CAST(coalesce(home_score, 0) AS INTEGER) AS n_home_goals, date || ' 15:00' AS kickoff, 11 AS n_away"""


def _visited_columns():
    info, events, lineups = F.col("match_info"), F.col("events"), F.col("lineups")
    return [
        info["home_team"].alias("home_team"), info["home_score"].cast("int").alias("home_score"),
        F.size(events["home_goals"]).alias("n_home_goals"), info["kickoff"].alias("kickoff"),
        F.size(lineups["away"]["starting_xi"]).alias("n_away"),
    ]


@query("m7_ingest_matchweek", o.with_(o.MATCHES, _PLACED) + f"""SELECT match_id, own_season AS season, own_week AS matchweek, home_team,
  4 AS home_score, {_VISITED}, 'PLAYED' AS status FROM placed WHERE home_score IS NULL""")
def m7(spark, sf):
    """Two visits over all tabs: the second one finds the open matches only."""
    root = scratch_dir(spark, "m7")
    seasons_of = _season_table(spark, sf)
    jobs.ingest(spark, root, _all_pages(spark, sf), None, stamp="20250101_000000_000000", season_table=seasons_of)
    second = jobs.ingest(spark, root, _recaptured(spark, sf), None, stamp="20250102_000000_000000", season_table=seasons_of)
    landed = second.select("match_id", "season", "matchweek", *_visited_columns())
    return landed.join(sinks.read_state(spark, f"{root}/state").select("match_id", "status"), "match_id")


@query("m7_ingest_stream", o.with_(o.MATCHES, _PLACED) + """SELECT match_id, own_season AS season, own_week AS matchweek, home_team,
  coalesce(home_score, 4) AS home_score, CASE WHEN home_score IS NULL THEN 2 ELSE 1 END AS n_landed, 'PLAYED' AS status FROM placed""")
def m7_stream(spark, sf):
    """The ingest as a stream over page files, in two turns: the second one finds new
    files, and lands the matches only that are not finished."""
    root, files = scratch_dir(spark, "m7_stream"), scratch_dir(spark, "m7_pages")
    seasons_of = _season_table(spark, sf)
    for pages in (_all_pages(spark, sf), _recaptured(spark, sf)):
        pages.where("tab = 'stats'").write.mode("append").parquet(files)
        incremental.ingest_stream(spark, files, root, None, f"{root}/progress", seasons_of).awaitTermination()
    landed = spark.read.schema(jobs.BRONZE_TABLE).parquet(f"{root}/bronze")
    newest = dedupe.keep_last(landed, ["match_id"], ["ingested_at"])
    info = F.col("match_info")
    newest = newest.select("match_id", "season", "matchweek", info["home_team"].alias("home_team"), info["home_score"].cast("int").alias("home_score"))
    counts = landed.groupBy("match_id").agg(F.count("*").cast("int").alias("n_landed"))
    return newest.join(counts, "match_id").join(sinks.read_state(spark, f"{root}/state").select("match_id", "status"), "match_id")


_MASTER_TEAMS = ("NATION_3", "NATION_4")
_AFTER = """visited AS (SELECT match_id, own_season AS season, own_week AS matchweek, home_team, away_team, date, venue,
  coalesce(home_score, 4) AS home_score, CASE WHEN home_score IS NULL THEN 1 ELSE away_score END AS away_score,
  coalesce(trim(h5), '0') AS raw_home, coalesce(trim(a5), '0') AS raw_away FROM placed LEFT JOIN order_stats ON match_id = s_match_id)"""


def _after_gold(team):
    xg = f"CASE WHEN home_team = '{team}' THEN {o.val('raw_home')} ELSE {o.val('raw_away')} END AS xg"
    return o.gold(team, (), f"(SELECT *, {xg} FROM visited)").replace("goals_scored AS score", "xg", 1)


@query("m8_run_medallion", o.with_(o.MATCHES, _PLACED, o.RAW, o.ORDER_STATS, _AFTER) + " UNION ALL ".join(
    f"SELECT match_id, season, matchweek, '{t}' AS club, team, opponent, is_home, result, goals_scored, goals_conceded, xg FROM ({_after_gold(t)})"
    for t in _MASTER_TEAMS))
def m8(spark, sf):
    """The Gold master after a run for one team and one for another, with open
    matches played in between."""
    root = scratch_dir(spark, "m8")
    seasons_of = _season_table(spark, sf)
    visits = zip(_MASTER_TEAMS, (_all_pages(spark, sf), _recaptured(spark, sf)), ("20250101_000000_000000", "20250102_000000_000000"))
    for team, pages, stamp in visits:
        jobs.run_medallion(spark, root, pages, None, aliases=[team], stamp=stamp, season_table=seasons_of)
    # the first team's Gold follows the later visit as well
    jobs.run_medallion(spark, root, None, None, aliases=[_MASTER_TEAMS[0]], skip_ingest=True, stamp="20250103_000000_000000")
    rows = spark.read.parquet(sinks.latest_snapshot(spark, f"{root}/gold_master"))
    return rows.select("match_id", "season", "matchweek", "club", "team", "opponent", "is_home", "result", "goals_scored",
                       "goals_conceded", F.col("stats")["xg"]["value"].alias("xg"))


@query("m8_medallion_documents", o.with_(o.MATCHES, _BOTH_SIDES) + f"""SELECT m.match_id, season, team, {o.WDL.replace('goals_scored', 'gs').replace('goals_conceded', 'gc')} AS result
  FROM sides s JOIN matches m ON s.match_id = m.match_id UNION ALL SELECT NULL, 'reject', NULL, CAST(count(*) AS VARCHAR) FROM conversations""")
def m8_documents(spark, sf):
    """The same job over a folder of JSON documents, for all teams; texts that
    are none become rejects."""
    root, path = scratch_dir(spark, "m8d"), scratch_dir(spark, "m8d_json")
    sinks.write_json(full_documents(spark, sf), path, compression="gzip")
    noise = F.concat(F.lit("not json "), F.regexp_replace("text", r"\s", " "))
    table(spark, sf, "conversations").select(noise).write.mode("append").text(f"{path}/more")
    docs = lake.read_documents(spark, path, multi_line=False)
    jobs.run_medallion(spark, root, None, None, documents=docs, all_teams=True, stamp="20250101_000000_000000")
    rows = spark.read.parquet(sinks.latest_snapshot(spark, f"{root}/gold_master")).select("match_id", "season", "team", "result")
    left = spark.read.parquet(f"{root}/rejects").agg(F.count("*").cast("string").alias("result"))
    return rows.unionByName(left.withColumn("season", F.lit("reject")), allowMissingColumns=True)


_MOVED = """now AS (SELECT * REPLACE (CASE WHEN match_id % 7 = 0 THEN CAST(matchweek % 38 + 1 AS INTEGER) ELSE matchweek END AS matchweek)
  FROM matches), per_layer AS (SELECT season, matchweek, count(*) AS n FROM now GROUP BY ALL)"""


@query("m8_moved_matches", o.with_(o.MATCHES, _MOVED) + """SELECT 'silver' AS layer, match_id, season, matchweek, CAST(NULL AS VARCHAR) AS team, 1 AS n FROM now
  UNION ALL SELECT 'gold', match_id, season, matchweek, home_team, 1 FROM now
  UNION ALL SELECT 'gold', match_id, season, matchweek, away_team, 1 FROM now
  UNION ALL SELECT 'count of ' || l.layer, NULL, season, matchweek, NULL, CAST(n AS INTEGER)
  FROM per_layer, (VALUES ('bronze'), ('silver'), ('gold')) AS l(layer)""")
def m8_moved(spark, sf):
    """A second run over the matches that moved to the week after: every match
    stands once in Silver, once per side in Gold, and once in the counts."""
    root = scratch_dir(spark, "m8_moved")
    docs = full_documents(spark, sf).withColumn(lake.FILE, F.lit("landing")).withColumn(schemas.CORRUPT, F.lit(None).cast("string"))
    moved = docs.where("match_id % 7 = 0").withColumn("matchweek", F.col("matchweek") % schemas.MATCHWEEKS_PER_SEASON + 1)
    for stamp, landing in (("20250101_000000_000000", docs), ("20250102_000000_000000", moved)):
        counts = jobs.run_medallion(spark, root, None, None, names=(), documents=landing, all_teams=True, stamp=stamp)
    one, place = F.lit(1).alias("n"), ["match_id", "season", "matchweek"]
    return masters.union_tables([
        spark.read.schema(jobs.SILVER_TABLE).parquet(f"{root}/silver").select(F.lit("silver").alias("layer"), *place, F.lit(None).cast("string").alias("team"), one),
        spark.read.parquet(f"{root}/gold").select(F.lit("gold").alias("layer"), *place, "team", one),
        counts.select(F.concat(F.lit("count of "), "layer").alias("layer"), "season", "matchweek", F.col("n_rows").cast("int").alias("n")),
    ])


@query("m9_ingest_season", o.with_(o.MATCHES) + f"""SELECT match_id, season, matchweek, home_team, home_score, {_VISITED} FROM (
  SELECT *, row_number() OVER (PARTITION BY season, matchweek ORDER BY match_id) AS rn FROM matches) WHERE rn <= 10""")
def m9(spark, sf):
    """Cards of the result pages give the work list; all tabs give documents."""
    cards = jobs.result_cards(result_pages(spark, sf))
    work = cards.select("match_id", "season", "matchweek")
    docs = jobs.capture_documents(_all_pages(spark, sf), work, BASE_URL)
    return docs.select("match_id", "season", "matchweek", *_visited_columns())
