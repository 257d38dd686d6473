"""The medallion jobs: pages -> Bronze -> Silver -> Gold -> masters.

Each step is one DataFrame job over all wanted seasons and matchweeks. Between
steps lies a Parquet layer, so a lost executor only repeats tasks of one step.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline import schemas
from touchline.operators.counts import layer_counts
from touchline.operators.dedupe import keep_last, top_by_id
from touchline.operators.documents import add_lineage, clean_documents, flatten_documents, reserved_entries
from touchline.operators.extract import assemble_documents, extract_match_cards, extract_tabs, newest_captures
from touchline.operators.gold import (
    all_perspectives, gold_columns, team_alias_match, team_filter, team_record,
)
from touchline.operators.masters import gold_master, key_order, lineage_of, silver_master, sort_master, union_tables
from touchline.operators.silver import to_long, to_wide
from touchline.operators.state import match_states, skip_played, upsert_state
from touchline.session import configure
from touchline.sources import changes, sinks
from touchline.sources.lake import LATEST_ORDER, accepted, read_folders, read_layer, rejects
from touchline.sources.pages import with_elements
from touchline.sources.seasons import work_list

BRONZE_TABLE = f"{schemas.BRONZE}, ingested_at timestamp"

_LINEAGE = "ingested_at timestamp, source_file string, source_block bigint, source_pos bigint"
_STAT = "struct<value:double,pct:double,text:string>"
SILVER_TABLE = (
    ", ".join(f"{c} {schemas.SILVER_FIXED_TYPES.get(c, 'string')}" for c in schemas.SILVER_FIXED)
    + f", {_LINEAGE}, stats map<string,struct<home:{_STAT},away:{_STAT}>>"
)


def bronze_to_silver(docs: DataFrame) -> DataFrame:
    """M1: documents -> Silver rows. Map-only: no shuffle whatever the size."""
    lineage = [c for c in LATEST_ORDER if c in docs.columns]
    return flatten_documents(clean_documents(accepted(docs)), *lineage)


def silver_long(docs: DataFrame) -> DataFrame:
    """M1 in long form: one row per match, side and statistic."""
    return to_long(bronze_to_silver(docs))


def silver_wide(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    """M1 in wide form, as the CSV export has it."""
    return to_wide(bronze_to_silver(docs), names)


def silver_to_gold(
    silver: DataFrame,
    aliases: Sequence[str] = schemas.DEFAULT_TEAM_ALIASES,
    names: Sequence[str] | None = None,
    matchweek: int | None = None,
    unique: bool = True,
    with_opponent: bool = False,
    unplayed: str | None = "D",
    lineage: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """M2: Gold rows of one team, with all statistics unless ``names`` picks some.

    Only that team's rows reach the shuffle that removes duplicates, and
    ``unique=False`` has none. The last row of a match is that of ``order``, or
    of the lineage columns; Silver without either raises."""
    rows = team_filter(silver, aliases)
    if matchweek is not None:
        rows = rows.where(F.col("matchweek") == matchweek)
    if unique:
        rows = keep_last(rows, ["match_id"], order or lineage_of(rows))
    return team_record(rows, aliases, names, with_opponent, unplayed, lineage)


def silver_to_gold_all(
    silver: DataFrame,
    names: Sequence[str] | None = None,
    aliases: DataFrame | None = None,
    unplayed: str | None = "D",
    lineage: Sequence[str] = (),
) -> DataFrame:
    """M2 for every team at once: two rows per match, optionally only teams of
    an alias table, whose club name then replaces the spelling."""
    rows = all_perspectives(silver)
    if aliases is not None:
        rows = team_alias_match(rows, aliases).withColumn("team", F.col("club"))
    return gold_columns(rows, names, unplayed=unplayed, lineage=lineage)


def global_masters(
    silver: DataFrame, gold: DataFrame, order: Sequence[str] = LATEST_ORDER, keep: str = "latest",
    seasons: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """M3: the Silver master, sorted, and the Gold master. With ``keep="key_order"`` the
    last version of a match is the last one read, ``seasons`` one after the other."""
    if keep not in ("latest", "key_order"):
        raise ValueError(f"keep is latest or key_order, not {keep}")
    if keep == "key_order":
        order = key_order(seasons)
    return sort_master(silver_master(silver, order)), gold_master(gold, order)


def capture_documents(
    pages: DataFrame, work: DataFrame, base_url: str = "https://example.org", ignore_null_extra: bool = False
) -> DataFrame:
    """M9: documents of the matches on a work list of any size.

    Pages are filtered first and only their small extracts are shuffled. Spark
    broadcasts the work list only if its measured size allows.
    """
    work = work.dropDuplicates(["match_id"])
    wanted = newest_captures(pages.join(work.select("match_id"), "match_id", "left_semi"))
    tabs = extract_tabs(with_elements(wanted.select("match_id", "tab", "fetched_at", "visible_text", "html")))
    docs = assemble_documents(tabs, ignore_null_extra).join(work, "match_id")
    week = F.coalesce(F.col("matchweek"), F.col("page_matchweek"))
    return add_lineage(docs, F.col("season"), week, base_url).select(
        "match_id", "url", "season", "matchweek", "scraped_at", "match_info",
        "statistics", "detailed_statistics", "events", "lineups",
    )


def ingest(
    spark: SparkSession,
    root: str,
    pages: DataFrame,
    seasons: Sequence[str] | None,
    matchweeks: Sequence[int] | None = None,
    formats: Sequence[str] = (),
    base_url: str = "https://example.org",
    stamp: str | None = None,
    season_table: DataFrame | None = None,
) -> DataFrame:
    """M7, M9: capture what is not finished yet, land it in Bronze, update the
    state, and export the documents in the wanted formats.

    Returns the landed documents. State and exports are made from the landed
    table, so the pages are parsed once. A run that finds nothing new lands an
    empty table. ``season_table`` replaces the built-in seasons and their first
    match ids.
    """
    configure(spark)
    stamp = stamp or sinks.run_stamp()
    state = sinks.read_state(spark, f"{root}/state")
    work = skip_played(work_list(spark, seasons, matchweeks, season_table), state)
    docs = capture_documents(pages, work, base_url).withColumn("ingested_at", F.current_timestamp())
    landing = f"{root}/bronze/run_id={stamp}"
    sinks.by_partition(docs).write.mode("error").partitionBy(*sinks.PARTITIONS).parquet(landing)
    landed = spark.read.schema(BRONZE_TABLE).parquet(landing)
    sinks.write_state(upsert_state(state, match_states(landed)), f"{root}/state", stamp)
    if formats:
        sinks.write_formats(landed, f"{root}/export/run_id={stamp}", formats)
    return landed


def run_medallion(
    spark: SparkSession,
    root: str,
    pages: DataFrame | None,
    seasons: Sequence[str] | None,
    matchweeks: Sequence[int] | None = None,
    aliases: Sequence[str] = schemas.DEFAULT_TEAM_ALIASES,
    names: Sequence[str] | None = None,
    skip_ingest: bool = False,
    stamp: str | None = None,
    season_table: DataFrame | None = None,
    documents: DataFrame | None = None,
    csv_export: bool = False,
    all_teams: bool = False,
    alias_table: DataFrame | None = None,
) -> DataFrame:
    """M8: all steps, each over what changed since it last ran, masters last.

    ``seasons`` and ``matchweeks`` choose what is captured, and which landed
    partitions of Bronze go to Silver. Silver has one row per match, its latest
    version, where that version stands: a match that was moved to another week or
    season leaves its old partition. Gold belongs to a club, the first of its
    ``aliases``, and follows all changes of Silver since that club's last run; with
    ``all_teams`` every match has a row for each side, under the name of its team, or
    of the club that ``alias_table`` (alias, club) names, of whose clubs alone Gold
    then has rows. Other names or aliases than in the club's last run make its Gold
    anew. Gold has all statistics unless ``names`` picks some.

    ``documents`` (as ``read_documents`` gives them) stand in for pages; what of
    them has no match id goes to ``rejects``, and statistics named like a fixed
    column go to ``reserved_stats``. A run without new matches is a normal outcome and
    writes nothing new. Returns the number of matches per layer, season and matchweek.
    """
    configure(spark)
    stamp = stamp or sinks.run_stamp()
    if documents is not None:
        land_documents(documents, root, stamp)
    elif not skip_ingest:
        ingest(spark, root, pages, seasons, matchweeks, stamp=stamp, season_table=season_table)
    update_silver(spark, root, seasons, matchweeks, stamp)
    gold_of = partial(_gold_rows, aliases=aliases, names=names, all_teams=all_teams, alias_table=alias_table)
    club = None if all_teams else aliases[0]
    spellings = None if alias_table is None else alias_table.agg(F.bit_xor(F.xxhash64("alias", "club"))).first()[0]
    options = json.dumps([list(aliases), None if names is None else list(names), all_teams, spellings])
    update_gold(spark, root, gold_of, club, options, stamp)
    folders = update_masters(spark, root, _gold_schema(spark, gold_of), stamp)
    if csv_export:
        for layer, folder in folders.items():
            sinks.write_csv(sinks.csv_columns(spark.read.parquet(folder)), f"{root}/export/run_id={stamp}/{layer}_master")
    return medallion_counts(spark, root, seasons, matchweeks, club)


def _gold_rows(
    silver: DataFrame, aliases: Sequence[str], names: Sequence[str] | None, all_teams: bool, alias_table: DataFrame | None
) -> DataFrame:
    """Gold rows, with their club, of Silver that has one row per match."""
    if all_teams:
        gold = silver_to_gold_all(silver, names, alias_table, lineage=LATEST_ORDER)
        return gold.withColumn("club", F.col("team"))
    gold = silver_to_gold(silver, aliases, names, unique=False, lineage=LATEST_ORDER)
    return gold.withColumn("club", F.lit(aliases[0]))


def _gold_schema(spark: SparkSession, gold_of: Callable[[DataFrame], DataFrame]) -> str:
    fields = gold_of(spark.createDataFrame([], SILVER_TABLE)).schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


_RESERVED = "match_id bigint, reserved array<struct<stat_name:string,stat:string>>"
_SILVER_PLACES = "match_id bigint, season string, matchweek int"
_GOLD_PLACES = "match_id bigint, club string, season string"
_BY_CLUB = ("club", "season")


def update_silver(
    spark: SparkSession, root: str, seasons: Sequence[str] | None, matchweeks: Sequence[int] | None, stamp: str
) -> bool:
    """M1 from changes only: landed partitions that Silver has not seen yet.

    Reads these, and of Silver the partitions in which one of their matches stands or
    will stand, which it writes anew. False when nothing landed.
    """
    bronze, silver, places = f"{root}/bronze", f"{root}/silver", f"{root}/places/silver"
    done = set(sinks.complete_snapshots(spark, bronze))
    seen, _ = changes.consumed(spark, root, "silver")
    weeks = None if matchweeks is None else {str(w) for w in matchweeks}
    new = {
        "/".join(map(str, place)): folder
        for place, folder in changes.partition_folders(spark, bronze, ("run_id", *sinks.PARTITIONS)).items()
        if f"run_id={place[0]}" in done and "/".join(map(str, place)) not in seen
        and (seasons is None or place[1] in seasons) and (weeks is None or place[2] in weeks)
    }
    if not new:
        return False
    docs = read_folders(spark, bronze, new.values(), BRONZE_TABLE)
    latest = keep_last(accepted(docs), ["match_id"], LATEST_ORDER)
    delta = f"{root}/delta/silver/run_id={stamp}"
    # documents move once: what is reserved stands beside their Silver rows and is then told from them
    cleaned = clean_documents(latest).withColumn("reserved", reserved_entries(F.col("stats")))
    flatten_documents(cleaned, *LATEST_ORDER, "reserved").write.mode("error").parquet(delta)
    reserved = spark.read.schema(_RESERVED).parquet(delta).select("match_id", F.explode("reserved").alias("s"))
    reserved.select("match_id", "s.*").write.mode("error").parquet(f"{root}/reserved_stats/run_id={stamp}")
    fresh = spark.read.schema(SILVER_TABLE).parquet(delta)

    ids = fresh.select("match_id")
    known = changes.partition_folders(spark, silver, sinks.PARTITIONS)
    first = not sinks.complete_snapshots(spark, places)
    old = set(known) if first else changes.places_in(
        changes.read_places(spark, places, _SILVER_PLACES).join(ids, "match_id", "left_semi"), sinks.PARTITIONS
    )
    touched = old | changes.places_in(fresh, sinks.PARTITIONS)
    changes.write_places(fresh.select(*_names(_SILVER_PLACES)), places, stamp)
    current = changes.read_partitions(spark, silver, SILVER_TABLE, [known[p] for p in touched if p in known])
    rows = changes.merged(current, fresh, LATEST_ORDER)
    # which partitions stay filled follows from narrow columns of the same rows
    filled = changes.places_in(rows, sinks.PARTITIONS)
    changes.rewrite_partitions(rows, silver, sinks.PARTITIONS, touched, filled)
    changes.consume(spark, root, "silver", new, "", stamp)
    return True


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def update_gold(
    spark: SparkSession, root: str, gold_of: Callable[[DataFrame], DataFrame], club: str | None, options: str, stamp: str
) -> bool:
    """M2 from changes only: matches that Silver changed since this club's last run
    (``club`` None: all clubs in one). Reads the partitions of Silver these matches stand
    in, and of Gold those they stood in or will stand in. False when nothing changed."""
    silver, gold, places = f"{root}/silver", f"{root}/gold", f"{root}/places/gold"
    consumer = "gold" if club is None else f"gold of {club}"
    feed = set(sinks.complete_snapshots(spark, f"{root}/places/silver"))
    seen, before = changes.consumed(spark, root, consumer)
    anew = before != options
    runs = feed if anew else feed - seen
    if not runs:
        return False
    known = changes.partition_folders(spark, silver, sinks.PARTITIONS)
    if anew:
        ids, source = None, changes.read_partitions(spark, silver, SILVER_TABLE, known.values())
    else:
        ids = changes.read_places(spark, f"{root}/places/silver", _SILVER_PLACES, runs).select("match_id").distinct()
        at = changes.places_in(
            changes.read_places(spark, f"{root}/places/silver", _SILVER_PLACES).join(ids, "match_id", "left_semi"), sinks.PARTITIONS
        )
        source = changes.read_partitions(spark, silver, SILVER_TABLE, [known[p] for p in at if p in known])
        source = source.join(ids, "match_id", "left_semi")
    made = gold_of(source)
    schema = _gold_schema(spark, gold_of)
    delta = f"{root}/delta/gold/run_id={stamp}"
    made.write.mode("error").parquet(delta)
    fresh = spark.read.schema(schema).parquet(delta)

    stood = changes.read_places(spark, places, _GOLD_PLACES)
    stood = stood if club is None else stood.where(F.col("club") == club)
    if ids is not None:
        stood = stood.join(ids, "match_id", "left_semi")
    own = changes.partition_folders(spark, gold, _BY_CLUB)
    if anew:
        old = {p for p in own if club is None or p[0] == club}
    else:
        old = changes.places_in(stood, _BY_CLUB)
    touched = old | changes.places_in(fresh, _BY_CLUB)
    changes.write_places(fresh.select(*_names(_GOLD_PLACES)).unionByName(stood).distinct(), places, stamp)
    rows = fresh
    if ids is not None:
        current = changes.read_partitions(spark, gold, schema, [own[p] for p in touched if p in own])
        rows = rows.unionByName(current.join(ids, "match_id", "left_anti"))
    filled = changes.places_in(rows, _BY_CLUB)
    changes.rewrite_partitions(rows, gold, _BY_CLUB, touched, filled)
    changes.consume(spark, root, consumer, runs if not anew else feed, options, stamp)
    return True


def update_masters(spark: SparkSession, root: str, gold_schema: str, stamp: str) -> dict[str, str]:
    """M3 from changes: both masters as one published version; returns their folders.

    A master is its last version without the changed matches, and their rows of now.
    One of which nothing changed stays as it is in the new version.
    """
    before = changes.published(spark, f"{root}/masters")
    seen, _ = changes.consumed(spark, root, "masters")
    folders, sources = dict(before or {}), set()
    for layer, schema, columns, table in (
        ("silver", _SILVER_PLACES, sinks.PARTITIONS, SILVER_TABLE), ("gold", _GOLD_PLACES, _BY_CLUB, gold_schema),
    ):
        places = f"{root}/places/{layer}"
        runs = {r for r in sinks.complete_snapshots(spark, places) if f"{layer}/{r}" not in seen}
        last = None if before is None else spark.read.parquet(before[layer])
        if last is not None and not runs:
            continue
        known = changes.partition_folders(spark, f"{root}/{layer}", columns)
        if last is None or set(last.columns) != set(spark.createDataFrame([], table).columns):
            rows = changes.read_partitions(spark, f"{root}/{layer}", table, known.values())
        else:
            ids = changes.read_places(spark, places, schema, runs).select("match_id").distinct()
            every = changes.read_places(spark, places, schema).join(ids, "match_id", "left_semi")
            at = changes.places_in(every, columns)
            now = changes.read_partitions(spark, f"{root}/{layer}", table, [known[p] for p in at if p in known])
            rows = last.join(ids, "match_id", "left_anti").unionByName(now.join(ids, "match_id", "left_semi"))
        # every layer has one row per match, or per match and team, already
        rows = sort_master(rows) if layer == "silver" else gold_master(rows, LATEST_ORDER)
        folders[layer] = sinks.write_snapshot(rows, f"{root}/{layer}_master", stamp)
        sources |= {f"{layer}/{r}" for r in runs}
    if sources or before is None:
        changes.publish(spark, f"{root}/masters", stamp, folders)
        changes.consume(spark, root, "masters", sources, "", stamp)
    return folders


def read_masters(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The masters of the newest published version, which belong together."""
    return {layer: spark.read.parquet(folder) for layer, folder in (changes.published(spark, f"{root}/masters") or {}).items()}


def medallion_counts(
    spark: SparkSession, root: str, seasons: Sequence[str] | None, matchweeks: Sequence[int] | None, club: str | None
) -> DataFrame:
    """A5: matches per layer, season and matchweek; in Bronze where their latest version
    stands. Reads ids, partitions and lineage only."""
    keys = ["match_id", *sinks.PARTITIONS]
    bronze = read_layer(spark, f"{root}/bronze", schema=BRONZE_TABLE).where("match_id is not null")
    silver = changes.partition_folders(spark, f"{root}/silver", sinks.PARTITIONS).values()
    gold = [f for p, f in changes.partition_folders(spark, f"{root}/gold", _BY_CLUB).items() if club is None or p[0] == club]
    gold_rows = changes.read_partitions(spark, f"{root}/gold", "match_id bigint, matchweek int, club string, season string", gold)
    layers = {
        "bronze": keep_last(bronze.select(*keys, *LATEST_ORDER), ["match_id"], LATEST_ORDER),
        "silver": changes.read_partitions(spark, f"{root}/silver", _SILVER_PLACES, silver),
        "gold": gold_rows.select(*keys).distinct(),
    }
    counted = []
    for name, rows in layers.items():
        if seasons is not None:
            rows = rows.where(F.col("season").isin(*seasons))
        if matchweeks is not None:
            rows = rows.where(F.col("matchweek").isin(*matchweeks))
        counted.append(layer_counts(rows.select(*keys)).withColumn("layer", F.lit(name)))
    return union_tables(counted)


def land_documents(documents: DataFrame, root: str, stamp: str) -> None:
    """Documents into Bronze, and what is none into a table of rejects."""
    spark = documents.sparkSession
    landing = f"{root}/bronze/run_id={stamp}"
    rows = accepted(documents).withColumn("ingested_at", F.current_timestamp())
    columns = [F.col(c) for c in spark.createDataFrame([], BRONZE_TABLE).columns]
    sinks.by_partition(rows.select(*columns)).write.mode("error").partitionBy(*sinks.PARTITIONS).parquet(landing)
    rejects(documents).write.mode("error").parquet(f"{root}/rejects/run_id={stamp}")
    landed = spark.read.schema(BRONZE_TABLE).parquet(landing)
    state = sinks.read_state(spark, f"{root}/state")
    sinks.write_state(upsert_state(state, match_states(landed)), f"{root}/state", stamp)


def result_cards(pages: DataFrame, per_week: int = 10) -> DataFrame:
    """Match cards of stored result pages, the first ten ids per matchweek (O2)."""
    return top_by_id(extract_match_cards(with_elements(pages)), per_week)
