"""Bronze documents -> cleaned documents -> one flat row per match.

A document is one row, so cleaning and flattening need no shuffle: every merge
of statistics happens inside the row, on maps with the LAST_WIN policy of
``touchline.configure``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline import schemas
from touchline.functions import scores, stats
from touchline.functions.text import blank_to_null, let, normalize_stat_name, strip


def _or_empty(m: Column, ddl: str = schemas.STAT_MAP) -> Column:
    return F.coalesce(m, F.create_map().cast(ddl))


def trim_info(info: Column) -> Column:
    """Every text of ``match_info`` without outer white space."""
    return F.transform_values(_or_empty(info), lambda _, v: strip(v))


def merge_match_info(info: Column, extra: Column, ignore_nulls: bool = False) -> Column:
    """``extra`` wins on equal keys, also with NULL unless ``ignore_nulls``."""
    extra = _or_empty(extra)
    if ignore_nulls:
        extra = F.map_filter(extra, lambda _, v: v.isNotNull())
    return F.map_concat(_or_empty(info), extra)


def date_pick(info: Column) -> Column:
    """``date_time`` unless it is missing or empty, else ``date``."""
    return F.coalesce(blank_to_null(info["date_time"]), info["date"])


def merge_stat_maps(statistics: Column, detailed: Column) -> Column:
    """A3: the statistics and then each category; a later value replaces an
    earlier one in its place. Categories that are no object are skipped."""
    categories = F.transform(
        F.map_values(_or_empty(detailed)),
        lambda c: F.map_entries(
            _or_empty(F.from_json(F.when(stats.is_object(c), c), schemas.STAT_MAP))
        ),
    )
    entries = F.concat(F.map_entries(_or_empty(statistics)), F.flatten(categories))
    return F.map_from_entries(entries)


def _parsed_stats(raw: Column) -> Column:
    """Entries of a raw statistics map with trimmed and repaired names and
    parsed values (P13, P15, F2, F3), in document order."""

    def entry(e: Column) -> Column:
        pair = stats.keep_home_away(e["value"])
        return F.struct(
            stats.possession_repair(strip(e["key"]), pair).alias("name"), e["key"].alias("raw_name"), pair.alias("pair")
        )

    objects = F.filter(F.map_entries(raw), lambda e: stats.is_object(e["value"]))
    return F.transform(
        F.transform(objects, entry),
        lambda e: F.struct(
            e["name"].alias("name"),
            e["raw_name"].alias("raw_name"),
            stats.parse_stat(e["pair"]["home"]).alias("home"),
            stats.parse_stat(e["pair"]["away"]).alias("away"),
        ),
    )


def _unique_names(entries: Column) -> Column:
    """Entries by trimmed name: the last value in the place of the first one.
    Usually no two names are alike and the array stays as it is."""
    names = F.transform(entries, lambda e: e["name"])
    by_name = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["name"].alias("key"), e.alias("value"))))
    return F.when(F.size(F.array_distinct(names)) == F.size(entries), entries).otherwise(F.map_values(by_name))


def clean_documents(docs: DataFrame) -> DataFrame:
    """M4: trimmed info, whole-number scores, and statistics as
    ``array<struct<name, raw_name, home, away>>`` with parsed sides. Columns
    that are no input of the cleaning pass through."""
    info = F.col("match_info")
    merged = merge_stat_maps(F.col("statistics"), F.col("detailed_statistics"))
    return (
        docs.withColumns(
            {
                "match_info": trim_info(info),
                "home_score": scores.coerce_score(info["home_score"]),
                "away_score": scores.coerce_score(info["away_score"]),
                "stats": _parsed_stats(merged),
            }
        )
        .withColumn("stats", _unique_names(F.col("stats")))
        .drop("statistics", "detailed_statistics")
    )


_SIDES = ("home", "away")


def _by_stat(entries: Column) -> Column:
    """Normalised name -> both sides and the position of the entry."""
    return F.map_from_entries(
        F.transform(
            entries,
            lambda e: F.struct(
                e["stat"].alias("key"), F.struct(*[e[k].alias(k) for k in (*_SIDES, "ord")]).alias("value")
            ),
        )
    )


def _resolve_collisions(entries: Column) -> Column:
    """A4: names that normalise alike. The last one gives the value, and the
    last one *with a percentage* gives the percentage. A statistic whose own
    name ends in ``_pct`` shares its wide column with the percentage of the
    other; the later of the two stays.
    """

    def percents(side: str) -> Column:
        return F.map_from_entries(
            F.transform(
                F.filter(entries, lambda e: e[side]["pct"].isNotNull()),
                lambda e: F.struct(
                    e["stat"].alias("key"), F.struct(e[side]["pct"].alias("pct"), e["ord"].alias("ord")).alias("value")
                ),
            )
        )

    def side_of(e: Column, maps: Column, side: str) -> Column:
        own = e["value"][side]
        percent = maps[side][e["key"]]
        named = maps["values"][F.concat(e["key"], F.lit("_pct"))]
        base = maps[side][F.regexp_replace(e["key"], "_pct$", "")]
        hidden = F.endswith(e["key"], F.lit("_pct")) & base.isNotNull() & (base["ord"] > e["value"]["ord"])
        return F.struct(
            F.when(~F.coalesce(hidden, F.lit(False)), own["value"]).alias("value"),
            F.when(named.isNull() | (percent["ord"] > named["ord"]), percent["pct"]).alias("pct"),
            F.when(~F.coalesce(hidden, F.lit(False)), own["text"]).alias("text"),
        )

    def resolved(maps: Column) -> Column:
        return F.transform_values(
            maps["values"],
            lambda k, v: let(
                F.struct(k.alias("key"), v.alias("value")),
                lambda e: F.struct(*[side_of(e, maps, side).alias(side) for side in _SIDES]),
            ),
        )

    maps = F.struct(_by_stat(entries).alias("values"), *[percents(side).alias(side) for side in _SIDES])
    return let(maps, resolved)


def flat_stats(cleaned: DataFrame) -> DataFrame:
    """Replace ``stats`` by ``map<stat, struct<home, away>>`` with
    normalised names and a ``struct<value, pct, text>`` per side."""
    stats_array = F.col("stats")
    entries = F.filter(
        F.transform(
            stats_array,
            lambda e, i: F.struct(
                normalize_stat_name(e["name"]).alias("stat"),
                e["home"].alias("home"),
                e["away"].alias("away"),
                i.alias("ord"),
            ),
        ),
        lambda e: ~e["stat"].isin(*schemas.RESERVED_STATS),
    )
    direct = F.map_from_entries(
        F.transform(
            F.col("_entries"),
            lambda e: F.struct(
                e["stat"].alias("key"), F.struct(e["home"].alias("home"), e["away"].alias("away")).alias("value")
            ),
        )
    )
    clear = (F.size("_direct") == F.size("_entries")) & ~F.exists(
        F.col("_entries"), lambda e: F.endswith(e["stat"], F.lit("_pct"))
    )
    return (
        cleaned.withColumn("_entries", entries)
        .withColumn("_direct", direct)
        .withColumn("stats", F.when(clear, F.col("_direct")).otherwise(_resolve_collisions(F.col("_entries"))))
        .drop("_entries", "_direct")
    )


def flatten_envelope() -> list[Column]:
    """The ten fixed columns of a Silver row."""
    info = F.col("match_info")
    return [
        F.col("match_id"),
        F.col("season"),
        F.col("matchweek"),
        date_pick(info).alias("date"),
        info["venue"].alias("venue"),
        info["referee"].alias("referee"),
        info["home_team"].alias("home_team"),
        info["away_team"].alias("away_team"),
        F.col("home_score"),
        F.col("away_score"),
    ]


def flatten_documents(cleaned: DataFrame, *lineage: str) -> DataFrame:
    """M5: one Silver row per document: ten fixed columns and the map of
    statistics. ``lineage`` columns are carried along."""
    return flat_stats(cleaned).select(*flatten_envelope(), *lineage, "stats")


def reserved_entries(stats_array: Column) -> Column:
    """The cleaned statistics whose column is a fixed one, by their names."""
    named = F.transform(
        stats_array,
        lambda s: F.struct(s["raw_name"].alias("stat_name"), normalize_stat_name(s["name"]).alias("stat")),
    )
    return F.filter(named, lambda s: s["stat"].isin(*schemas.RESERVED_STATS))


def reserved_stats(cleaned: DataFrame) -> DataFrame:
    """Statistics kept out of Silver because their column is a fixed one."""
    return cleaned.select("match_id", F.explode(reserved_entries(F.col("stats"))).alias("s")).select("match_id", "s.*")


def add_lineage(docs: DataFrame, season: Column, matchweek: Column, base_url: str) -> DataFrame:
    """Url, season, matchweek and time of capture of a document."""
    return (
        docs.withColumn("url", F.concat(F.lit(base_url.rstrip("/") + "/match/"), F.col("match_id").cast("string")))
        .withColumn("season", season)
        .withColumn("matchweek", matchweek)
    )
