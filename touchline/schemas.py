"""Declared schemas of every layer and the fixed values of the domain."""

from __future__ import annotations

# First match id of each season, by the year the season starts in.
SEASON_START_MATCH_ID = {
    2010: 321665,
    2011: 360469,
    2012: 441999,
    2013: 694904,
    2014: 755307,
    2015: 803169,
    2016: 855178,
    2017: 918893,
    2018: 987597,
    2019: 1059702,
    2020: 2128288,
    2021: 2210271,
    2022: 2292810,
    2023: 2367538,
    2024: 2444470,
    2025: 2561895,
}

# Shape of a season.
MATCHWEEKS_PER_SEASON = 38
MATCHES_PER_MATCHWEEK = 10

# Spellings of the default target team of the Gold layer.
DEFAULT_TEAM_ALIASES = ("Man Utd", "Manchester United")

# State of a match.
PLAYED = "PLAYED"
SCHEDULED = "SCHEDULED"

# Layers of the lake; any other name falls back to the first.
LAYERS = ("bronze", "silver", "gold")

# Page section heading -> statistics category.
SECTION_CATEGORIES = {
    "top stats": "top_stats",
    "attack": "attack",
    "possession": "possession",
    "defence": "defence",
    "defense": "defence",
    "physical": "physical",
    "discipline": "discipline",
}

# Categories of a document, in document order.
CATEGORIES = ("top_stats", "attack", "possession", "defence", "physical", "discipline")

# Texts a CSV reader takes as missing.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

STAT_MAP = "map<string,string>"
STAT_PAIR = "home string, away string"

_GOALS = "array<struct<scorer:string,assist:string>>"
_SIDE_LINEUP = (
    "struct<formation:string,manager:string,"
    "starting_xi:array<struct<name:string,number:string>>,"
    "substitutes:array<struct<name:string>>>"
)
EVENTS = (
    f"struct<half_time_score:string,home_goals:{_GOALS},away_goals:{_GOALS},"
    "home_yellow_cards:array<string>,away_yellow_cards:array<string>,"
    "home_red_cards:array<string>,away_red_cards:array<string>>"
)
LINEUPS = f"struct<home:{_SIDE_LINEUP},away:{_SIDE_LINEUP}>"

CORRUPT = "_corrupt_record"

# Bronze as the JSON reader sees it. ``match_info`` stays raw JSON text there,
# because only the raw text tells the number 2.7 from the string "2.7".
BRONZE_JSON = (
    "match_id bigint, url string, season string, matchweek int, scraped_at string, "
    f"match_info string, statistics {STAT_MAP}, detailed_statistics {STAT_MAP}, "
    f"events {EVENTS}, lineups {LINEUPS}, {CORRUPT} string"
)

# Bronze as every operator sees it.
BRONZE = (
    "match_id bigint, url string, season string, matchweek int, scraped_at string, "
    f"match_info {STAT_MAP}, statistics {STAT_MAP}, detailed_statistics {STAT_MAP}, "
    f"events {EVENTS}, lineups {LINEUPS}"
)

SILVER_FIXED = (
    "match_id", "season", "matchweek", "date", "venue", "referee",
    "home_team", "away_team", "home_score", "away_score",
)
SILVER_FIXED_TYPES = {"match_id": "bigint", "matchweek": "int", "home_score": "int", "away_score": "int"}

GOLD_FIXED = (
    "match_id", "season", "matchweek", "date", "venue", "is_home",
    "team", "opponent", "result", "goals_scored", "goals_conceded",
)

# Statistic names that would overwrite home_/away_ fixed columns of Silver.
RESERVED_STATS = ("score", "team")

# Columns that tell which of several versions of a row landed last.
LINEAGE = ("ingested_at", "source_file", "source_block", "source_pos")

STATE = "match_id bigint, status string, last_updated timestamp"
RAW_PAGES = "match_id bigint, tab string, html string, visible_text string, fetched_at timestamp"
