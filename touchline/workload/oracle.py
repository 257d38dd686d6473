"""SQL pieces shared by the oracle statements."""

from __future__ import annotations

from touchline.workload.tables import STAT_NAMES, STAT_OF_LINE

SEASON = "CAST(year({d}) + {k} AS VARCHAR) || '/' || lpad(CAST((year({d}) + {k} + 1) % 100 AS VARCHAR), 2, '0')"
WEEK = "CAST(least(floor((dayofyear(o_orderdate) - 1) / 10) + 1, 38) AS INTEGER)"

MATCHES = f"""matches AS (
  SELECT o_orderkey AS match_id, {SEASON.format(d='o_orderdate', k=0)} AS season, {WEEK} AS matchweek,
    strftime(o_orderdate, '%Y-%m-%d') AS date, c_mktsegment AS venue, o_orderpriority AS referee,
    n_name AS home_team, 'NATION_' || CAST(o_custkey * 7 % 25 AS VARCHAR) AS away_team,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 5 AS INTEGER) END AS home_score,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 4 AS INTEGER) END AS away_score
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

_Q = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
_D = "CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR)"
_T = "CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR)"
_NAMES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in STAT_OF_LINE.items())

RAW = f"""raw AS (
  SELECT l_orderkey AS match_id, l_linenumber, l_partkey, CASE l_linenumber {_NAMES} END AS stat_name,
    CASE l_linenumber WHEN 1 THEN {_Q} || ' (' || {_D} || '%)' WHEN 2 THEN {_Q} || '.5km' WHEN 3 THEN {_Q} || '%'
      WHEN 4 THEN {_Q} WHEN 5 THEN '-' || {_Q} || '.25' WHEN 6 THEN l_returnflag END AS home,
    CASE l_linenumber WHEN 1 THEN {_T} || '(' || {_Q} || '%)' WHEN 2 THEN ' ' || {_T} || ' KM' WHEN 3 THEN {_T} || ' %'
      WHEN 4 THEN '  ' || {_T} || ' ' WHEN 5 THEN {_T} || 'e1' WHEN 6 THEN l_linestatus END AS away
  FROM lineitem)"""

_MAXES = ", ".join(
    f"max({side}) FILTER (WHERE l_linenumber = {k}) AS {side[0]}{k}" for k in STAT_OF_LINE for side in ("home", "away")
)
ORDER_STATS = f"order_stats AS (SELECT match_id AS s_match_id, {_MAXES} FROM raw GROUP BY match_id)"
JOINED = "joined AS (SELECT * FROM matches LEFT JOIN order_stats ON match_id = s_match_id)"

_PAIR = r"([0-9.]+)\s*\(([0-9.]+)%\)"


def num(t: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
        f"THEN TRY_CAST({t} AS DOUBLE) END"
    )


def pair(c: str, group: int) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '{_PAIR}') "
        f"THEN TRY_CAST(regexp_extract({c}, '{_PAIR}', {group}) AS DOUBLE) END"
    )


def val(c: str) -> str:
    t = f"trim({c})"
    return (
        f"CASE WHEN regexp_matches({c}, '{_PAIR}') THEN {pair(c, 1)} "
        f"WHEN lower({t}) LIKE '%km' THEN {num(f'''trim(replace(lower({t}), 'km', ''))''')} "
        f"WHEN suffix({t}, '%') THEN {num(f'''trim(rtrim({t}, '%'))''')} ELSE {num(t)} END"
    )


def pct(c: str) -> str:
    return pair(c, 2)


def text(c: str) -> str:
    return f"CASE WHEN {val(c)} IS NULL THEN trim({c}) END"


def raw_value(side: str, stat: str) -> str:
    """Raw text that gives the value of a statistic of the derived documents."""
    s, o = side[0], "a" if side == "home" else "h"
    alike = "venue = 'MACHINERY'"
    return {
        "passes_completed": f"CASE WHEN {alike} THEN {s}4 ELSE {s}1 END",
        "distance_covered": f"{s}2",
        "possession": f"{s}3",
        "shots": f"CASE WHEN {alike} THEN {s}3 ELSE {s}4 END",
        "xg": f"{o}5",
        "rating_grade": f"{s}6",
        "saves": f"{s}7",
    }[stat]


def raw_pct(side: str, stat: str) -> str:
    return f"{side[0]}1" if stat == "passes_completed" else "CAST(NULL AS VARCHAR)"


_CELLS = ", ".join(
    f"{raw_value(side, s)} AS v_{side}_{s}, {raw_pct(side, s)} AS p_{side}_{s}" for side in ("home", "away") for s in STAT_NAMES
)
FLAT = f"flat AS (SELECT *, {_CELLS} FROM joined)"
_LONG = " UNION ALL ".join(
    f"SELECT match_id, season, matchweek, '{side}' AS side, '{s}' AS stat, v_{side}_{s} AS v, p_{side}_{s} AS p FROM flat"
    for side in ("home", "away")
    for s in STAT_NAMES
)
LONG = (
    f"long AS (SELECT match_id, season, matchweek, side, stat, {val('v')} AS value, {pct('p')} AS pct, "
    f"{text('v')} AS text FROM ({_LONG}))"
)


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


SILVER = with_(MATCHES, RAW, ORDER_STATS, JOINED, FLAT)
SILVER_LONG = with_(MATCHES, RAW, ORDER_STATS, JOINED, FLAT, LONG)


def wide(names=STAT_NAMES) -> str:
    return ", ".join(
        f"{val(f'v_{side}_{s}')} AS {side}_{s}, {pct(f'p_{side}_{s}')} AS {side}_{s}_pct, "
        f"{text(f'v_{side}_{s}')} AS {side}_{s}_text"
        for side in ("home", "away")
        for s in names
    )


FIXED = "match_id, season, matchweek, date, venue, referee, home_team, away_team, home_score, away_score"
WDL = "CASE WHEN goals_scored > goals_conceded THEN 'W' WHEN goals_scored < goals_conceded THEN 'L' ELSE 'D' END"


def gold(team: str = "NATION_3", names=STAT_NAMES, source: str = "flat") -> str:
    """SELECT of the Gold rows of one team."""
    stats = ", ".join(
        f"CASE WHEN is_home THEN {val(f'v_home_{s}')} ELSE {val(f'v_away_{s}')} END AS {s}, "
        f"CASE WHEN is_home THEN {pct(f'p_home_{s}')} ELSE {pct(f'p_away_{s}')} END AS {s}_pct, "
        f"CASE WHEN is_home THEN {text(f'v_home_{s}')} ELSE {text(f'v_away_{s}')} END AS {s}_text"
        for s in names
    )
    stats = f", {stats}" if names else ""
    return (
        f"SELECT match_id, season, matchweek, date, venue, is_home, team, opponent, {WDL} AS result, "
        f"goals_scored, goals_conceded, goals_scored AS score{stats} FROM (SELECT *, home_team = '{team}' AS is_home, "
        f"CASE WHEN home_team = '{team}' THEN home_team ELSE away_team END AS team, "
        f"CASE WHEN home_team = '{team}' THEN away_team ELSE home_team END AS opponent, "
        f"CASE WHEN home_team = '{team}' THEN home_score ELSE away_score END AS goals_scored, "
        f"CASE WHEN home_team = '{team}' THEN away_score ELSE home_score END AS goals_conceded "
        f"FROM {source} WHERE home_team = '{team}' OR away_team = '{team}')"
    )
