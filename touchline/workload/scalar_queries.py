"""Queries for scalar functions, projections and predicates (F, P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import scores, stats, text as tx
from touchline.functions.dom import category_of
from touchline.operators import documents as docs_ops
from touchline.operators.gold import _is_home, perspective, side_projection, team_filter
from touchline.operators.silver import explode_stats
from touchline.plans.medallion import bronze_to_silver
from touchline.workload import oracle as o
from touchline.workload.registry import query
from touchline.workload.tables import (
    BASE_URL, STAT_NAMES, TEAM, documents, matches, raw_stats, state, table,
)

RAW_ROWS = o.with_(o.RAW)


@query("f1_normalize_stat_name", """SELECT p_partkey, trim(replace(replace(replace(replace(
  lower('(' || p_name || ' %) ' || p_type), ' ', '_'), '(', ''), ')', ''), '%', ''), '_') AS stat FROM part""")
def f1(spark, sf):
    name = F.concat(F.lit("("), "p_name", F.lit(" %) "), "p_type")
    return table(spark, sf, "part").select("p_partkey", tx.normalize_stat_name(name).alias("stat"))


@query("f2_possession_repair", """SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND p_brand LIKE '%1%' THEN 'Possession'
  WHEN p_size % 2 = 0 THEN p_brand || '%' ELSE p_brand || '%' END AS stat_name FROM part""")
def f2(spark, sf):
    """A brand with a sign is a shifted percentage where a side says so."""
    name = F.concat("p_brand", F.lit("%"))
    said = F.when((F.col("p_size") % 2 == 0) & F.contains("p_brand", F.lit("1")), "Possession").otherwise("12")
    pair = F.struct(F.lit("7").alias("home"), said.alias("away"))
    return table(spark, sf, "part").select("p_partkey", stats.possession_repair(name, pair).alias("stat_name"))


def _raw(column, *names):
    def run(spark, sf):
        raw = raw_stats(spark, sf)
        made = column(F.col("home"), F.col("away"))
        return raw.select("match_id", "l_linenumber", "l_partkey", "home", "away", *[c.alias(n) for c, n in zip(made, names)])

    return run


def _raw_sql(*columns: str) -> str:
    return f"{RAW_ROWS} SELECT match_id, l_linenumber, l_partkey, home, away, {', '.join(columns)} FROM raw"


_T = "trim({})".format
query("f3a_parse_null", _raw_sql("home IS NULL AS home_missing", f"{_T('away')} AS away_text"))(
    _raw(lambda h, a: (stats.parse_stat(h)["value"].isNull() & stats.parse_stat(h)["text"].isNull(), tx.strip(a)),
         "home_missing", "away_text"))
query("f3b_parse_value_percent", _raw_sql(
    f"{o.pair('home', 1)} AS hv", f"{o.pair('home', 2)} AS hp", f"{o.pair('away', 1)} AS av", f"{o.pair('away', 2)} AS ap"))(
    _raw(lambda h, a: (stats.pair_value(h), stats.pair_percent(h), stats.pair_value(a), stats.pair_percent(a)),
         "hv", "hp", "av", "ap"))


def _km_sql(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) LIKE '%km' THEN {o.num(f'''trim(replace(lower(trim({c})), 'km', ''))''')} END"


def _pc_sql(c: str) -> str:
    return f"CASE WHEN suffix(trim({c}), '%') THEN {o.num(f'''trim(rtrim(trim({c}), '%'))''')} END"


query("f3c_parse_km", _raw_sql(f"{_km_sql('home')} AS hv", f"{_km_sql('away')} AS av"))(
    _raw(lambda h, a: (stats.km_value(tx.strip(h)), stats.km_value(tx.strip(a))), "hv", "av"))
query("f3d_parse_percent", _raw_sql(f"{_pc_sql('home')} AS hv", f"{_pc_sql('away')} AS av"))(
    _raw(lambda h, a: (stats.percent_value(tx.strip(h)), stats.percent_value(tx.strip(a))), "hv", "av"))
query("f3e_parse_int", _raw_sql(*[
    f"CASE WHEN regexp_full_match(trim({c}), '[0-9]+') THEN CAST(trim({c}) AS DOUBLE) END AS {c[0]}v" for c in ("home", "away")]))(
    _raw(lambda h, a: (stats.int_value(tx.strip(h)), stats.int_value(tx.strip(a))), "hv", "av"))
query("f3f_parse_float_or_text", _raw_sql(*[
    f"{e(c)} AS {c[0]}{k}" for c in ("home", "away") for k, e in (("v", o.val), ("p", o.pct), ("t", o.text))]))(
    _raw(lambda h, a: tuple(stats.parse_stat(c)[k] for c in (h, a) for k in ("value", "pct", "text")),
         "hv", "hp", "ht", "av", "ap", "at"))


@query("f4_pair_to_columns", o.SILVER + f"SELECT match_id, {o.wide()} FROM flat")
def f4(spark, sf):
    from touchline.operators.silver import to_wide

    flat = bronze_to_silver(documents(spark, sf))
    return to_wide(flat.select("match_id", "stats"), STAT_NAMES)


@query("f5_season_slug", o.with_(o.MATCHES) + "SELECT match_id, replace(season, '/', '-') AS slug FROM matches")
def f5(spark, sf):
    return matches(spark, sf).select("match_id", tx.season_slug(F.col("season")).alias("slug"))


@query("f6_season_label", f"SELECT o_orderkey, {o.SEASON.format(d='o_orderdate', k=0)} AS season FROM orders")
def f6(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", tx.season_label(F.year("o_orderdate")).alias("season"))


@query("f7_zero_pad", o.with_(o.MATCHES) + """SELECT match_id,
  CASE WHEN matchweek < 10 THEN '0' ELSE '' END || CAST(matchweek AS VARCHAR) AS mw FROM matches""")
def f7(spark, sf):
    return matches(spark, sf).select("match_id", tx.zero_pad(F.col("matchweek")).alias("mw"))


@query("f8_timestamp_slug", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events")
def f8(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.timestamp_slug(F.col("ts")).alias("stamp"))


@query("f9_iso_now", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events")
def f9(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.iso_now(F.col("ts")).alias("iso"))


@query("f10_match_id_from_href", r"""SELECT page_id, TRY_CAST(nullif(regexp_extract(
  regexp_replace(url, '/[a-z]{2}/', '/match/'), 'match/([0-9]+)', 1), '') AS BIGINT) AS match_id FROM pages""")
def f10(spark, sf):
    href = F.regexp_replace("url", "/[a-z]{2}/", "/match/")
    return table(spark, sf, "pages").select("page_id", tx.match_id_from_href(href).alias("match_id"))


@query("f11_score_from_text", o.with_(o.MATCHES) + "SELECT match_id, home_score, away_score FROM matches")
def f11(spark, sf):
    """Scores written into a text with either dash, and found again."""
    dash = F.when(F.col("matchweek") % 2 == 0, " – ").otherwise("-")
    text = F.coalesce(F.concat(F.lit("FT "), "home_score", dash, "away_score"), F.lit("15:00 kick off"))
    home, away = tx.score_from_text(text)
    return matches(spark, sf).select("match_id", home.alias("home_score"), away.alias("away_score"))


@query("f12_matchweek_from_text", o.with_(o.MATCHES) + "SELECT match_id, matchweek FROM matches")
def f12(spark, sf):
    """The week is in one of two labels or only in the page text."""
    week, third = F.col("matchweek").cast("string"), F.col("match_id") % 3
    labels = [
        F.when(third == 0, F.concat(F.lit("gameweek"), week)).otherwise("no week"),
        F.when(third == 1, F.concat(F.lit("Round MW  "), week)),
    ]
    page = F.when(third == 2, F.concat(F.lit("MW 99 | MATCHWEEK\t"), week, F.lit(" of 38"))).otherwise("Matchweek 77")
    return matches(spark, sf).select("match_id", tx.matchweek_from_text(labels, page).alias("matchweek"))


@query("f13_half_time_score", o.with_(o.MATCHES) + """SELECT match_id,
  CAST(home_score AS VARCHAR) || '-' || CAST(away_score AS VARCHAR) AS half_time FROM matches""")
def f13(spark, sf):
    text = F.coalesce(F.concat(F.lit("(ht "), "home_score", F.lit("–"), "away_score", F.lit(")")), F.lit("HT"))
    return matches(spark, sf).select("match_id", tx.half_time_score(text).alias("half_time"))


@query("f14_referee_from_text", o.with_(o.MATCHES) + """SELECT match_id,
  CASE WHEN matchweek % 3 = 2 THEN NULL ELSE 'Ann ' || venue END AS referee FROM matches""")
def f14(spark, sf):
    """An official before the next label or at the end; none with a digit."""
    third = F.col("matchweek") % 3
    text = F.concat(
        F.lit("Info\nreferee  Ann "), "venue",
        F.when(third == 0, "\nVAR Bo").when(third == 1, " ").otherwise("2 Assistant"),
    )
    return matches(spark, sf).select("match_id", tx.referee_from_text(text).alias("referee"))


@query("f15_formations_from_text", o.with_(o.MATCHES) + """SELECT match_id,
  CASE WHEN matchweek % 3 <> 2 THEN '4-' || CAST(matchweek AS VARCHAR) || '-2' END AS home,
  CASE WHEN matchweek % 3 <> 2 THEN '3-5-2' END AS away FROM matches""")
def f15(spark, sf):
    """A fourth number is cut; one formation alone is none."""
    text = F.concat(
        F.lit("Formation 4-"), "matchweek", F.lit("-2-1 x"),
        F.when(F.col("matchweek") % 3 != 2, " FORMATION\n3-5-2").otherwise(""),
    )
    home, away = tx.formations_from_text(text)
    return matches(spark, sf).select("match_id", home.alias("home"), away.alias("away"))


@query("f16_managers_from_text", o.with_(o.MATCHES) + """SELECT match_id, 'Ann ' || venue AS home,
  CASE WHEN matchweek % 2 = 0 THEN 'Bo Li' ELSE 'Bo' END AS away FROM matches""")
def f16(spark, sf):
    text = F.concat(
        F.lit("Manager Ann "), "venue", F.lit(" Formation 4-4-2 manager "),
        F.when(F.col("matchweek") % 2 == 0, "Bo Li").otherwise("Bo 7 Li"),
    )
    home, away = tx.managers_from_text(text)
    return matches(spark, sf).select("match_id", home.alias("home"), away.alias("away"))


query("f17_leading_number", _raw_sql(*[
    f"coalesce(nullif(regexp_extract({c}, '^([0-9.]+)', 1), ''), nullif({c}, '')) AS {c[0]}n" for c in ("home", "away")]))(
    _raw(lambda h, a: (tx.leading_number(h), tx.leading_number(a)), "hn", "an"))


@query("f18_strip_label", "SELECT o_orderkey, trim(o_orderpriority) AS referee FROM orders")
def f18(spark, sf):
    text = F.concat(F.lit("  Referee: "), "o_orderpriority", F.lit("\n"))
    return table(spark, sf, "orders").select("o_orderkey", tx.strip_label(text).alias("referee"))


@query("f19_info_entry", o.with_(o.MATCHES) + """SELECT match_id, date AS kickoff, venue AS stadium,
  CASE WHEN matchweek % 2 = 0 THEN '' END AS attendance FROM matches""")
def f19(spark, sf):
    """A value element, the last line of an entry, and an entry without value."""
    none = F.lit(None).cast("string")

    def entry(text, span):
        return F.struct(text.alias("text"), span.alias("span"))

    entries = F.array(
        entry(F.concat(F.lit("Kick-Off "), "date"), F.col("date")),
        entry(F.concat(F.lit("Home Stadium\nold name\n "), "venue"), none),
        entry(F.when(F.col("matchweek") % 2 == 0, "ATTENDANCE").otherwise("Weather"), none),
    )
    return matches(spark, sf).select(
        "match_id",
        tx.info_entry(entries, "kick-off", "kickoff").alias("kickoff"),
        tx.info_entry(entries, "stadium").alias("stadium"),
        tx.info_entry(entries, "attendance").alias("attendance"),
    )


@query("f20_category_of", """SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN 'top_stats' WHEN 1 THEN 'attack'
  WHEN 2 THEN 'possession' WHEN 3 THEN 'defence' WHEN 4 THEN 'defence' WHEN 5 THEN 'physical'
  ELSE 'top_stats' END AS category FROM part""")
def f20(spark, sf):
    heading = F.element_at(
        F.array(*[F.lit(h) for h in ("Top Stats", "ATTACK", "Possession", "Defence", "Defense", "Physical", " Discipline")]),
        (F.col("p_size") % 7 + 1).cast("int"),
    )
    return table(spark, sf, "part").select("p_partkey", category_of(F.concat(heading, "p_name")).alias("category"))


@query("f21_played_status", o.with_(o.MATCHES) + """SELECT match_id,
  CASE WHEN home_score IS NULL THEN 'SCHEDULED' ELSE 'PLAYED' END AS status FROM matches""")
def f21(spark, sf):
    return matches(spark, sf).select(
        "match_id", scores.played_status(F.col("home_score"), F.col("away_score")).alias("status")
    )


@query("f22_first_line", "SELECT conv_id, turn, split_part(text, chr(10), 1) AS first_line FROM conversations")
def f22(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", tx.first_line(F.col("text")).alias("first_line"))


@query("f23_json_codec", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS json FROM events""")
def f23(spark, sf):
    decoded = table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return decoded.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("json"))


@query("f24_explode_stats", o.with_(o.MATCHES, o.RAW, o.ORDER_STATS, o.JOINED) + " UNION ALL ".join(
    f"SELECT match_id, '{v}' AS stat_name, {s}{k} AS value, '{n}' AS side FROM joined"
    for k, v in {1: "Passes Completed (%)", 2: "Distance Covered", 3: "Possession", 4: "Shots", 5: "XG",
                 6: "Rating Grade", 7: "Saves"}.items() for s, n in (("h", "home"), ("a", "away"))))
def f24(spark, sf):
    kept = documents(spark, sf).select("match_id", stats.keep_struct_stats(F.col("statistics")).alias("statistics"))
    rows = explode_stats(kept).select("match_id", "stat_name", stats.keep_home_away(F.col("stat_json")).alias("p"))
    sides = F.map_from_arrays(F.array(F.lit("home"), F.lit("away")), F.array("p.home", "p.away"))
    return rows.select("match_id", "stat_name", F.explode(sides).alias("side", "value"))


@query("p1_flatten_envelope", o.with_(o.MATCHES) + f"SELECT {o.FIXED} FROM matches")
def p1(spark, sf):
    return docs_ops.clean_documents(documents(spark, sf)).select(*docs_ops.flatten_envelope())


@query("p2_date_pick", o.with_(o.MATCHES) + """SELECT match_id,
  CASE WHEN matchweek % 3 = 0 THEN date || ' 15:00' ELSE date END AS date FROM matches""")
def p2(spark, sf):
    picked = F.when(F.col("matchweek") % 3 == 0, F.concat("date", F.lit(" 15:00"))).when(F.col("matchweek") % 3 == 1, "")
    info = F.create_map(F.lit("date_time"), picked, F.lit("date"), F.col("date"))
    return matches(spark, sf).withColumn("info", info).select("match_id", docs_ops.date_pick(F.col("info")).alias("date"))


@query("p3_trim_info", o.with_(o.MATCHES) + "SELECT match_id, home_team, away_team, venue, referee FROM matches")
def p3(spark, sf):
    info = docs_ops.trim_info(F.col("match_info"))
    trimmed = documents(spark, sf).select("match_id", info.alias("i"))
    return trimmed.select("match_id", *[F.col("i")[k].alias(k) for k in ("home_team", "away_team", "venue", "referee")])


query("p4_coerce_score", _raw_sql(*[
    f"CASE WHEN {c} IS NULL THEN NULL WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') "
    f"THEN CAST(trim({c}) AS INTEGER) ELSE 0 END AS {c[0]}s" for c in ("home", "away")]))(
    _raw(lambda h, a: (scores.coerce_score(h), scores.coerce_score(a)), "hs", "as"))


@query("p5_drop_null_rows", o.with_(o.MATCHES) + """SELECT match_id, season, matchweek FROM matches
  WHERE home_score IS NOT NULL""")
def p5(spark, sf):
    """Documents that lost their id are no documents."""
    from touchline.sources.lake import accepted

    lost = matches(spark, sf).withColumn("match_id", F.when(F.col("home_score").isNotNull(), F.col("match_id")))
    return accepted(lost).select("match_id", "season", "matchweek")


@query("p6_team_filter", o.with_(o.MATCHES) + f"""SELECT {o.FIXED} FROM matches
  WHERE home_team IN ('NATION_3', 'NATION_7') OR away_team IN ('NATION_3', 'NATION_7')""")
def p6(spark, sf):
    return team_filter(matches(spark, sf), ["NATION_3", "NATION_7"])


def _own(spark, sf):
    flat = matches(spark, sf)
    return perspective(team_filter(flat, TEAM), _is_home(TEAM))


_GOLD = "SELECT {} FROM (" + o.gold(names=(), source="matches") + ")"


@query("p7_perspective", o.with_(o.MATCHES)
       + _GOLD.format("match_id, is_home, team, opponent, goals_scored, goals_conceded"))
def p7(spark, sf):
    return _own(spark, sf).select("match_id", "is_home", "team", "opponent", "goals_scored", "goals_conceded")


@query("p8_side_projection", o.SILVER + "SELECT match_id, possession, passes_completed, passes_completed_pct, possession_pct, possession_text, passes_completed_text"
       f" FROM ({o.gold(names=('possession', 'passes_completed'))})")
def p8(spark, sf):
    own = team_filter(bronze_to_silver(documents(spark, sf)), TEAM)
    return own.select("match_id", *side_projection(_is_home(TEAM), ["possession", "passes_completed"]))


@query("p9_result_wdl", o.with_(o.MATCHES) + """SELECT match_id, CASE WHEN home_score > away_score THEN 'W'
  WHEN home_score < away_score THEN 'L' ELSE 'D' END AS home_result, CASE WHEN away_score > home_score THEN 'W'
  WHEN away_score < home_score THEN 'L' ELSE 'D' END AS away_result FROM matches""")
def p9(spark, sf):
    home, away = F.col("home_score"), F.col("away_score")
    return matches(spark, sf).select(
        "match_id", scores.result_wdl(home, away).alias("home_result"), scores.result_wdl(away, home).alias("away_result")
    )


@query("p10_is_home_flag", o.with_(o.MATCHES) + "SELECT match_id, home_team = 'NATION_3' AS is_home FROM matches")
def p10(spark, sf):
    return matches(spark, sf).select("match_id", _is_home(TEAM).alias("is_home"))


@query("p11_add_lineage", o.with_(o.MATCHES) + f"""SELECT match_id, '{BASE_URL}/match/' || CAST(match_id AS VARCHAR) AS url,
  season, matchweek FROM matches""")
def p11(spark, sf):
    m = matches(spark, sf)
    bare = m.select("match_id", F.col("season").alias("s"), F.col("matchweek").alias("w"))
    return docs_ops.add_lineage(bare, F.col("s"), F.col("w"), BASE_URL).drop("s", "w")


_STATE = """state AS (SELECT user_id AS match_id,
  CASE WHEN event_type = 'error' THEN 'SCHEDULED' ELSE 'PLAYED' END AS status, ts, event_id FROM events)"""
_LATEST_STATE = _STATE + """, latest AS (SELECT match_id, status, ts FROM (SELECT *, row_number() OVER (
  PARTITION BY match_id ORDER BY ts DESC, status DESC) AS rn FROM state) WHERE rn = 1)"""


@query("p12_skip_played", o.with_(o.MATCHES, _LATEST_STATE) + """SELECT match_id, season, matchweek FROM matches m
  WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.match_id = m.match_id AND l.status = 'PLAYED')""")
def p12(spark, sf):
    from touchline.operators.dedupe import keep_last
    from touchline.operators.state import skip_played

    latest = keep_last(state(spark, sf), ["match_id"], ["last_updated", "status"])
    return skip_played(matches(spark, sf).select("match_id", "season", "matchweek"), latest)


@query("p13_keep_struct_stats", o.with_(o.MATCHES) + "SELECT match_id, 7 AS kept, 8 AS given FROM matches")
def p13(spark, sf):
    kept = stats.keep_struct_stats(F.col("statistics"))
    return documents(spark, sf).select("match_id", F.size(kept).alias("kept"), F.size("statistics").alias("given"))


@query("p14_merge_match_info", o.with_(o.MATCHES) + """SELECT match_id, home_team, venue AS stadium,
  CASE WHEN matchweek % 2 = 0 THEN 'Ann' END AS referee FROM matches""")
def p14(spark, sf):
    """The referee of the second tab replaces the first one, also by nothing."""
    m = matches(spark, sf)
    info = F.create_map(F.lit("home_team"), F.col("home_team"), F.lit("referee"), F.col("referee"))
    extra = F.create_map(
        F.lit("stadium"), F.col("venue"), F.lit("referee"), F.when(F.col("matchweek") % 2 == 0, "Ann")
    )
    merged = m.select("match_id", docs_ops.merge_match_info(info, extra).alias("i"))
    return merged.select("match_id", *[F.col("i")[k].alias(k) for k in ("home_team", "stadium", "referee")])


query("p15_keep_home_away", _raw_sql("home AS kept_home", "away AS kept_away"))(
    _raw(lambda h, a: (
        stats.keep_home_away(F.to_json(F.struct(h.alias("home"), a.alias("away"), h.alias("home_parsed"))))["home"],
        stats.keep_home_away(F.to_json(F.struct(h.alias("home"), a.alias("away"), h.alias("home_parsed"))))["away"]),
        "kept_home", "kept_away"))


@query("p16_drop_undefined_names", """SELECT p_partkey, p_name AS name FROM part WHERE p_size % 3 <> 0""")
def p16(spark, sf):
    from touchline.functions.dom import drop_undefined_names

    name = F.when(F.col("p_size") % 6 == 0, "").when(F.col("p_size") % 3 == 0, "an undefined stat").otherwise(F.col("p_name"))
    rows = table(spark, sf, "part").select("p_partkey", F.explode(drop_undefined_names(F.array(F.struct(name.alias("name"))))).alias("r"))
    return rows.select("p_partkey", "r.name")


@query("f25_goal_card_entries", o.with_(o.MATCHES) + """SELECT match_id, 'H' AS side, 'H ' || CAST(i AS VARCHAR)
    || '''' AS scorer, 'Helper H' AS assist FROM matches, unnest(generate_series(1, 4)) AS g(i)
    WHERE i <= home_score AND i % 2 = 1
  UNION ALL SELECT match_id, 'H', 'H plain ' || CAST(i AS VARCHAR), NULL FROM matches,
    unnest(generate_series(1, 4)) AS g(i) WHERE i <= home_score AND i % 2 = 0
  UNION ALL SELECT match_id, 'card', venue || ' 40''', NULL FROM matches""")
def f25(spark, sf):
    from touchline.operators.extract import match_events
    from touchline.sources.pages import with_elements
    from touchline.workload.tables import raw_pages

    events = with_elements(raw_pages(spark, sf, ("main",))).select("match_id", match_events(F.col("elements")).alias("e"))
    goals = events.select("match_id", F.lit("H").alias("side"), F.explode("e.home_goals").alias("g")).select(
        "match_id", "side", "g.scorer", "g.assist")
    cards = events.select("match_id", F.lit("card").alias("side"), F.explode("e.home_yellow_cards").alias("scorer"),
                          F.lit(None).cast("string").alias("assist"))
    return goals.unionByName(cards)


@query("f26_first_selector_with_two", """SELECT n_nationkey, CASE WHEN n_regionkey % 2 = 0 THEN n_name ELSE 'b' END AS home,
  c_name AS away FROM nation JOIN customer ON c_nationkey = n_nationkey""")
def f26(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    one = F.array(F.col("n_name"))
    two = F.when(F.col("n_regionkey") % 2 == 0, F.array("n_name", "c_name")).otherwise(one)
    pair = tx.first_pair(one, two, F.array(F.lit("b"), F.col("c_name"), F.lit("c")))
    return joined.select("n_nationkey", F.get(pair, F.lit(0)).alias("home"), F.get(pair, F.lit(1)).alias("away"))
