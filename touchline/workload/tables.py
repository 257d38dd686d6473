"""Domain records derived from the star-schema tables.

The given tables hold no match documents, so every derived table here is a
DataFrame over whole given tables: a match per order, raw statistic texts per
line item, stored pages per match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline import schemas

# Statistic name of each line number of an order.
STAT_OF_LINE = {
    1: "Passes Completed (%)",
    2: "Distance Covered",
    3: "Possession",
    4: "Shots",
    5: "XG",
    6: "Rating Grade",
    7: "Saves",
}
STAT_NAMES = ("passes_completed", "distance_covered", "possession", "shots", "xg", "rating_grade", "saves")
TEAM = ("NATION_3",)
BASE_URL = "https://example.org"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match per order. A team may meet itself; open orders have no score."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    year = F.year("o_orderdate")
    week = F.least(F.floor((F.dayofyear("o_orderdate") - 1) / 10) + 1, F.lit(schemas.MATCHWEEKS_PER_SEASON))
    played = F.col("o_orderstatus") != "P"
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("o_orderkey").alias("match_id"),
            F.format_string("%d/%02d", year, F.pmod(year + 1, F.lit(100))).alias("season"),
            week.cast("int").alias("matchweek"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.col("c_mktsegment").alias("venue"),
            F.col("o_orderpriority").alias("referee"),
            F.col("n_name").alias("home_team"),
            F.concat(F.lit("NATION_"), (F.col("o_custkey") * 7 % 25).cast("string")).alias("away_team"),
            F.when(played, (F.col("o_orderkey") % 5).cast("int")).alias("home_score"),
            F.when(played, (F.col("o_custkey") % 4).cast("int")).alias("away_score"),
        )
    )


def spread(rows: DataFrame) -> DataFrame:
    """Hash rows by match over all shuffle partitions.

    This is the shuffle a join on ``match_id`` needs anyway. Its partitions stay
    as many as set, since the few bytes of a match grow into whole documents or
    pages behind it.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "match_id")


def raw_home() -> Column:
    """Statistic text of a line item, one form per line number."""
    q = F.col("l_quantity").cast("int").cast("string")
    d = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    n = F.col("l_linenumber")
    return (
        F.when(n == 1, F.concat(q, F.lit(" ("), d, F.lit("%)")))
        .when(n == 2, F.concat(q, F.lit(".5km")))
        .when(n == 3, F.concat(q, F.lit("%")))
        .when(n == 4, q)
        .when(n == 5, F.concat(F.lit("-"), q, F.lit(".25")))
        .when(n == 6, F.col("l_returnflag"))
    )


def raw_away() -> Column:
    t = F.round(F.col("l_tax") * 100).cast("int").cast("string")
    q = F.col("l_quantity").cast("int").cast("string")
    n = F.col("l_linenumber")
    return (
        F.when(n == 1, F.concat(t, F.lit("("), q, F.lit("%)")))
        .when(n == 2, F.concat(F.lit(" "), t, F.lit(" KM")))
        .when(n == 3, F.concat(t, F.lit(" %")))
        .when(n == 4, F.concat(F.lit("  "), t, F.lit(" ")))
        .when(n == 5, F.concat(t, F.lit("e1")))
        .when(n == 6, F.col("l_linestatus"))
    )


def raw_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw statistic per line item, with a name that has to be normalised."""
    name = F.create_map(*[c for k, v in STAT_OF_LINE.items() for c in (F.lit(k), F.lit(v))])[F.col("l_linenumber")]
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        "l_linenumber",
        "l_partkey",
        name.alias("stat_name"),
        raw_home().alias("home"),
        raw_away().alias("away"),
    )


def order_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw texts per order: the largest text of each line number. The result
    has one row per order however many items an order has."""
    n = F.col("l_linenumber")
    sides = [("h", F.col("home")), ("a", F.col("away"))]
    return raw_stats(spark, sf_dir).groupBy("match_id").agg(
        *[F.max(F.when(n == k, c)).alias(f"{p}{k}") for k in STAT_OF_LINE for p, c in sides]
    )


def _pair_json(home: str, away: str) -> Column:
    return F.to_json(
        F.struct(F.col(home).alias("home"), F.col(away).alias("away")), {"ignoreNullFields": "false"}
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze documents: a match with its statistics.

    ``attack`` replaces XG of the plain statistics with the sides swapped;
    ``discipline`` holds, for one of the venues, two names that normalise like
    earlier ones and a reserved name.
    """
    m = spread(matches(spark, sf_dir))
    s = order_stats(spark, sf_dir).withColumnRenamed("match_id", "s_match_id")
    joined = m.join(s, m.match_id == s.s_match_id, "left")
    statistics = F.create_map(
        *[c for k, v in STAT_OF_LINE.items() for c in (F.lit(v), _pair_json(f"h{k}", f"a{k}"))],
        F.lit("Broken"), F.lit("x"),
    )

    def category(**stats: tuple[str, str]) -> Column:
        pairs = [
            F.struct(F.col(h).alias("home"), F.col(a).alias("away")).alias(n.replace("__", " "))
            for n, (h, a) in stats.items()
        ]
        return F.to_json(F.struct(*pairs), {"ignoreNullFields": "false"})

    alike = category(shots=("h3", "a3"), **{"(Passes)__Completed": ("h4", "a4")}, Score=("h4", "a4"))
    detailed = F.create_map(
        F.lit("top_stats"), F.lit("{}"),
        F.lit("attack"), category(XG=("a5", "h5")),
        F.lit("possession"), F.lit("7"),
        F.lit("discipline"), F.when(F.col("venue") == "MACHINERY", alike).otherwise(F.lit("{}")),
    )
    pad = lambda c: F.concat(F.lit(" \t"), c, F.lit("\n"))
    info = F.create_map(
        F.lit("home_team"), pad(F.col("home_team")),
        F.lit("away_team"), pad(F.col("away_team")),
        F.lit("home_score"), F.col("home_score").cast("string"),
        F.lit("away_score"), F.col("away_score").cast("string"),
        F.lit("date"), F.col("date"),
        F.lit("venue"), pad(F.col("venue")),
        F.lit("referee"), F.col("referee"),
    )
    return joined.select(
        "match_id",
        F.concat(F.lit(f"{BASE_URL}/match/"), F.col("match_id").cast("string")).alias("url"),
        "season",
        "matchweek",
        F.concat(F.col("date"), F.lit("T10:00:00.000000")).alias("scraped_at"),
        info.alias("match_info"),
        statistics.alias("statistics"),
        detailed.alias("detailed_statistics"),
    )


def full_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with every Bronze column; events and lineups are unknown."""
    return documents(spark, sf_dir).select(
        "*",
        F.lit(None).cast(schemas.EVENTS).alias("events"),
        F.lit(None).cast(schemas.LINEUPS).alias("lineups"),
    )


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows of users' events: one per event, an error is still open."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("match_id"),
        F.when(F.col("event_type") == "error", schemas.SCHEDULED).otherwise(schemas.PLAYED).alias("status"),
        F.col("ts").cast("timestamp").alias("last_updated"),
        "event_id",
    )


def season_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (season, matchweek) pairs of matches, moved into the years
    around the first known season; the earlier ones are unknown."""
    year = F.year("o_orderdate") + 12
    week = F.least(F.floor((F.dayofyear("o_orderdate") - 1) / 10) + 1, F.lit(schemas.MATCHWEEKS_PER_SEASON))
    return table(spark, sf_dir, "orders").select(
        F.format_string("%d/%02d", year, F.pmod(year + 1, F.lit(100))).alias("season"),
        week.cast("int").alias("matchweek"),
    ).distinct()


# --- stored pages -------------------------------------------------------------

# Class names and test ids in these pages are those that selectors ask for.


def _li(text: Column, inner: Column | None = None) -> Column:
    return F.concat(F.lit("<li>"), text if inner is None else inner, F.lit("</li>"))


def main_page(m: DataFrame) -> Column:
    """Scoreboard: half-time score, goals with or without parts, cards."""
    goals = lambda side, n: F.array_join(
        F.transform(
            F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
            lambda i: F.when(
                i % 2 == 1,
                F.concat(
                    F.lit(f'<li><div class="scoreboard-event__scorer"> {side} '), i.cast("string"),
                    F.lit(f"'</div><div class=\"scoreboard-event__assist\">Helper {side}</div></li>"),
                ),
            ).otherwise(F.concat(F.lit(f"<li> {side} plain "), i.cast("string"), F.lit("</li><li> </li>"))),
        ),
        "",
    )
    hs, as_ = F.coalesce("home_score", F.lit(0)), F.coalesce("away_score", F.lit(0))
    return F.concat(
        F.lit('<html><head><style>.x{}</style></head><body><div class="match-header__gameweek">MW '),
        F.col("matchweek").cast("string"),
        F.lit('</div><div class="match-status__half-time-score">HT '),
        hs.cast("string"), F.lit(" - "), as_.cast("string"),
        F.lit('</div><ul data-testid="homeTeamGoals">'), goals("H", hs),
        F.lit('</ul><ul data-testid="awayTeamGoals">'), goals("A", as_),
        F.lit('</ul><ul data-testid="homeTeamYellowCards"><li> '), F.col("venue"),
        F.lit(" 40'</li><li></li></ul><ul data-testid=\"awayTeamRedCards\"><li>"), F.col("referee"),
        F.lit("</li></ul><script>var s='Matchweek 99';</script></body></html>"),
    )


def stats_page() -> Column:
    """Header and two sections of statistics rows."""
    row = lambda name, h, a: F.concat(
        F.lit('<tr class="match-stats__table-row"><td class="match-stats__table-cell match-stats__table-cell--home"> '),
        F.coalesce(F.col(h), F.lit("0")),
        F.lit(f' </td><td class="match-stats__table-cell match-stats__stat-name">{name}</td>'
              '<td class="match-stats__table-cell match-stats__table-cell--away">'),
        F.coalesce(F.col(a), F.lit("0")),
        F.lit("</td></tr>"),
    )
    score = F.when(
        F.col("home_score").isNotNull(),
        F.concat(F.col("home_score").cast("string"), F.lit(" – "), F.col("away_score").cast("string")),
    ).otherwise(F.lit("vs"))
    return F.concat(
        F.lit('<body><header class="match-header"><span class="match-header__team-name"> '), F.col("home_team"),
        F.lit('</span><span class="match-header__team-name">'), F.col("away_team"),
        F.lit(' </span><div class="match-header__score">'), score,
        F.lit('</div><time>'), F.col("date"),
        F.lit('</time><p class="match-header__venue">'), F.col("venue"),
        F.lit('</p><p class="match-header__referee-box">Referee: '), F.col("referee"),
        F.lit('</p></header><div class="stats-section">Attack<table>'),
        row("Passes Completed (%)", "h1", "a1"), row("XG", "h5", "a5"), row("undefined x", "h4", "a4"),
        F.lit('</table></div><div class="stats-section">Physical<table>'),
        row("Distance Covered", "h2", "a2"), row("Possession", "h3", "a3"),
        F.lit("</table></div></body>"),
    )


def info_page() -> Column:
    return F.concat(
        F.lit('<body><div class="match-details__entry">Kick-off <span>'), F.col("date"),
        F.lit(' 15:00</span></div><div class="match-details__entry">Stadium<div>'), F.col("venue"),
        F.lit('</div></div><div class="match-details__entry">Attendance: <span> '),
        (F.col("match_id") * 3).cast("string"), F.lit("</span></div></body>"),
    )


def info_text() -> Column:
    """Every second match names a referee in the text of the page."""
    return F.when(
        F.col("match_id") % 2 == 0, F.concat(F.lit("Officials\nReferee Ann "), F.col("venue"), F.lit("\nAssistant Bob"))
    ).otherwise(F.lit("Officials"))


def lineups_page() -> Column:
    """Even matches name the sides; odd ones only list 22 players."""
    player = lambda i, side: F.concat(
        F.lit(f'<div class="lineups-player"><p class="lineups-player__info">{side} '), i.cast("string"),
        F.lit('</p><span class="lineups-player__shirt-number">'), i.cast("string"), F.lit("</span></div>"),
    )
    eleven = lambda side: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(11)), lambda i: player(i, side)), "")
    named = F.concat(
        F.lit('<div class="lineups-team-formation--home">'), eleven("H"),
        F.lit('</div><div class="lineups-team-formation--away">'), eleven("A"), F.lit("</div>"),
    )
    subs = F.concat(
        F.lit('<ul class="squad-list"><li class="squad-list__item">'), F.col("home_team"),
        F.lit(' sub</li></ul><ul class="squad-list"><li class="squad-list__item">'), F.col("away_team"),
        F.lit(' sub</li><li class="squad-list__item">two</li></ul>'
              '<ul class="squad-list"><li class="squad-list__item">third list</li></ul>'),
    )
    return F.concat(
        F.lit("<body>"),
        F.when(F.col("match_id") % 2 == 0, named).otherwise(F.concat(F.lit("<div>"), eleven("H"), eleven("A"), F.lit("</div>"))),
        subs, F.lit("</body>"),
    )


def lineups_text() -> Column:
    return F.concat(
        F.lit("Formation 4-"), (F.col("match_id") % 4 + 1).cast("string"),
        F.lit("-2-1 Manager Ann "), F.col("venue"), F.lit(" Formation 3-5-2 Manager Bo Li 7"),
    )


TABS = ("main", "stats", "match_info", "lineups")


def raw_pages(spark: SparkSession, sf_dir: str, tabs: tuple[str, ...] = TABS) -> DataFrame:
    """Stored pages of every match, one row per tab."""
    m = spread(matches(spark, sf_dir))
    if "stats" in tabs:
        s = order_stats(spark, sf_dir).withColumnRenamed("match_id", "s_match_id")
        m = m.join(s, m.match_id == s.s_match_id, "left")
    made = {
        "main": lambda: (main_page(m), F.lit("")),
        "stats": lambda: (stats_page(), F.lit("")),
        "match_info": lambda: (info_page(), info_text()),
        "lineups": lambda: (lineups_page(), lineups_text()),
    }
    pages = [
        F.struct(F.lit(t).alias("tab"), h.alias("html"), v.alias("visible_text")) for t in tabs for h, v in [made[t]()]
    ]
    return m.select(
        "match_id", F.col("season"), F.col("matchweek"), F.explode(F.array(*pages)).alias("page"),
        F.to_timestamp("date").alias("fetched_at"),
    ).select("match_id", "season", "matchweek", "page.*", "fetched_at")


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result page per match with its card twice, first in full, then bare."""
    score = F.when(
        F.col("home_score").isNotNull(),
        F.concat(F.col("home_score").cast("string"), F.lit("-"), F.col("away_score").cast("string")),
    ).otherwise(F.lit("TBC"))
    html = F.concat(
        F.lit('<div class="match-list-item"><div class="match-list-item__date"> '), F.col("date"),
        F.lit('</div><a class="match-card" href="/match/'), F.col("match_id").cast("string"),
        F.lit('/x"><span class="mc-summary__team-name">'), F.col("home_team"),
        F.lit('</span><span class="mc-summary__team-name">'), F.col("away_team"),
        F.lit('</span><div class="mc-summary__score">'), score,
        F.lit('</div></a></div><a href="/match/'), F.col("match_id").cast("string"),
        F.lit('/x">again</a><a href="/club/1">other</a>'),
    )
    return spread(matches(spark, sf_dir)).select("season", "matchweek", html.alias("html"))


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of up to twelve matches: all cards in full, then all again as
    bare links. A page lists matches of neighbouring ids; its number stands in
    for the matchweek."""
    cards = result_pages(spark, sf_dir)
    again = F.concat(F.lit('<a href="/match/'), F.regexp_extract("html", r'</div><a href="/match/(.*)$', 1))
    full = F.regexp_extract("html", r'^(.*</a>)</div><a href="/match/', 1)
    number = F.floor(F.regexp_extract("html", r'href="/match/(\d+)/', 1).cast("bigint") / 12).cast("int")
    lists = cards.groupBy(number.alias("matchweek")).agg(
        F.array_sort(F.collect_list(F.concat(full, F.lit("</div>")))).alias("full"),
        F.array_sort(F.collect_list(again)).alias("again"),
    )
    html = F.concat(F.array_join("full", ""), F.lit("<div>"), F.array_join("again", "</div><div>"), F.lit("</div>"))
    return lists.select(F.lit("all").alias("season"), "matchweek", html.alias("html"))
