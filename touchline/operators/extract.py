"""Stored pages -> Bronze documents.

Input rows hold ``elements`` (see ``sources.pages``) and ``visible_text``. All
fields are found with array expressions inside the row of a page.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from touchline import schemas
from touchline.functions import text as tx
from touchline.functions.dom import (
    both, card_entries, category_of, class_like, closest, drop_undefined_names, either,
    goal_entries, has_class, inside, is_tag, select_all, select_first, with_rows,
)
from touchline.functions.text import blank_to_null, let, strip
from touchline.operators.documents import merge_match_info


def _text(e: Column) -> Column:
    return strip(e["text"])


def _stripped(elements: Column) -> Column:
    return F.transform(elements, _text)


def _team_names(elements: Column, selectors: list) -> Column:
    """texts of the first selector that finds both teams."""
    found = [let(_stripped(select_all(elements, s)), tx.first_pair) for s in selectors]
    return F.coalesce(*found)


def _score(elements: Column) -> Column:
    """Both scores of the first element that shows any, text looked up once."""

    def scores(text: Column) -> Column:
        home, away = tx.score_from_text(text)
        return F.struct(home.alias("home"), away.alias("away"))

    return let(_text(select_first(elements, class_like("score"))), scores)


def match_cards(elements: Column) -> Column:
    """Cards of a result page, the first one per match id (A7), in order."""
    is_card = either(
        both(is_tag("a"), has_class("match-card")),
        both(is_tag("a"), lambda e: F.contains(e["href"], F.lit("/match/"))),
    )

    is_item = has_class("match-list-item")

    def found_on(c: Column, es: Column, items: Column) -> Column:
        """What is shown in a card, and the first date of the item around it."""
        names = [has_class("mc-summary__team-name"), class_like("team-name"), has_class("team-name")]
        return F.struct(
            let(inside(es, c), lambda own: F.struct(_team_names(own, names).alias("names"), _score(own).alias("score"))).alias("own"),
            let(
                closest(items, is_item, c),
                lambda item: let(_text(select_first(es, has_class("match-list-item__date"), item)), blank_to_null),
            ).alias("date"),
        )

    def card(es: Column, items: Column, c: Column) -> Column:
        return let(
            found_on(c, es, items),
            lambda f: F.struct(
                tx.match_id_from_href(c["href"]).alias("match_id"),
                F.get(f["own"]["names"], F.lit(0)).alias("home_team"),
                F.get(f["own"]["names"], F.lit(1)).alias("away_team"),
                f["own"]["score"]["home"].alias("home_score"),
                f["own"]["score"]["away"].alias("away_score"),
                f["date"].alias("date"),
            ),
        )

    def cards(es: Column) -> Column:
        listed = let(F.filter(es, is_item), lambda items: F.transform(F.filter(es, is_card), lambda c: card(es, items, c)))
        return let(F.filter(listed, lambda c: c["match_id"].isNotNull()), first_per_id)

    return with_rows(elements, cards)


def first_per_id(cards: Column) -> Column:
    """The first card per match id within a page."""
    return let(
        F.transform(cards, lambda c: c["match_id"]),
        lambda ids: F.filter(cards, lambda c, i: F.array_position(ids, c["match_id"]) == i + 1),
    )


def extract_match_cards(pages: DataFrame) -> DataFrame:
    """X1 as rows, with the season and matchweek of their page."""
    return pages.select("season", "matchweek", F.explode(match_cards(F.col("elements"))).alias("card")).select(
        "card.*", "season", "matchweek"
    )


def match_header(elements: Column) -> Column:
    """Teams, score, date, venue and referee as ``match_info``."""
    names = _team_names(
        elements,
        [
            has_class("match-header__team-name"), has_class("team-name"),
            class_like("team-name"), has_class("mc-summary__team-name"),
        ],
    )
    date = select_first(elements, either(has_class("match-header__date"), class_like("match-date"), is_tag("time")))
    venue = select_first(elements, class_like("venue"))
    referee = select_first(elements, class_like("referee"))
    return let(
        F.struct(names.alias("names"), _score(elements).alias("score")),
        lambda f: F.create_map(
            F.lit("home_team"), F.get(f["names"], F.lit(0)),
            F.lit("away_team"), F.get(f["names"], F.lit(1)),
            F.lit("home_score"), f["score"]["home"].cast("string"),
            F.lit("away_score"), f["score"]["away"].cast("string"),
            F.lit("date"), let(_text(date), blank_to_null),
            F.lit("venue"), let(_text(venue), blank_to_null),
            F.lit("referee"), let(referee["text"], tx.strip_label),
        ),
    )


def page_matchweek(elements: Column, visible_text: Column) -> Column:
    """F12 on a page: four places, then the whole text."""
    places = [
        has_class("match-header__gameweek"), class_like("matchweek"),
        class_like("gameweek"), has_class("mc-summary__info"),
    ]
    labels = F.struct(*[select_first(elements, p)["text"].alias(f"p{i}") for i, p in enumerate(places)])
    return let(
        labels, lambda found: tx.matchweek_from_text([found[f"p{i}"] for i in range(len(places))], visible_text)
    )


def stat_rows(elements: Column) -> Column:
    """Statistic name -> JSON of raw and leading values."""
    row = either(has_class("match-stats__table-row"), class_like("stats-row"), class_like("stat-row"))
    home_cell = either(
        has_class("match-stats__table-cell--home"), class_like("home", "value"),
        both(is_tag("td"), lambda e: e["first"]),
    )
    away_cell = either(
        has_class("match-stats__table-cell--away"), class_like("away", "value"),
        both(is_tag("td"), lambda e: e["last"]),
    )

    def entry(own: Column) -> Column:
        return F.struct(
            _text(select_first(own, class_like("name"))).alias("name"),
            _text(select_first(own, home_cell)).alias("home"),
            _text(select_first(own, away_cell)).alias("away"),
        )

    entries = with_rows(elements, lambda es: F.transform(F.filter(es, row), lambda r: let(inside(es, r), entry)))
    named = F.filter(entries, lambda s: s["name"] != "")
    return F.map_from_entries(
        F.transform(
            named,
            lambda s: F.struct(
                s["name"].alias("key"),
                F.to_json(
                    F.struct(
                        s["home"].alias("home"),
                        s["away"].alias("away"),
                        tx.leading_number(s["home"]).alias("home_parsed"),
                        tx.leading_number(s["away"]).alias("away_parsed"),
                    ),
                    {"ignoreNullFields": "false"},
                ).alias("value"),
            ),
        )
    )


def stats_by_category(elements: Column) -> Column:
    """Category -> JSON object of name -> ``{home, away}``, every category."""

    def row(es: Column, sections: Column, r: Column) -> Column:
        cells = select_all(es, has_class("match-stats__table-cell"), r)
        section = closest(sections, class_like("section"), r)
        return let(
            cells,
            lambda c: F.struct(
                F.when(F.size(c) >= 3, _text(F.get(c, F.lit(0)))).alias("home"),
                F.when(F.size(c) >= 3, _text(F.get(c, F.lit(1)))).alias("name"),
                F.when(F.size(c) >= 3, _text(F.get(c, F.lit(2)))).alias("away"),
                category_of(section["text"]).alias("category"),
            ),
        )

    def rows_of(es: Column) -> Column:
        rows = F.filter(es, has_class("match-stats__table-row"))
        return let(F.filter(es, class_like("section")), lambda sections: F.transform(rows, lambda r: row(es, sections, r)))

    rows = drop_undefined_names(with_rows(elements, rows_of))

    def category_json(rs: Column, category: str) -> Column:
        stats = F.map_from_entries(
            F.transform(
                F.filter(rs, lambda s: s["category"] == category),
                lambda s: F.struct(
                    s["name"].alias("key"), F.struct(s["home"].alias("home"), s["away"].alias("away")).alias("value")
                ),
            )
        )
        return F.to_json(stats, {"ignoreNullFields": "false"})

    def as_maps(rs: Column) -> Column:
        return F.create_map(*[c for k in schemas.CATEGORIES for c in (F.lit(k), category_json(rs, k))])

    return let(rows, as_maps)


def match_info_tab(elements: Column, visible_text: Column) -> Column:
    """Kick-off, stadium, attendance and referee."""
    def entries(es: Column) -> Column:
        return F.transform(
            F.filter(es, has_class("match-details__entry")),
            lambda e: F.struct(e["visible"].alias("text"), select_first(es, is_tag("span"), e)["visible"].alias("span")),
        )

    return let(
        with_rows(elements, entries),
        lambda es: F.create_map(
            F.lit("kickoff"), tx.info_entry(es, "kick-off", "kickoff"),
            F.lit("stadium"), tx.info_entry(es, "stadium"),
            F.lit("attendance"), tx.info_entry(es, "attendance"),
            F.lit("referee"), tx.referee_from_text(visible_text),
        ),
    )


_PLAYER = "struct<name:string,number:string>"


def _players(elements: Column, container: str) -> Column:
    """Players of the first matching container."""
    name_selectors = [
        both(is_tag("p"), has_class("lineups-player__info")), is_tag("p"), has_class("lineups-player__name")
    ]
    number_selectors = [has_class("lineups-player__shirt-number"), has_class("lineups-player__number")]

    def player(own: Column) -> Column:
        return F.struct(
            F.coalesce(*[select_first(own, s)["visible"] for s in name_selectors]).alias("name"),
            F.coalesce(*[select_first(own, s)["visible"] for s in number_selectors]).alias("number"),
        )

    return let(
        select_first(elements, has_class(container)),
        lambda b: F.filter(
            F.transform(select_all(elements, has_class("lineups-player"), b), lambda p: let(inside(elements, p), player)),
            lambda p: F.coalesce(p["name"], F.lit("")) != "",
        ),
    ).cast(f"array<{_PLAYER}>")


def slice_lineup(players: Column) -> tuple[Column, Column]:
    """O3: the first eleven are home, the next away, if there are 22."""
    none = F.array().cast(f"array<{_PLAYER}>")
    full = F.size(players) >= 22
    return (
        F.when(full, F.slice(players, 1, 11)).otherwise(none),
        F.when(full, F.slice(players, 12, 11)).otherwise(none),
    )


def lineups_tab(elements: Column, visible_text: Column, whole_formation: bool = False) -> Column:
    """Formation, manager, starting eleven and substitutes of both sides."""
    return with_rows(elements, lambda es: _lineups(es, visible_text, whole_formation))


def _lineups(elements: Column, visible_text: Column, whole_formation: bool) -> Column:
    formations = tx.formations_from_text(visible_text, whole_formation)
    managers = tx.managers_from_text(visible_text)
    everyone = F.transform(
        F.filter(elements, has_class("lineups-player")),
        lambda p: F.struct(tx.first_line(p["visible"]).alias("name"), F.lit(None).cast("string").alias("number")),
    ).cast(f"array<{_PLAYER}>")
    lists = F.slice(F.filter(elements, has_class("squad-list")), 1, 2)

    def substitutes(box: Column) -> Column:
        return F.coalesce(
            F.transform(
                F.when(box.isNotNull(), select_all(elements, has_class("squad-list__item"), box)),
                lambda i: F.struct(strip(i["visible"]).alias("name")),
            ),
            F.array().cast("array<struct<name:string>>"),
        )

    def sides(b: Column) -> Column:
        none_named = (F.size(b["home"]) == 0) & (F.size(b["away"]) == 0)
        first, second = slice_lineup(everyone)
        eleven = (F.when(none_named, first).otherwise(b["home"]), F.when(none_named, second).otherwise(b["away"]))
        return F.struct(
            *[
                F.struct(
                    formations[i].alias("formation"),
                    managers[i].alias("manager"),
                    eleven[i].alias("starting_xi"),
                    let(F.get(lists, F.lit(i)), substitutes).alias("substitutes"),
                ).alias(side)
                for i, side in enumerate(("home", "away"))
            ]
        )

    named = F.struct(
        _players(elements, "lineups-team-formation--home").alias("home"),
        _players(elements, "lineups-team-formation--away").alias("away"),
    )
    return let(named, sides)


def match_events(elements: Column) -> Column:
    """Half-time score, goals and cards of both sides."""
    return with_rows(elements, _events)


def _events(elements: Column) -> Column:
    half_time = select_first(elements, has_class("match-status__half-time-score"))

    def items(testid: str) -> Column:
        box = select_first(elements, both(is_tag("ul"), lambda e: e["testid"] == testid))
        return let(box, lambda b: select_all(elements, both(is_tag("li"), lambda e: b.isNotNull()), b))

    goals = [
        goal_entries(elements, items(f"{side}TeamGoals")).alias(f"{side}_goals") for side in ("home", "away")
    ]
    cards = [
        card_entries(items(f"{side}Team{colour}Cards")).alias(f"{side}_{colour.lower()}_cards")
        for colour in ("Yellow", "Red")
        for side in ("home", "away")
    ]
    return F.struct(let(strip(half_time["visible"]), tx.half_time_score).alias("half_time_score"), *goals, *cards)


# Rows of a file in one bitmap of newest_captures: as many as the bits of ``bitmap_construct_agg``.
_BITS = 32_768


def newest_captures(pages: DataFrame, stored: bool = False) -> DataFrame:
    """The pages of each match and tab that were captured last; those of one
    time all stay. The times are found without a look at the pages, so superseded
    pages reach no parser. Pages without a time are the oldest.

    ``stored`` says that each row is a row of a Parquet file, as ``spark.read`` gives them.
    Then pages stay where they lie: keys, times and places are compared, and the newest
    rows of each file come back as a bitmap, one broadcast bit for each page."""
    if not stored:
        return _newest(pages)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    newest = _newest(pages.select("match_id", "tab", "fetched_at", *place))
    block, bit = F.floor(F.col("_row") / _BITS).alias("_block"), F.pmod("_row", F.lit(_BITS))
    bits = newest.groupBy("_file", block).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_newest = byte.bitwiseAND(F.expr("shiftleft(1, cast(pmod(_row, 8) as int))")) > 0
    placed = pages.select("*", *place).withColumn("_block", F.floor(F.col("_row") / _BITS))
    return placed.join(F.broadcast(bits), ["_file", "_block"]).where(is_newest).select(*pages.columns)


def _newest(pages: DataFrame) -> DataFrame:
    keys = ["match_id", "tab", "fetched_at"]
    last = pages.groupBy(*keys[:2]).agg(F.max("fetched_at").alias("fetched_at")).toDF(*(f"_last_{k}" for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_last_{k}")) for k in keys]
    return pages.join(last, reduce(and_, same), "left_semi")


def extract_tabs(pages: DataFrame) -> DataFrame:
    """X2-X7 per page: each tab fills the part of the document it shows."""
    es, visible = F.col("elements"), F.col("visible_text")
    tab = F.col("tab")
    return pages.select(
        "match_id",
        "tab",
        "fetched_at",
        "page_hash",
        F.when(tab == "main", match_events(es)).alias("events"),
        F.when(tab == "main", page_matchweek(es, visible)).alias("page_matchweek"),
        F.when(tab == "stats", match_header(es)).alias("header"),
        F.when(tab == "stats", stat_rows(es)).alias("statistics"),
        F.when(tab == "stats", stats_by_category(es)).alias("detailed_statistics"),
        F.when(tab == "match_info", match_info_tab(es, visible)).alias("extra"),
        F.when(tab == "lineups", lineups_tab(es, visible)).alias("lineups"),
    )


def assemble_documents(tabs: DataFrame, ignore_null_extra: bool = False) -> DataFrame:
    """One Bronze row per match out of its tabs; the latest capture wins.

    Only the small extracted parts are shuffled, and they are reduced to one
    per match and tab before that. ``max_by`` skips the NULLs of other tabs
    through its order value.
    """

    def latest(column: str, tab: str) -> Column:
        when = F.when(F.col("tab") == tab, F.struct("fetched_at", "page_hash"))
        return F.max_by(F.col(column), when).alias(column)

    parts = {
        "page_matchweek": "main", "events": "main", "header": "stats", "statistics": "stats",
        "detailed_statistics": "stats", "extra": "match_info", "lineups": "lineups",
    }
    tabs = tabs.withColumn("page_matchweek", F.struct("page_matchweek"))
    grouped = tabs.groupBy("match_id").agg(
        *[latest(c, t) for c, t in parts.items()], F.max("fetched_at").alias("fetched_at")
    )
    return grouped.select(
        "match_id",
        F.col("page_matchweek.page_matchweek").alias("page_matchweek"),
        tx.iso_now(F.col("fetched_at")).alias("scraped_at"),
        merge_match_info(F.col("header"), F.col("extra"), ignore_null_extra).alias("match_info"),
        "statistics",
        "detailed_statistics",
        F.col("events").cast(schemas.EVENTS).alias("events"),
        F.col("lineups").cast(schemas.LINEUPS).alias("lineups"),
    )
