"""Pages of any length: selectors look into an element, not at the whole page for each."""

import json
import time

import pytest
from pyspark.sql import functions as F

from touchline.operators import extract
from touchline.sources.pages import page_elements, with_elements


def extracted(spark, html, column, most):
    """What ``column`` finds on a page, in less than so many seconds."""
    pages = spark.createDataFrame([(html, "")], "html string, visible_text string")
    began = time.perf_counter()
    found = with_elements(pages).select(column.alias("c")).first()["c"]
    assert time.perf_counter() - began < most
    return found


def test_entries_know_what_lies_in_them():
    found = page_elements('<ul class="squad-list"><li>a<span>b</span><li>c</ul><div><p>d</p></div>')
    assert [(e[2], e[10], e[11]) for e in found] == [("ul", 0, 3), ("li", 1, 1), ("span", 2, 0), ("li", 3, 0), ("p", 4, 0)]


@pytest.mark.parametrize("markup, texts", [
    ('<script src=a/><p>x</p></script><p>y</p>', ["y"]), ('<script src="a"/><p>x</p>', ["x"]),
    ('<STYLE>p < a</b> </sty</STYLE ><p>y', ["y"]), ('<p a="1>2">x</p><!-- <p>n</p> --><p>y', ["x", "y"]), ("<script><p>x", []),
])
def test_scripts_and_quotes(markup, texts):
    assert [e[8] for e in page_elements(markup) if e[2] == "p"] == texts


def test_lineups_of_many_players(spark):
    player = '<div class="lineups-player"><p class="lineups-player__info">P {0}</p><span class="lineups-player__number">{0}</span></div>'
    box = lambda side: f'<div class="lineups-team-formation--{side}">{"".join(map(player.format, range(1500)))}</div>'
    found = extracted(spark, box("home") + box("away"), extract.lineups_tab(F.col("elements"), F.col("visible_text")), 12)
    for side in ("home", "away"):
        assert [(p["name"], p["number"]) for p in found[side]["starting_xi"]] == [(f"P {i}", str(i)) for i in range(1500)]


def test_cards_of_many_matches(spark):
    card = """<div class="match-list-item"><div class="match-list-item__date">{0} May</div><a class="match-card" href="/match/{0}"><span
      class="team-name">H{0}</span><span class="team-name">A{0}</span><div class="score">{0}-1</div></a></div><a href="/match/{0}">again</a>"""
    found = extracted(spark, "".join(map(card.format, range(400))), extract.match_cards(F.col("elements")), 12)
    assert [tuple(c) for c in found] == [(i, f"H{i}", f"A{i}", i, 1, f"{i} May") for i in range(400)]


def stats_table(n):
    row = '<tr class="match-stats__table-row"><td class="match-stats__table-cell">{0}</td><td class="match-stats__table-cell name">N{0}</td><td class="match-stats__table-cell">7</td></tr>'
    return f'<div class="section">Attack<table>{"".join(map(row.format, range(n)))}</table></div>'


def test_rows_of_many_statistics(spark):
    found = extracted(spark, stats_table(6000), F.map_keys(extract.stat_rows(F.col("elements"))), 8)
    assert found == [f"N{i}" for i in range(6000)]


def test_many_goals(spark):
    goal = '<li><div class="scoreboard-event__scorer">S{0}</div><div class="scoreboard-event__assist">A{0}</div></li>'
    html = f'<ul data-testid="homeTeamGoals">{"".join(map(goal.format, range(6000)))}</ul>'
    found = extracted(spark, html, extract.match_events(F.col("elements")), 8)
    assert [(g["scorer"], g["assist"]) for g in found["home_goals"]] == [(f"S{i}", f"A{i}") for i in range(6000)]


def test_categories_of_many_statistics(spark):
    found = extracted(spark, stats_table(3000), extract.stats_by_category(F.col("elements")), 8)
    assert json.loads(found["attack"]) == {f"N{i}": {"home": str(i), "away": "7"} for i in range(3000)}
