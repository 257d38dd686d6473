"""Whole jobs over stored pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.operators.counts import goal_count
from touchline.plans import medallion as jobs
from touchline.schemas import BRONZE, LINEAGE
from touchline.sources import changes, lake, sinks
from touchline.sources.pages import page_elements, with_elements
from touchline.streaming.incremental import ingest_stream

FIRST = 2561895
SCHEMA = "match_id bigint, tab string, html string, visible_text string, fetched_at timestamp"


def stats_html(home, away, score, shots="7"):
    return f"""<body><span class="match-header__team-name">{home}</span><span class="match-header__team-name">{away}</span>
    <div class="match-header__score">{score}</div><div class="section">Attack<table><tr class="match-stats__table-row">
    <td class="match-stats__table-cell match-stats__table-cell--home">{shots}</td>
    <td class="match-stats__table-cell match-stats__stat-name">Shots</td>
    <td class="match-stats__table-cell match-stats__table-cell--away">3 (50%)</td></tr></table></div></body>"""


def page(i, html, day=1, tab="stats"):
    return (FIRST + i, tab, html, "", dt.datetime(2025, 8, day))


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [
            page(0, stats_html("A", "B", "2 - 1")),
            page(1, stats_html("C", "A", "vs")),
            page(10, stats_html("A", "C", "0-3")),
            page(10, stats_html("A", "C", "0-4", "9"), 2),
            page(99999, stats_html("A", "C", "9-9")),
        ],
        SCHEMA,
    )


def gold(spark, root):
    rows = spark.read.parquet(sinks.latest_snapshot(spark, f"{root}/gold_master")).collect()
    return {r["match_id"] - FIRST: (r["result"], r["shots"], r["shots_pct"]) for r in rows}


def test_medallion_and_second_run(spark, pages, tmp_path):
    root = str(tmp_path)
    args = dict(seasons=["2025/26"], aliases=["A"], names=["shots"])
    counts = jobs.run_medallion(spark, root, pages, **args, stamp="1").collect()
    assert {(r["layer"], r["matchweek"]): r["n_rows"] for r in counts} == {
        (n, w): k for n in ("bronze", "silver", "gold") for w, k in ((1, 2), (2, 1))
    }
    # the later capture of a page wins; the page outside every season is not visited
    assert gold(spark, root) == {0: ("W", 7.0, None), 1: ("D", 3.0, 50.0), 10: ("L", 9.0, None)}
    state = {r["match_id"] - FIRST: r["status"] for r in sinks.read_state(spark, f"{root}/state").collect()}
    assert state == {0: "PLAYED", 1: "SCHEDULED", 10: "PLAYED"}

    # only the open match is visited again, although all pages changed
    changed = spark.createDataFrame([page(0, stats_html("A", "B", "5-5"), 9), page(1, stats_html("C", "A", "0-2"), 9)], SCHEMA)
    jobs.run_medallion(spark, root, changed, **args, stamp="2")
    assert gold(spark, root) == {0: ("W", 7.0, None), 1: ("W", 3.0, 50.0), 10: ("L", 9.0, None)}
    assert spark.read.parquet(f"{root}/bronze").count() == 4

    # nothing left to do is a normal outcome
    jobs.run_medallion(spark, root, changed, **args, stamp="3")
    assert len(gold(spark, root)) == 3
    jobs.run_medallion(spark, root, None, **args, matchweeks=[2], skip_ingest=True, stamp="4")
    assert len(gold(spark, root)) == 3
    masters = spark.read.parquet(sinks.latest_snapshot(spark, f"{root}/silver_master"))
    assert masters.count() == masters.select("match_id").distinct().count() == 3


def test_gold_of_two_teams_with_all_statistics(spark, pages, tmp_path):
    root = str(tmp_path)
    jobs.run_medallion(spark, root, pages, ["2025/26"], aliases=["A"], stamp="1")
    later = spark.createDataFrame([page(1, stats_html("C", "A", "0-2", "grade"), 9)], SCHEMA)
    counts = jobs.run_medallion(spark, root, later, ["2025/26"], aliases=["C"], stamp="2", csv_export=True).collect()
    assert sum(r["n_rows"] for r in counts if r["layer"] == "silver") == 3
    assert spark.read.parquet(f"{root}/silver").count() == 3  # one row per match after the second capture
    rows = spark.read.parquet(sinks.latest_snapshot(spark, f"{root}/gold_master")).collect()
    by = {(r["club"], r["match_id"] - FIRST): r for r in rows}
    assert set(by) == {("A", 0), ("A", 1), ("A", 10), ("C", 1), ("C", 10)}
    assert by["C", 1]["stats"]["shots"]["text"] == "grade" and by["C", 1]["result"] == "L"
    assert by["A", 0]["stats"]["shots"]["value"] == 7.0
    assert lake.read_csv_table(spark, f"{root}/export/run_id=2/gold_master").count() == 5


def test_medallion_over_documents(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    info = '{"home_team": "A", "away_team": "B", "home_score": 1, "away_score": 0}'
    (source / "a.json").write_text(f'{{"match_id": 5, "season": "2025/26", "matchweek": 1, "match_info": {info}, "statistics": {{}}}}')
    (source / "b.json").write_text("no document")
    docs = lake.read_documents(spark, str(source))
    jobs.run_medallion(spark, root, None, ["2025/26"], documents=docs, all_teams=True, stamp="1")
    rows = spark.read.parquet(sinks.latest_snapshot(spark, f"{root}/gold_master")).collect()
    assert {(r["team"], r["result"]) for r in rows} == {("A", "W"), ("B", "L")}
    assert spark.read.parquet(f"{root}/rejects").count() == 1


def test_no_order_raises(spark, pages):
    from touchline.operators.masters import append_gold

    with pytest.raises(ValueError):
        append_gold(spark.createDataFrame([(1, "A")], "match_id bigint, team string"))


def test_state_of_stream_and_job_in_turn(spark, tmp_path):
    source, root = str(tmp_path / "pages"), str(tmp_path / "lake")

    def status():
        return sinks.read_state(spark, f"{root}/state").first()["status"]

    def stream(html, day):
        spark.createDataFrame([page(1, html, day)], SCHEMA).write.mode("append").parquet(source)
        ingest_stream(spark, source, root, ["2025/26"], str(tmp_path / "progress")).awaitTermination()
        return status()

    assert stream(stats_html("C", "A", "vs"), 1) == "SCHEDULED"
    jobs.ingest(spark, root, spark.createDataFrame([page(1, stats_html("C", "A", "0-2"), 2)], SCHEMA), ["2025/26"])
    assert status() == "PLAYED"
    assert stream(stats_html("C", "A", "vs"), 3) == "PLAYED"


def test_ingest_exports_formats(spark, pages, tmp_path):
    landed = jobs.ingest(spark, str(tmp_path), pages, ["2025/26"], [1], ("json", "csv"), stamp="1")
    assert sorted(r["match_id"] - FIRST for r in landed.collect()) == [0, 1]
    docs = lake.read_documents(spark, f"{tmp_path}/export/run_id=1/json", multi_line=False)
    assert jobs.silver_long(docs).count() == 4
    assert lake.read_csv_table(spark, f"{tmp_path}/export/run_id=1/csv").count() == 2


def test_stream_lands_new_pages_once(spark, pages, tmp_path):
    source, root = str(tmp_path / "pages"), str(tmp_path / "lake")
    pages.write.parquet(source)
    for _ in range(2):
        ingest_stream(spark, source, root, ["2025/26"], str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 3
    spark.createDataFrame([page(1, stats_html("C", "A", "0-2"), 9)], SCHEMA).write.mode("append").parquet(source)
    ingest_stream(spark, source, root, ["2025/26"], str(tmp_path / "progress")).awaitTermination()
    state = {r["match_id"] - FIRST: r["status"] for r in sinks.read_state(spark, f"{root}/state").collect()}
    assert state == {0: "PLAYED", 1: "PLAYED", 10: "PLAYED"}


def test_page_elements():
    found = page_elements(
        '<ul class="squad-list"><li>a<br>b<li> c <script>x</script></ul><p class="name">open<div class="score">1</div>'
    )
    by_tag = [(e[2], e[8], e[9]) for e in found]
    assert by_tag == [
        ("ul", "ab c ", "a\nb\nc"), ("li", "ab", "a\nb"), ("li", " c ", "c"), ("p", "open", "open"), ("div", "1", "1"),
    ]
    assert [(e[6], e[7]) for e in found[1:3]] == [(True, False), (False, True)]
    assert page_elements("") == [] and page_elements(None) == []


def test_lineups_and_events_without_content(spark):
    from touchline.operators import extract

    df = spark.createDataFrame([("<div></div>", "")], "html string, visible_text string")
    es, text = F.col("elements"), F.col("visible_text")
    row = with_elements(df).select(
        extract.match_events(es).alias("e"), extract.lineups_tab(es, text).alias("l"), extract.stat_rows(es).alias("s"),
        extract.match_header(es).alias("h"), extract.match_info_tab(es, text).alias("i"), goal_count(extract.match_events(es)).alias("n"),
        extract.match_cards(es).alias("c"), extract.page_matchweek(es, text).alias("w"),
    ).first()
    assert row["e"]["half_time_score"] is None and row["e"]["home_goals"] == [] and row["e"]["away_red_cards"] == []
    assert row["l"]["home"]["starting_xi"] == [] and row["l"]["away"]["substitutes"] == []
    assert row["s"] == {} and row["h"]["home_team"] is None and row["i"]["referee"] is None
    assert (row["n"], row["c"], row["w"]) == (0, [], None)


def document(i, week, home="A", away="B", score=1, day=1, season="2025/26"):
    info = {"home_team": home, "away_team": away, "home_score": str(score), "away_score": "0"}
    return (i, None, season, week, None, info, {"Shots": '{"home": "%d", "away": "1"}' % day}, {}, None, None, None, f"f{day}.json", 0, i, dt.datetime(2025, 8, day))


LANDED = f"{BRONZE}, _corrupt_record string, source_file string, source_block bigint, source_pos bigint, ingested_at timestamp"


def run_documents(spark, root, rows, stamp, **args):
    docs = None if rows is None else spark.createDataFrame(rows, LANDED)
    args = {"all_teams": True, **args}
    return jobs.run_medallion(spark, root, None, None, documents=docs, skip_ingest=rows is None, stamp=stamp, **args).collect()


def silver_places(spark, root):
    return sorted((r["match_id"], r["season"], r["matchweek"]) for r in spark.read.parquet(f"{root}/silver").collect())


def gold_rows(spark, root):
    return sorted((r["match_id"], r["club"], r["matchweek"], r["result"]) for r in spark.read.parquet(f"{root}/gold").collect())


def test_moved_match_stands_once(spark, tmp_path):
    root = str(tmp_path)
    run_documents(spark, root, [document(1, 5), document(2, 5, "A", "C"), document(3, 6)], "1")
    counts = run_documents(spark, root, [document(1, 9, "A", "D", 0, day=2)], "2")
    assert silver_places(spark, root) == [(1, "2025/26", 9), (2, "2025/26", 5), (3, "2025/26", 6)]
    assert gold_rows(spark, root) == [(1, "A", 9, "D"), (1, "D", 9, "D"), (2, "A", 5, "W"), (2, "C", 5, "L"), (3, "A", 6, "W"), (3, "B", 6, "L")]
    by = {(r["layer"], r["matchweek"]): r["n_rows"] for r in counts}
    assert by == {(layer, w): 1 for layer in ("bronze", "silver", "gold") for w in (5, 6, 9)}
    # the last match of a week and the last of a season move away
    run_documents(spark, root, [document(2, 1, "A", "C", season="2026/27", day=3), document(3, 9, day=3)], "3")
    assert silver_places(spark, root) == [(1, "2025/26", 9), (2, "2026/27", 1), (3, "2025/26", 9)]
    assert sorted(p for p in changes.partition_folders(spark, f"{root}/silver", sinks.PARTITIONS)) == [("2025/26", "9"), ("2026/27", "1")]
    assert ("C", "2025/26") not in changes.partition_folders(spark, f"{root}/gold", ("club", "season"))
    masters = jobs.read_masters(spark, root)
    assert sorted(r["match_id"] for r in masters["silver"].collect()) == [1, 2, 3]
    assert sorted((r["match_id"], r["club"]) for r in masters["gold"].collect()) == [(1, "A"), (1, "D"), (2, "A"), (2, "C"), (3, "A"), (3, "B")]


def test_changes_equal_a_full_rebuild_and_touch_few_partitions(spark, tmp_path):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    first = [document(i, 1 + i % 9, "ABCD"[i % 4], "EFGH"[i % 3], i % 3) for i in range(60)]
    second = [document(i, 1 + i % 5, "ABCD"[i % 3], "EFGH"[i % 4], i % 2, day=2) for i in (3, 17, 18, 61)]
    run_documents(spark, step, first, "1")
    before = {p: {f.name for f in p.iterdir()} for p in (tmp_path / "step/silver").glob("season=*/matchweek=*")}
    run_documents(spark, step, second, "2")
    changed = {p.name for p, files in before.items() if {f.name for f in p.iterdir()} != files}
    assert changed == {f"matchweek={w}" for i in (3, 17, 18, 61) for w in (1 + i % 9, 1 + i % 5)} - {"matchweek=8"} | {"matchweek=9"}
    jobs.land_documents(spark.createDataFrame(first, LANDED), whole, "1")
    run_documents(spark, whole, second, "2")
    for layer in ("silver", "gold"):
        columns = [c for c in spark.read.parquet(f"{whole}/{layer}").columns if c not in (*LINEAGE, "stats")]
        rows = [spark.read.parquet(f"{root}/{layer}").select(*columns, F.to_json("stats").alias("stats")) for root in (step, whole)]
        assert rows[0].exceptAll(rows[1]).count() == rows[1].exceptAll(rows[0]).count() == 0
        mine, all_at_once = (jobs.read_masters(spark, root)[layer].select("match_id", "season").collect() for root in (step, whole))
        assert sorted(mine) == sorted(all_at_once)
    # nothing landed: nothing is written
    folders = changes.published(spark, f"{step}/masters")
    run_documents(spark, step, None, "3")
    assert changes.published(spark, f"{step}/masters") == folders


def test_older_landing_does_not_replace_a_newer_one(spark, tmp_path):
    root = str(tmp_path)
    jobs.land_documents(spark.createDataFrame([document(1, 5)], LANDED), root, "1")
    jobs.land_documents(spark.createDataFrame([document(1, 9, score=3, day=2)], LANDED), root, "2")
    for stamp, weeks in (("3", [9]), ("4", [5])):
        jobs.run_medallion(spark, root, None, ["2025/26"], weeks, skip_ingest=True, all_teams=True, stamp=stamp)
    assert silver_places(spark, root) == [(1, "2025/26", 9)]


@pytest.mark.parametrize("step", ["rewrite_partitions", "consume"])
def test_killed_run_leaves_nothing_behind(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    run_documents(spark, root, [document(1, 5), document(2, 5)], "1")

    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(changes, step, killed)
        with pytest.raises(RuntimeError):
            run_documents(spark, root, [document(1, 9, day=2)], "2")
    # the match moves on before the next run
    run_documents(spark, root, [document(1, 12, day=3)], "3")
    assert silver_places(spark, root) == [(1, "2025/26", 12), (2, "2025/26", 5)]
    assert {r[:3] for r in gold_rows(spark, root)} == {(1, "A", 12), (1, "B", 12), (2, "A", 5), (2, "B", 5)}


def test_masters_become_visible_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    run_documents(spark, root, [document(1, 5)], "1")
    old = changes.published(spark, f"{root}/masters")
    write, calls = sinks.write_snapshot, []

    def second_fails(df, path, stamp=None):
        if path.endswith("gold_master"):
            calls.append(path)
            raise RuntimeError("killed")
        return write(df, path, stamp)

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_snapshot", second_fails)
        with pytest.raises(RuntimeError):
            run_documents(spark, root, [document(2, 6, day=2)], "2")
    assert calls and changes.published(spark, f"{root}/masters") == old
    assert [r["match_id"] for r in jobs.read_masters(spark, root)["silver"].collect()] == [1]
    run_documents(spark, root, None, "3")
    assert sorted(r["match_id"] for r in jobs.read_masters(spark, root)["silver"].collect()) == [1, 2]
    assert {r["match_id"] for r in jobs.read_masters(spark, root)["gold"].collect()} == {1, 2}
    with pytest.raises(FileExistsError):
        changes.publish(spark, f"{root}/masters", "3", {})


def test_alias_table_of_a_run(spark, tmp_path):
    root = str(tmp_path)
    clubs = spark.createDataFrame([("A", "Club A"), ("Aa", "Club A")], "alias string, club string")
    run_documents(spark, root, [document(1, 5), document(2, 6, "C", "Aa")], "1", alias_table=clubs)
    assert gold_rows(spark, root) == [(1, "Club A", 5, "W"), (2, "Club A", 6, "L")]
    # another table makes Gold anew
    more = clubs.union(spark.createDataFrame([("B", "Club B")], clubs.schema))
    run_documents(spark, root, None, "2", alias_table=more)
    assert gold_rows(spark, root) == [(1, "Club A", 5, "W"), (1, "Club B", 5, "L"), (2, "Club A", 6, "L")]


def test_rows_without_season_or_week(spark, tmp_path):
    root = str(tmp_path)
    run_documents(spark, root, [document(1, None), document(2, 5, season=None)], "1")
    run_documents(spark, root, [document(1, 3, day=2), document(2, None, day=2)], "2")
    assert silver_places(spark, root) == [(1, "2025/26", 3), (2, "2025/26", None)]
