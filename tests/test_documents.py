"""Documents through Bronze, Silver and Gold."""

import json

import pytest

from touchline.operators.documents import clean_documents, reserved_stats
from touchline.operators.gold import all_perspectives, team_record
from touchline.operators.silver import stat_names, to_wide
from touchline.plans import medallion as jobs
from touchline.sources import lake

SAMPLE = {
    "match_id": 2561895, "url": "https://example.org/match/2561895", "season": "2025/26", "matchweek": 1,
    "scraped_at": "2025-08-16T10:00:00.000000",
    "match_info": {"home_team": " Team A ", "away_team": "Team B", "home_score": 2, "away_score": 1, "date": "Sat 16 Aug",
                   "venue": "Ground A", "kickoff": "15:00", "referee": None},
    "statistics": {
        "Possession": {"home": "55%", "away": "45%", "home_parsed": "55", "away_parsed": "45"},
        "Passes Completed (%)": {"home": "412 (86%)", "away": "300 (79%)"},
    },
    "detailed_statistics": {
        "top_stats": {}, "attack": {"XG": {"home": "1.25", "away": "1"}},
        "physical": {"Distance Covered": {"home": "108.4km", "away": "110 km"}},
    },
    "events": {"half_time_score": "1-0", "home_goals": [{"scorer": "P One 12'", "assist": "P Two"}]},
    "lineups": {"home": {"formation": "4-3-3", "starting_xi": [{"name": "P One", "number": "9"}]}},
}


def doc(match_id, **changes):
    return {**SAMPLE, "match_id": match_id, **changes}


@pytest.fixture
def read(spark, tmp_path):
    def run(*docs):
        for i, d in enumerate(docs):
            text = d if isinstance(d, str) else json.dumps(d, indent=2, ensure_ascii=False)
            (tmp_path / f"{i:03d}.json").write_text(text, encoding="utf-8")
        return lake.read_documents(spark, str(tmp_path))

    return run


def silver_of(docs):
    return {r["match_id"]: r for r in jobs.bronze_to_silver(docs).collect()}


def home(row, stat):
    return tuple(row["stats"][stat]["home"])


def test_sample_document(read):
    row = jobs.silver_wide(read(SAMPLE), ["possession", "passes_completed", "xg", "distance_covered"]).first().asDict()
    want = {
        "match_id": 2561895, "season": "2025/26", "matchweek": 1, "date": "Sat 16 Aug", "venue": "Ground A", "referee": None,
        "home_team": "Team A", "away_team": "Team B", "home_score": 2, "away_score": 1,
        "home_possession": 55.0, "away_possession": 45.0, "home_passes_completed": 412.0, "home_passes_completed_pct": 86.0,
        "away_passes_completed": 300.0, "away_passes_completed_pct": 79.0, "home_xg": 1.25, "away_xg": 1.0,
        "home_distance_covered": 108.4, "away_distance_covered": 110.0, "home_xg_pct": None,
    }
    assert {k: row[k] for k in want} == want


def test_bundle_array_and_broken_file(read):
    docs = read([doc(1), doc(2)], "{broken", doc(3))
    assert sorted(r[0] for r in lake.accepted(docs).select("match_id").collect()) == [1, 2, 3]
    assert lake.rejects(docs).count() == 1


def test_edge_documents(read):
    without = {k: v for k, v in SAMPLE.items() if k not in ("match_info", "statistics", "detailed_statistics")}
    rows = silver_of(
        read(
            doc(1, match_info=None),
            {**without, "match_id": 2},
            doc(3, statistics=[1], detailed_statistics={"attack": 7, "physical": {"A": {"home": 1.5, "away": None}, "B": "x"}}),
            doc(4, match_info={"home_score": 2.7, "away_score": "2.7"}),
            doc(5, match_info={"home_score": -2.7, "away_score": "abc"}),
            doc(6, match_info={"home_score": None, "date": "d", "date_time": ""}),
        )
    )
    assert rows[1]["home_team"] is None and home(rows[1], "possession") == (55.0, None, None)
    assert rows[2]["stats"] == {}
    assert set(rows[3]["stats"]) == {"a"} and home(rows[3], "a") == (1.5, None, None)
    assert (rows[4]["home_score"], rows[4]["away_score"]) == (2, 0)
    assert (rows[5]["home_score"], rows[5]["away_score"]) == (-2, 0)
    assert rows[6]["home_score"] is None and rows[6]["date"] == "d"


def stats_doc(match_id, stats):
    return doc(match_id, statistics={k: {"home": v, "away": v} for k, v in stats}, detailed_statistics={})


def test_colliding_names(read):
    rows = silver_of(
        read(
            stats_doc(1, [("Shots", "5 (50%)"), ("shots", "7")]),
            stats_doc(2, [("shots", "7"), ("Shots (%)", "5 (50%)")]),
            stats_doc(3, [("x", "5 (50%)"), ("x pct", "9")]),
            stats_doc(4, [("x pct", "9"), ("x", "5 (50%)")]),
            stats_doc(5, [("x ", "1"), ("X", "2"), (" x", "3")]),
        )
    )
    assert home(rows[1], "shots") == (7.0, 50.0, None)
    assert home(rows[2], "shots") == (5.0, 50.0, None)
    assert home(rows[3], "x") == (5.0, None, None) and home(rows[3], "x_pct") == (9.0, None, None)
    assert home(rows[4], "x") == (5.0, 50.0, None) and home(rows[4], "x_pct") == (None, None, None)
    # trimmed names meet first: "x" keeps its first place, so "X" comes last
    assert home(rows[5], "x") == (2.0, None, None)


def test_later_category_replaces_statistic_in_place(read):
    d = doc(1, statistics={"A": {"home": "1"}, "B": {"home": "2"}}, detailed_statistics={"attack": {"A": {"home": "3"}}})
    cleaned = clean_documents(read(d)).first()["stats"]
    assert [(s["name"], s["home"]["value"]) for s in cleaned] == [("A", 3.0), ("B", 2.0)]


def test_reserved_names_and_possession(read):
    docs = read(doc(1, statistics={"Score": {"home": "9"}, "55%": {"home": "Possession", "away": "45%"}}, detailed_statistics={}))
    row = silver_of(docs)[1]
    assert row["home_score"] == 2 and set(row["stats"]) == {"possession"}
    assert row["stats"]["possession"]["home"]["text"] == "Possession"
    assert row["stats"]["possession"]["away"]["value"] == 45.0
    assert reserved_stats(clean_documents(docs)).collect()[0].asDict() == {"match_id": 1, "stat_name": "Score", "stat": "score"}
    assert clean_documents(docs).first()["stats"][1]["raw_name"] == "55%"


def test_gold_sides(read):
    info = SAMPLE["match_info"]
    swapped = {**info, "home_team": "Team B", "away_team": "Team A", "home_score": 1, "away_score": 2}
    silver = jobs.bronze_to_silver(
        read(doc(1), doc(2, match_info=swapped), doc(3, match_info={**info, "away_team": "Team A"}),
             doc(4, match_info={**info, "home_team": "C"}), doc(5, match_info={**info, "home_team": None, "away_team": "Team A"}))
    )
    gold = {r["match_id"]: r for r in team_record(silver, ["Team A"], ["possession", "result"], with_opponent=True).collect()}
    assert set(gold) == {1, 2, 3, 5}
    assert (gold[1]["is_home"], gold[1]["opponent"], gold[1]["result"], gold[1]["possession"]) == (True, "Team B", "W", 55.0)
    assert (gold[2]["is_home"], gold[2]["result"], gold[2]["possession"], gold[2]["opp_possession"]) == (False, "W", 45.0, 55.0)
    assert gold[3]["is_home"] is True and gold[5]["is_home"] is False
    assert gold[1]["score"] == gold[1]["goals_scored"] == 2
    assert list(gold[1].asDict()).count("result") == 1


def test_all_teams_mirror_each_other(read):
    silver = jobs.bronze_to_silver(read(doc(1), doc(2, match_info={**SAMPLE["match_info"], "home_score": 1})))
    rows = jobs.silver_to_gold_all(silver).collect()
    by_match = {}
    for r in rows:
        by_match.setdefault(r["match_id"], []).append(r["result"])
    assert sorted(by_match[1]) == ["L", "W"] and by_match[2] == ["D", "D"]
    assert all_perspectives(silver).count() == 4


def test_stat_names(read):
    long = jobs.silver_long(read(SAMPLE))
    assert stat_names(long) == ["distance_covered", "passes_completed", "possession", "xg"]


def test_file_order_does_not_matter(spark, tmp_path):
    for name, ids in (("a", [1, 2, 3]), ("b", [3, 1, 2])):
        (tmp_path / name).mkdir()
        for i, m in enumerate(ids):
            (tmp_path / name / f"{i}.json").write_text(json.dumps(doc(m)))
    rows = [
        sorted(map(repr, jobs.silver_long(lake.read_documents(spark, str(tmp_path / n))).collect())) for n in ("a", "b")
    ]
    assert rows[0] == rows[1]


def test_silver_plan_has_no_shuffle(read):
    docs = read(SAMPLE)
    for df in (jobs.silver_long(docs), to_wide(jobs.bronze_to_silver(docs), ["xg"]),
               team_record(jobs.bronze_to_silver(docs), ["Team A"], ["xg"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert "lineups" not in plan.split("ReadSchema")[1]
