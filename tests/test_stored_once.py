"""Queries over tables of their own: what is made once is stored once, and small."""

import datetime as dt
import os

import pytest

from touchline.sources import lake, sinks
from touchline.workload import QUERIES

ORDERS = 40


@pytest.fixture
def tables(spark, tmp_path):
    """Orders of two customers, the last order without a line item."""
    day = lambda i: dt.datetime(1996, 1, 1) + dt.timedelta(days=i)
    made = {
        "orders": ([(i, i % 2, "PFO"[i % 3], day(9 * i), "1-URGENT") for i in range(ORDERS)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(0, 3, "MACHINERY"), (1, 4, "FURNITURE")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(3, "NATION_3"), (4, "NATION_4")], "n_nationkey int, n_name string"),
        "lineitem": ([(i, n, 1, float(i + n), 0.05, 0.02, "A", "O") for i in range(ORDERS - 1) for n in range(1, 8)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_masters_read_stored_silver(spark, tables):
    df = QUERIES["m3_global_masters"](spark, tables)
    assert "lineitem" not in df._jdf.queryExecution().optimizedPlan().toString()
    rows = df.collect()
    silver = [r for r in rows if r["master"] == "silver"]
    assert sorted(r["match_id"] for r in silver) == list(range(ORDERS)) and all(r["referee"] == "1-URGENT" for r in silver)
    assert {r["team"] for r in rows if r["master"] == "gold"} == {"NATION_3", "NATION_4"}


def test_formats_may_be_packed(spark, tmp_path):
    stats = {f"Stat {n}": '{"home": "1", "away": "2"}' for n in range(30)}
    docs = spark.createDataFrame([(i, {"home_team": "A", "away_team": "B"}, stats) for i in range(300)],
                                 "match_id long, match_info map<string,string>, statistics map<string,string>")
    sizes = []
    for kind in ("none", "gzip"):
        made = sinks.write_formats(docs, f"{tmp_path}/{kind}", ("json", "csv"), kind)
        rows = lake.read_csv_table(spark, made["csv"], {"match_id": "bigint"})
        assert rows.count() == 9000 == sinks.long_rows(lake.read_documents(spark, made["json"], multi_line=False)).count()
        sizes.append(sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(f"{tmp_path}/{kind}") for f in names))
    assert sizes[1] < sizes[0] / 5


def test_formats_are_compared_in_one_shuffle(spark, tables):
    df = QUERIES["k7_write_multi_format"](spark, tables)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") <= 1
    assert df.count() == 7 * ORDERS


def test_reserved_statistics_are_told_from_stored_silver(spark, tmp_path):
    from touchline.plans import medallion as jobs

    for i, home in ((1, "9"), (2, None)):
        stats = '{"Score": {"home": "%s"}, "Shots": {"home": "3"}}' % home if home else "{}"
        (tmp_path / f"{i}.json").write_text('{"match_id": %d, "season": "2025/26", "matchweek": 1, "match_info": {}, "statistics": %s}' % (i, stats))
    root = str(tmp_path / "lake")
    jobs.run_medallion(spark, root, None, None, documents=lake.read_documents(spark, str(tmp_path)), all_teams=True, stamp="1")
    assert "reserved" in spark.read.parquet(f"{root}/delta/silver/run_id=1").columns
    assert [tuple(r) for r in spark.read.parquet(f"{root}/reserved_stats/run_id=1").collect()] == [(1, "Score", "score")]
    assert "reserved" not in spark.read.parquet(f"{root}/silver").columns


def test_newest_captures_leave_stored_pages_where_they_lie(spark, tmp_path):
    from touchline.operators.extract import newest_captures
    from touchline.schemas import RAW_PAGES

    at = lambda day: day and dt.datetime(2025, 1, day)
    rows = [(m, tab, f"{m}{tab}{day}{n}", "", at(day)) for m in [*range(700), None] for tab in ("main", None) for day in (1, 2, 3) for n in (0, 1) if day < 3 or m != 5]
    rows += [(9999, "main", "no time", "", None), (9998, "main", "some time", "", at(1)), (9998, "main", "none", "", None)]
    spark.createDataFrame(rows, RAW_PAGES).repartition(3).write.parquet(f"{tmp_path}/p")
    pages = spark.read.schema(RAW_PAGES).parquet(f"{tmp_path}/p")
    kept = newest_captures(pages, stored=True)
    assert sorted(map(str, kept.collect())) == sorted(map(str, newest_captures(pages).collect()))
    assert kept.columns == pages.columns and kept.where("html like '57%' or match_id = 5").count() > 0
    # the pages are joined as they are read, with the bitmaps
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.index("BroadcastHashJoin") < plan.index("bitmap_construct_agg")


def test_bitmaps_reach_over_blocks_of_a_file(spark, tmp_path):
    from touchline.operators.extract import newest_captures

    day = lambda c: f"timestamp '2025-01-01' + make_interval(0, 0, 0, {c})"
    rows = spark.range(0, 100_000, 1, 1).selectExpr("id % 40000 as match_id", "'main' as tab", "string(id) as html", "'' as visible_text", f"{day('int(id div 40000)')} as fetched_at")
    rows.write.parquet(f"{tmp_path}/p")
    kept = newest_captures(spark.read.schema(rows.schema).parquet(f"{tmp_path}/p"), stored=True)
    assert {int(r[0]) for r in kept.select("html").collect()} == set(range(60_000, 100_000))


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    spark.range(0, 600, 1, 300).write.parquet(f"{tmp_path}/small")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        tasks = spark.read.schema("id long").parquet(f"{tmp_path}/small").rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tasks <= 4 * spark.sparkContext.defaultParallelism


def test_a_smaller_cost_of_opening_stays(spark):
    from touchline import configure

    name = "spark.sql.files.openCostInBytes"
    for given, kept in (("1k", 1024), (str(2**30), 65536), ("4MB", 65536)):
        spark.conf.set(name, given)
        assert int(configure(spark).conf.get(name)) == kept
