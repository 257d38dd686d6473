"""Sources and sinks on a folder of the test."""

import bz2
import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.operators.dedupe import keep_last
from touchline.sources import lake, objects, sinks
from touchline.sources.files import inflate_error, unreadable_files
from touchline.sources.seasons import work_list


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_layer_path():
    assert lake.layer_path("r", "bronze", "2025/26", 3, 7) == "r/bronze/2025-26/matchweek_03/match_7.json"
    assert lake.layer_path("r", "x", "2025/26", 3, ext="csv", stamp="t") == "r/bronze/2025-26/aggregates/mw03_t.csv"
    assert lake.layer_path("r", "gold", "2025/26", 0, 7, stamp="t") == "r/gold/2025-26/data/t.json"
    assert lake.layer_path("r", "silver", stamp="t") == "r/silver/misc/t.json"


def test_scan_layer(spark, tmp_path):
    root = str(tmp_path)
    for mw, match in ((1, 10), (1, 11), (12, 12)):
        put(tmp_path / f"bronze/2025-26/matchweek_{mw:02d}/match_{match}.json", json.dumps({"match_id": match}))
    put(tmp_path / "bronze/2025-26/matchweek_01/match_10.csv", "a\n1\n")
    put(tmp_path / "bronze/2025-26/aggregates/mw01_x.json", "[]")
    names = lambda df: sorted(r["path"].rsplit("/", 1)[1] for r in df.collect())
    assert names(lake.scan_layer(spark, root, "bronze", "2025/26", 1)) == ["match_10.json", "match_11.json"]
    assert len(names(lake.scan_layer(spark, root, "bronze", ["2025/26", "2024/25"]))) == 4
    assert names(lake.scan_layer(spark, root, "bronze", "2025/26", 1, "csv")) == ["match_10.csv"]
    assert names(lake.scan_layer(spark, root, "bronze", "1999/00")) == []
    assert names(lake.scan_folder(spark, root, "bronze", "2025/26", "aggregates", "json")) == ["mw01_x.json"]


def test_csv_tables_with_different_headers(spark, tmp_path):
    put(tmp_path / "mw01_a.csv", 'match_id,venue,home_x\n1,"a ""b"" c, d",2.0\n2,"two\nlines",\n')
    put(tmp_path / "mw02_b.csv", "home_x,match_id\nN/A,2\n7,3\n")
    put(tmp_path / "mw03_c.csv", "")
    rows = lake.read_csv_table(spark, str(tmp_path), {"match_id": "bigint", "home_x": "int"})
    got = {(r["match_id"], r["venue"], r["home_x"]) for r in rows.collect()}
    assert got == {(1, 'a "b" c, d', 2), (2, "two\nlines", None), (2, None, None), (3, None, 7)}
    last = {r["match_id"]: r["venue"] for r in keep_last(rows, ["match_id"], lake.SOURCE_ORDER).collect()}
    assert last == {1: 'a "b" c, d', 2: None, 3: None}
    with pytest.raises(ValueError):
        lake.read_csv_table(spark, str(tmp_path / "mw03_c.csv"))


def test_csv_headers_follow_the_grammar(spark, tmp_path):
    put(tmp_path / "a.csv", '\n\n"two\nlines",id\n007,1\n1e5,2,3\n')
    put(tmp_path / "b.csv", 'id\n"4"\n')
    rows = lake.read_csv_table(spark, str(tmp_path), {"id": "int"})
    assert {(r["id"], r["two\nlines"]) for r in rows.collect()} == {(1, "007"), (4, None)}
    rejects = lake.csv_rejects(spark, str(tmp_path)).collect()
    assert [r["fields"] for r in rejects] == [["1e5", "2", "3"]]


def test_csv_tables_of_many_layouts(spark, tmp_path):
    for i in range(620):
        put(tmp_path / f"t{i:03d}.csv", f"id,c{i}\n{i},x\n")
    rows = lake.read_csv_table(spark, str(tmp_path), {"id": "int"}).select("id", "c0", "c619")
    got = {r["id"]: (r["c0"], r["c619"]) for r in rows.collect()}
    assert len(got) == 620 and got[0] == ("x", None) and got[619] == (None, "x") and got[5] == (None, None)


def test_documents_in_any_layout(spark, tmp_path):
    put(tmp_path / "a.json", json.dumps({"match_id": 1, "season": "2025/26"}, indent=2))
    put(tmp_path / "b.json", json.dumps([{"match_id": 2}, {"match_id": 3}], indent=1))
    put(tmp_path / "c.json", "{broken")
    docs = lake.read_documents(spark, str(tmp_path))
    assert sorted(r["match_id"] for r in lake.accepted(docs).collect()) == [1, 2, 3]
    assert [r["source_file"].rsplit("/", 1)[1] for r in lake.rejects(docs).collect()] == ["c.json"]


def test_a_truncated_file_is_no_silent_loss(spark, tmp_path):
    import gzip

    whole = gzip.compress("\n".join(json.dumps({"match_id": i, "url": "u" * (i % 97)}) for i in range(3000)).encode())
    (tmp_path / "t.json.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        lake.read_documents(spark, str(tmp_path), multi_line=False).collect()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "x\ny", 1.5)], "i int, t string, v double")
    sinks.write_csv(df, str(tmp_path / "t"))
    back = lake.read_csv_table(spark, str(tmp_path / "t"), {"i": "int", "v": "double"}).select("i", "t", "v")
    assert sorted(back.collect()) == sorted(df.collect())


def test_layer_overwrites_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    row = lambda i, w, v: (i, "2025/26", w, v)
    schema = "match_id bigint, season string, matchweek int, v string"
    sinks.write_layer(spark.createDataFrame([row(1, 1, "a"), row(2, 2, "a")], schema), path)
    sinks.write_layer(spark.createDataFrame([row(1, 1, "b")], schema), path)
    got = {(r["match_id"], r["v"]) for r in lake.read_layer(spark, path).collect()}
    assert got == {(1, "b"), (2, "a")}
    pruned = lake.read_layer(spark, path, ["2025/26"], [2])
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "matchweek" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert lake.try_read_layer(spark, str(tmp_path / "none")) is None


def test_snapshots_skip_unfinished_runs(spark, tmp_path):
    path = str(tmp_path / "s")
    assert sinks.latest_snapshot(spark, path) is None
    assert sinks.read_state(spark, path).count() == 0
    sinks.write_snapshot(spark.range(1), path, "1")
    put(tmp_path / "s/run_id=2/part-0.parquet", "half")
    assert sinks.latest_snapshot(spark, path).endswith("run_id=1")


def test_work_list(spark):
    ids = work_list(spark, ["2025/26", "1999/00"], [2]).collect()
    assert sorted(r["match_id"] for r in ids) == list(range(2561905, 2561915))
    assert work_list(spark, ["2024/25", "2010/11"]).select("match_id").distinct().count() == 760


def test_keep_last_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, 3)], "k int, v int")
    last = keep_last(df, ["k"], ["v"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(last.collect(), key=repr) == sorted([(1, 2), (None, 3)], key=repr)


def test_one_truncated_file_among_a_hundred(spark, tmp_path):
    for i in range(100):
        packed = gzip.compress(json.dumps({"match_id": i, "season": "2025/26", "matchweek": 1, "url": "x" * 50 * i}).encode())
        (tmp_path / f"{i:03d}.json.gz").write_bytes(packed[:-20] if i == 42 else packed)
    with pytest.raises(Exception):
        lake.read_documents(spark, str(tmp_path)).collect()
    docs = lake.read_documents(spark, str(tmp_path), unreadable=unreadable_files(spark, str(tmp_path)))
    assert {r["match_id"] for r in lake.accepted(docs).collect()} == set(range(100)) - {42}
    left = lake.rejects(docs).collect()
    assert [r["source_file"].rsplit("/", 1)[1] for r in left] == ["042.json.gz"] and "ends too early" in left[0]["_corrupt_record"]


def test_inflate_error():
    text = b"some text " * 300_000
    whole = {"a.gz": gzip.compress(text) + gzip.compress(b"more") + b"\0" * 8, "a.bz2": bz2.compress(text) + bz2.compress(b"more"), "a.deflate": zlib.compress(text)}
    for path, content in whole.items():
        assert inflate_error(path, content) is None
        assert inflate_error(path, content[: len(content) // 3]) is not None
        assert inflate_error(path, b"no such thing") is not None
    broken = bytearray(whole["a.gz"])
    broken[40] ^= 255
    assert inflate_error("a.gz", bytes(broken)) is not None


def test_csv_rejects_are_whole_records(spark, tmp_path):
    put(tmp_path / "a.csv", 'a,b\n1,2\n1,2,,4\n1,2,\n3\n"x,""y",2\n"x,""y",2,"p,q\nr"\n,,,\n5,6\n')
    put(tmp_path / "b.csv", "a,b,c,d\n1,2,3,4\n1,2,3\n1,2,3,4,\n")
    rows = lake.read_csv_table(spark, str(tmp_path))
    assert {(r["a"], r["b"], r["c"], r["d"]) for r in rows.collect()} == {
        ("1", "2", None, None), ("3", None, None, None), ('x,"y', "2", None, None), ("5", "6", None, None), ("1", "2", "3", "4"), ("1", "2", "3", None),
    }
    fields = sorted(r["fields"] for r in lake.csv_rejects(spark, str(tmp_path)).collect())
    assert fields == sorted([["1", "2", "", "4"], ["1", "2", ""], ['x,"y', "2", "p,q\nr"], ["", "", "", ""], ["1", "2", "3", "4", ""]])


def test_objects_lie_at_their_paths(spark, tmp_path):
    root = str(tmp_path / "lake")
    docs = spark.createDataFrame([(i, "2025/26", 1 + i % 2, "é" if i else None) for i in range(5)], "match_id long, season string, matchweek int, name string")
    path = lake.layer_path_column("", "bronze", F.col("match_id"), F.col("season"), F.col("matchweek"))
    objects.write_objects(docs.repartition(3), root, path)
    objects.write_objects(docs.where("match_id = 3").withColumn("name", F.lit("later")), root, path)
    objects.write_arrays(docs, root, lake.bundle_path_column("bronze", F.col("season"), F.col("matchweek"), "t"), F.col("match_id"))
    one = json.loads((tmp_path / "lake/bronze/2025-26/matchweek_02/match_3.json").read_text())
    assert one == {"match_id": 3, "season": "2025/26", "matchweek": 2, "name": "later"}
    assert json.loads((tmp_path / "lake/bronze/2025-26/matchweek_01/match_0.json").read_text())["name"] is None
    weeks = {p.name: [d["match_id"] for d in json.loads(p.read_text())] for p in (tmp_path / "lake/bronze/2025-26/aggregates").iterdir()}
    assert weeks == {"mw01_t.json": [0, 2, 4], "mw02_t.json": [1, 3]}
    assert lake.scan_layer(spark, root, "bronze", "2025/26").count() == 7 and not (tmp_path / "lake" / objects.STAGING).exists()
    # a task that fails leaves nothing
    bad = docs.withColumn("at", F.when(F.col("match_id") == 4, "../../up.json").otherwise(F.concat(F.lit("new/"), "match_id")))
    with pytest.raises(Exception):
        objects.write_objects(bad.repartition(4, "match_id"), root, F.col("at"))
    assert not (tmp_path / "lake/new").exists() and not (tmp_path / "lake" / objects.STAGING).exists()


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    sc, path = spark.sparkContext, str(tmp_path / "parted")
    most = 4 * sc.defaultParallelism
    rows = spark.range(most + 40)
    rows.withColumn("part", F.col("id")).coalesce(1).write.partitionBy("part").parquet(path)
    sc.setJobGroup("listing", "folders of a table")
    table = spark.read.schema("id long, part long").parquet(path)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(tracker.getStageInfo(s).numTasks for s in stages) <= most
    assert table.count() == most + 40
