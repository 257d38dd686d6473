"""State in buckets, and row numbers of a hot key."""

import datetime as dt
import re

import pytest
from pyspark.sql import Window, functions as F

from touchline.operators import ranking, state as state_ops
from touchline.operators.extract import newest_captures
from touchline.schemas import RAW_PAGES, STATE
from touchline.sources import sinks


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled(plan):
    """What stands below each shuffle of the final plan."""
    final = plan.split("== Initial Plan ==")[0].split("\n")
    depth = lambda line: len(re.match(r"[ :+\-*(\d)]*", line)[0])
    out = []
    for i, line in enumerate(final):
        if "Exchange hashpartitioning" in line:
            below = [x for x in final[i + 1 :]]
            end = next((n for n, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            out.append("\n".join(below[:end]))
    return out


def states(spark, rows):
    return spark.createDataFrame([(i, s, dt.datetime(2025, 8, d)) for i, s, d in rows], STATE)


def test_state_stays_in_its_buckets(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "state")
    first = states(spark, [(i, "PLAYED" if i % 3 else "SCHEDULED", 1) for i in range(500)])
    sinks.write_state(state_ops.upsert_state(sinks.read_state(spark, path), first), path, "1")
    state = sinks.read_state(spark, path)
    work = spark.range(400, 600).withColumnRenamed("id", "match_id")
    open_ = state_ops.skip_played(work, state)
    plan = executed(open_)
    assert "Bucketed: true" in plan and not [x for x in shuffled(plan) if "touchline_state_" in x]
    assert [x for x in shuffled(plan) if "Range" in x]
    assert {r[0] for r in open_.collect()} == {i for i in range(400, 600) if i >= 500 or i % 3 == 0}

    new = states(spark, [(3, "PLAYED", 2), (3, "SCHEDULED", 3), (900, "PLAYED", 2), (None, "PLAYED", 2)])
    upserted = state_ops.upsert_state(state, new)
    plan = executed(upserted)
    assert "Bucketed: true" in plan and not [x for x in shuffled(plan) if "touchline_state_" in x]
    sinks.write_state(upserted, path, "2")
    after = {r["match_id"]: (r["status"], r["last_updated"].day) for r in sinks.read_state(spark, path).collect()}
    want = {i: ("PLAYED" if i % 3 else "SCHEDULED", 1) for i in range(500)} | {3: ("SCHEDULED", 3), 900: ("PLAYED", 2)}
    assert after == want
    # one file per bucket, so that buckets are read in order
    assert len(list((tmp_path / "state/run_id=2").glob("part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len({r["match_id"] for r in spark.read.parquet(f"{path}/run_id=1").collect()}) == 500


def test_state_of_plain_files_is_read(spark, tmp_path):
    states(spark, [(1, "PLAYED", 1)]).write.parquet(f"{tmp_path}/run_id=1")
    assert [r["match_id"] for r in sinks.read_state(spark, str(tmp_path)).collect()] == [1]


def test_row_numbers_of_a_hot_key(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 2 else f"k{i % 50}", (i * 7919) % 5000, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "key string, at int, id int")
    window = Window.partitionBy("key").orderBy(F.desc("at"), "id")
    want = df.withColumn("rn", F.row_number().over(window).cast("bigint"))
    order = [F.desc("at"), F.col("id")]
    got = ranking.numbered(df, ["key"], order, parts=8)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.schema["rn"].dataType == want.schema["rn"].dataType
    parts = ranking.ranged_rows(df, ["key"], order, 8)
    most = parts.groupBy("_part").count().agg(F.max("count")).first()[0]
    hot = parts.where("key = 'hot'").select("_part").distinct().count()
    assert hot >= 3 and most < 2 * 5000 / 8
    assert ranking.numbered(df.where("id < 0"), ["key"], order).count() == 0


def test_newest_captures(spark):
    at = lambda d: None if d is None else dt.datetime(2025, 8, d)
    rows = [(1, "stats", "a", "", at(1)), (1, "stats", "b", "", at(2)), (1, "stats", "c", "", at(2)), (1, "main", "d", "", None), (2, "main", "e", "", None),
            (2, "main", "f", "", at(1)), (None, "main", "g", "", at(1)), (3, None, "h", "", at(1)), (3, None, "i", "", at(2))]
    kept = newest_captures(spark.createDataFrame(rows, RAW_PAGES))
    assert sorted(r["html"] for r in kept.collect()) == ["b", "c", "d", "f", "g", "i"]
