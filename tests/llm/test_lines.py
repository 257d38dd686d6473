"""Line dedup against a plain version."""

import random

import pytest

from touchline.llm import line_dedup


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain(rows):
    """(id, text) -> sorted (id, lines, dropped, kept)."""
    place = lambda i: (i is None, i or 0)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                holders.setdefault(key_of(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < 10 or min(holders[key_of(x)], key=place) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=repr)


def texts(seed, n):
    pick = random.Random(seed)
    lines = ["", " ", "short", "ÄÖÜ bleibt GROSS", "A shared line", " a shared LINE\t", "Another line, shared", "x" * 9, "X" * 10, "x" * 10, "x" * 5000]
    return [(i, "\n".join(pick.choice([*lines, f"own line of {i}"]) for _ in range(pick.randint(0, 9)))) for i in range(n)]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (6, 3)])
def test_lines(spark, batches, fanout):
    rows = texts(batches, 60) + [(7, "A shared line\nonce more"), (None, "A shared line\nno id at all"), (None, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(line_dedup.dedup_lines(df, batches=batches, fanout=fanout)) == plain(rows)


def test_key_of_most_documents(spark):
    rows = [(i, f"the line of all of them\nown line of {i}\nTHE LINE of all of them") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(line_dedup.dedup_lines(df, batches=2)) == plain(rows)


def test_odd_rows(spark, odd, odd_rows, none):
    assert rows_of(line_dedup.dedup_lines(odd)) == plain(odd_rows)
    assert line_dedup.dedup_lines(none).collect() == []


def test_kept_columns_of_the_same_name(spark, odd):
    named = odd.withColumn("n_lines", odd["score"]).withColumn("gone", odd["score"]).withColumn("h1", odd["score"])
    out = line_dedup.dedup_lines(named, keep=["doc_id", "text", "n_lines", "gone", "h1", "key"])
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept", "in_doc_id", "text", "in_n_lines", "gone", "h1", "key"]
    assert {r["in_n_lines"] for r in out.collect()} == {"s"}


def test_runs_are_merged_level_by_level(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for n in range(6):
        docs = spark.createDataFrame([(n, f"line number {n} of all\nthe line of every batch")], "doc_id long, text string")
        runs.add(line_dedup.hashed_lines(docs, 10), str(tmp_path / str(n)))
        assert spark.read.parquet(str(tmp_path / str(n))).count() == (n > 0)
    assert [len(level) for level in runs.levels] == [2, 0, 1]
    assert sum(r.count() for r in runs.runs()) == 7
    runs.close()
    assert runs.runs() == [] and not spark.catalog.listTables()
    with pytest.raises(ValueError):
        line_dedup.LineRuns(spark, fanout=1)
