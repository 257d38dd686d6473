"""The stages of the corpus pipeline, each against what it has to keep."""

import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from touchline.llm import langid, ngram_join, toxicity
from touchline.llm.common import held_out, stored, table

SF = "/root/testdata/sf0.001"
P = pytest.importorskip("public_tokenizers")


def test_registered():
    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "language", "near_copies", "pii", "packing"]


def test_held_out(spark):
    rows = spark.range(300).select("id", held_out("id").alias("held")).collect()
    assert all(r["held"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_stages(spark):
    docs = table(spark, SF, "documents")
    for n, (name, stage) in enumerate(pipeline.STAGES):
        before = docs
        docs = stored(stage(spark, before, SF), f"test_{name}")
        if n < 4:
            assert docs.columns == before.columns and dict(docs.dtypes) == dict(before.dtypes)
        ids = {r["doc_id"] for r in docs.collect()}
        old = {r["doc_id"] for r in before.collect()}
        if name == "toxicity":
            model = toxicity.train(before, table(spark, SF, "labels"))
            kept = toxicity.score_toxicity(before, model).where("score < 0.3")
            assert ids == {r["doc_id"] for r in kept.collect()}
        elif name == "language":
            found = langid.identify_languages(before, langid.learn_languages(before))
            assert ids == {r["doc_id"] for r in found.where("lang_pred != 'und'").collect()}
        elif name == "near_copies":
            groups = ngram_join.jaccard_join(before)
            assert ids == {r["doc_id"] for r in groups.where("doc_id = component_id").collect()}
            assert len(ids) < len(old) and docs.count() == len(ids)
        else:
            assert ids == old
            if name == "pii":
                assert docs.where("n_chars != length(text)").count() == 0
                assert docs.where(F.col("text").rlike(r"[0-9]+@[a-z0-9]+\.example\.com")).count() == 0


def test_awkward_rows_and_clashing_columns(spark, odd, none, tmp_path):
    spark.createDataFrame([(5, 1), (None, None)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (odd, none):
        docs = stored(start, "awkward")
        for n, (name, stage) in enumerate(pipeline.STAGES):
            docs = stored(stage(spark, docs, str(tmp_path)), f"awkward_{name}")
            if n < 4:
                assert docs.columns == odd.columns
        if start is odd:
            # 9 once although it came twice, 6 is a copy of 5
            ids = {r["doc_id"] for r in docs.collect()}
            assert 9 in ids and not {6, 1, 2, 3} & ids
        else:
            assert docs.count() == 0
