"""The corpus pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from touchline.llm import langid, ngram_join, packing, pii, toxicity
from touchline.llm.common import stored, table
from touchline.llm.queries import TOXIC_FROM


def _set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The documents with every column no operator reads renamed, so that none
    clashes with what operators add; and the way back to the own columns."""
    names = {c: c if c in ("doc_id", "text", "lang") else f"own_{n}" for n, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(f"`{c}`").alias(new) for c, new in names.items()))
    return renamed, lambda rows: rows.select(*(F.col(new).alias(c) for c, new in names.items()))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model does not reject."""
    rows, back = _set_aside(docs)
    model = toxicity.train(rows, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(rows, model, keep=rows.columns)
    return back(scored.where(F.col("score") < TOXIC_FROM))


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; a text without letters goes,
    and without anything to learn from, every text stays that has a letter."""
    rows, back = _set_aside(docs)
    samples = langid.learn_languages(rows) or [("any", "")]
    found = langid.identify_languages(rows, samples, keep=rows.columns)
    return back(found.where(F.col("lang_pred") != langid.UNDETERMINED))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id, and of
    an id that occurs more than once, one row. Rows without an id stay."""
    rows, back = _set_aside(docs)
    groups = ngram_join.jaccard_join(rows)
    kept = stored(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept_ids")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64(*rows.columns))
    one = rows.join(kept, "doc_id", "left_semi").withColumn("place", F.row_number().over(first))
    one = one.where("place = 1").select(*rows.columns)
    return back(one.unionByName(rows.where("doc_id is null")))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked, and their new length."""
    masked = pii.mask_pii(docs, pii.train_tagger(docs))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", not_toxic),
    ("language", in_a_language),
    ("near_copies", without_near_copies),
    ("pii", without_pii),
    ("packing", packed),
]

#: Trained models decide in the stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
