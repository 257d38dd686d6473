"""The operators as queries over whole tables, with the columns agreed on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.llm import (
    ann_codes, bpe, conversation_repair, hard_negatives, langid, license_scan, line_dedup, ngram_join, oracles, packing, pii,
    secret_scan, topk_exact, toxicity,
)
from touchline.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOXIC_FROM = 0.3


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def digest(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and its component."""
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    return scores.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


@query
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every query vector."""
    return topk_exact.exact_top_k(table(spark, sf_dir, "embeddings"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.train_tagger(docs))
    return found.select(
        "doc_id",
        *(count_kind("base", k).alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(digest("base"), 256).alias("base_sha256"),
        digest("spans").alias("spans"),
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False).drop("ids")


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its license phrases and labels."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    starts, base = F.col("places.start"), F.array_distinct("places.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "found")), ",").alias("labels"),
        "score",
    )


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its secrets, also those under nested encodings."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(count_kind("base", k).alias(f"n_{k}") for k in secret_scan.KINDS),
        F.sha2(digest("base"), 256).alias("base_sha256"),
        digest("spans").alias("spans"),
    )


@query
def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every query vector."""
    return ann_codes.approximate_top_k(table(spark, sf_dir, "embeddings"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its predicted language."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify_languages(docs, langid.learn_languages(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation with its faults and its cheapest repair."""
    rows = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.audit_conversations(rows, there=F.col("there")).drop("n_rows")


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines an earlier document has."""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    relabelled = rows.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.hard_negatives(relabelled)


ORACLES |= {
    "op1_ngram_join": oracles.NGRAM_JOIN,
    "op3_topk": oracles.EXACT_TOP_K,
    "op6_licenses": oracles.LICENSES,
    "op12_line_dedup": oracles.LINE_DEDUP,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
