"""The registered queries of the subpackage, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroids,
    decontamination,
    exact_dedup,
    filter_audit,
    html_text,
    jaccard_join,
    language,
    licenses,
    line_dedup,
    packing,
    quotes,
    sharding,
    toxicity,
)
from .common import load

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign_shards(load(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(load(spark, sf_dir, "documents"), "doc_id", "text")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    return toxicity.toxicity_report(docs, labels, "doc_id", "text", "toxic")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(load(spark, sf_dir, "documents"), "doc_id", "text")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.held_out("doc_id")
    model = language.train(docs.where(~held), "doc_id", "text", "lang")
    rows = language.predict(docs.select("doc_id", "text"), "text", model)
    return rows.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(load(spark, sf_dir, "pages"), "page_id", "url", "html")


def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(load(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path())


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(load(spark, sf_dir, "documents"), "doc_id", "text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    return decontamination.contamination_report(docs, "doc_id", "text", items, "item_id", "text")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    return filter_audit.filter_audit(docs, labels, "doc_id", "text", "lang")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(load(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
