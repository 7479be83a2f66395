"""A training corpus from the documents table: stages that each take what the last one kept.

Every stage is written as Parquet and read again, so a lost executor costs a part of one stage at most. All stages but
the last return the columns of `documents`. Every stage handles null and empty texts and an empty table as its operator
says; documents without a letter leave in the first one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyed_lake.llm import decontamination, exact_dedup, jaccard_join, language, packing
from keyed_lake.llm.common import col, fresh, load, written
from keyed_lake.llm.queries import tokenizer_path

#: Chunks whose ids a worker of the last stage keeps: it shares its executor with what the stages before have left in the JVM.
CACHED = 400_000
NEAR = jaccard_join.Similarity(words=5, num=80, den=100)


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the model learns from the labelled ones that aren't held out."""
    model = language.train(docs.where(~language.held_out("doc_id")), "doc_id", "text", "lang")
    name, score = fresh("lang_pred", docs.columns), fresh("score", docs.columns)
    rows = language.predict(docs, "text", model, name, score)
    return rows.where(col(name) != language.UNKNOWN).select(*[col(c) for c in docs.columns])


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs, "doc_id", "text")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_similar(docs, "doc_id", "text", NEAR)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, "text", load(spark, sf_dir, "benchmark"), "item_id", "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, "doc_id", "text", tokenizer_path(), cached=CACHED)


STAGES = [
    ("language", recognised),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]
#: Language, edit distance and packing have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
