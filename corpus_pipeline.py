"""The training-data pipeline: stages over documents, each written and read again.

1. ``language``: documents whose language isn't recognised go.
2. ``near_duplicates``: one document of each group of near duplicates stays.
3. ``decontaminate``: documents that hold a phrase of the benchmark go.
4. ``secrets``: secrets are replaced by a mark in the text; no document goes.
5. ``mix``: documents are drawn, some more than once, so that the expected tokens meet the
   targets by source, language and topic; ``copy`` numbers a document's copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.llm import fm_index, jaccard_join, language_id, mixing, secrets
from labeltext.llm.shared import stored

# Below this mean probability of its best language a document is rejected.
LEAST_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, model, LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fm_index.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw(docs, mixing.Targets())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", redact_secrets),
    ("mix", mix),
]

# The language model isn't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
