"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.llm import (
    fm_index,
    jaccard_join,
    language_id,
    main_text,
    mixing,
    phrases,
    pii,
    prefix_trie,
    secrets,
    suffix_trees,
    token_files,
    top_k,
    warc_bundles,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and draw of every document."""
    rows = mixing.weigh(table(spark, sf_dir, "documents"), mixing.Targets())
    return rows.select(
        "doc_id", "source_group", "lang_group", "topic", "n_tokens",
        F.round("weight", 6).alias("weight"),
        F.round("keep_probability", 6).alias("keep_probability"), "sampled",
    )


@query
def op2_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_trees.drop_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query
def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fm_index.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return rows.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@query
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


@query
def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc_bundles.archive(table(spark, sf_dir, "pages"))
    return rows.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from the archive."""
    folder = token_files.write_archive(
        table(spark, sf_dir, "documents"), token_files.vocabulary()
    )
    return token_files.read_archive(spark, folder)


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
