"""The labelled corpus, joined from a text table and a label table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.schema import KEY, LABEL, SOURCE, TEXT


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def labelled(
    documents: DataFrame,
    labels: DataFrame,
    columns: dict[str, Column] | None = None,
    label: str = "toxic",
) -> DataFrame:
    """Key, ``columns`` of the documents, and label.

    ``columns`` are computed before the join: asking for a length or a digest only, no text
    is shuffled. Default: the text and its source."""
    if columns is None:
        columns = {TEXT: F.col("text"), SOURCE: F.col("source")}
    left = documents.select(
        F.col("doc_id").alias(KEY), *[c.alias(name) for name, c in columns.items()]
    )
    right = labels.select(F.col("doc_id").alias(KEY), F.col(label).cast("bigint").alias(LABEL))
    return left.join(right, KEY)


def corpus(
    spark: SparkSession, folder: str, columns: dict[str, Column] | None = None
) -> DataFrame:
    return labelled(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), columns
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Key to source for every document."""
    return read_table(spark, folder, "documents").select(F.col("doc_id").alias(KEY), SOURCE)
