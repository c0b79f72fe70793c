"""Data-quality checks: all rules of all datasets in one aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.schema import (
    HIGH_IMBALANCE_RATIO,
    LABEL,
    MIN_TEXT_LENGTH,
    TEXT,
    VALID_LABELS,
)

MEASURES = ["rows", "null_text", "null_label", "invalid_labels", "label_0", "label_1",
            "short_rows"]


def _measure(df: DataFrame, min_length: int) -> DataFrame:
    label, text = F.col(LABEL), F.col(TEXT)
    return df.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(text.isNull()).alias("null_text"),
        F.count_if(label.isNull()).alias("null_label"),
        F.count_if(~label.isin(VALID_LABELS)).alias("invalid_labels"),
        F.count_if(label == 0).alias("label_0"),
        F.count_if(label == 1).alias("label_1"),
        F.count_if(F.length(text) < min_length).alias("short_rows"),
    )


def _judge(measures: DataFrame, missing_columns: list[str]) -> DataFrame:
    reason = (
        F.when(F.col("rows") == 0, "empty")
        .when(F.col("dataset").isin(missing_columns), "missing_columns")
        .when((F.col("null_text") > 0) | (F.col("null_label") > 0), "nulls")
        .when(F.col("invalid_labels") > 0, "invalid_labels")
        .when((F.col("label_0") == 0) | (F.col("label_1") == 0), "missing_class")
        .when(F.col("short_rows") > 0, "short_rows")
    )
    ratio = F.try_divide(F.greatest("label_0", "label_1"), F.least("label_0", "label_1"))
    passed = F.col("reason").isNull()
    return (
        measures.withColumn("reason", reason)
        .withColumn("passed", passed)
        .withColumn("imbalance_warning", passed & (ratio > HIGH_IMBALANCE_RATIO))
    )


def validate_tagged(df: DataFrame, names: list[str],
                    min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """Verdict per dataset for a table with a ``dataset`` column. A name without rows is an
    empty dataset. The first failing rule gives the reason."""
    expected = df.sparkSession.createDataFrame([(n,) for n in names], "dataset string")
    measures = F.broadcast(expected).join(_measure(df, min_length), "dataset", "left").fillna(0)
    return _judge(measures, [])


def validate_datasets(
    datasets: dict[str, DataFrame], min_length: int = MIN_TEXT_LENGTH
) -> DataFrame:
    """Verdict per named table."""
    frames, missing = [], []
    for name, df in datasets.items():
        if {TEXT, LABEL} <= set(df.columns):
            frame = df.select(TEXT, F.col(LABEL).cast("bigint").alias(LABEL))
        else:
            missing.append(name)
            frame = df.select(
                F.lit(None).cast("string").alias(TEXT), F.lit(None).cast("bigint").alias(LABEL)
            )
        frames.append(frame.withColumn("dataset", F.lit(name)))
    tagged = reduce(DataFrame.unionByName, frames)
    checked = validate_tagged(tagged, list(datasets), min_length).select("dataset", *MEASURES)
    return _judge(checked, missing)


def all_passed(verdicts: DataFrame) -> bool:
    """True when no dataset failed."""
    return verdicts.where(~F.col("passed")).isEmpty()
