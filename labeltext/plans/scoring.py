"""Screen, score and describe messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.functions.scoring import (
    confidence_text,
    display_name,
    finite,
    label_name,
    reject_reason,
)
from labeltext.functions.text import clean_text
from labeltext.operators.classifiers import FittedModels, predictions
from labeltext.schema import TEXT, require_columns

# Fixed value: what precedes the model's name in the version reported when none is given.
VERSION_PREFIX = "phase2_"


def screen(messages: DataFrame, text: str = "text") -> DataFrame:
    """Add ``reject_reason`` (null: accepted) and the cleaned text, null if rejected."""
    require_columns(messages, [text])
    # The one-row array keeps the text from being cleaned once per use.
    cleaned = F.inline(F.array(F.struct(clean_text(F.col(text)).alias("_clean"))))
    return (
        messages.select("*", cleaned)
        .withColumn("reject_reason", reject_reason(F.col(text), F.col("_clean")))
        .withColumn(TEXT, F.when(F.col("reject_reason").isNull(), F.col("_clean")))
        .drop("_clean")
    )


def respond(
    accepted: DataFrame,
    models: FittedModels,
    key: str,
    model_version: str | None = None,
) -> DataFrame:
    """The response columns for screened messages, one row per message and model."""
    with_length = accepted.withColumn("normalized_text_length", F.length(TEXT).cast("bigint"))
    scored = predictions(with_length, models, key, keep=["normalized_text_length"])
    score = finite(F.col("score"))
    version = F.concat(F.lit(VERSION_PREFIX), "model") if model_version is None else F.lit(model_version)
    return scored.select(
        key,
        "model",
        label_name(F.col("prediction")).alias("label"),
        "prediction",
        (F.col("prediction") == 1).alias("is_phishing"),
        score.alias("score"),
        "score_type",
        version.alias("model_version"),
        "normalized_text_length",
        display_name(F.col("prediction")).alias("verdict"),
        confidence_text(score, F.col("score_type")).alias("confidence"),
    )


def score_table(df: DataFrame, models: FittedModels, key: str, text: str = TEXT) -> DataFrame:
    """Batch scoring: all input columns plus model, prediction, score, score_type. The text
    is taken as it is."""
    require_columns(df, [text])
    others = [c for c in df.columns if c not in (key, text)]
    return predictions(df, models, key, text, keep=[text, *others])
