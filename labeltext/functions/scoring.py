"""Expressions around a score: screening, verdict columns, confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labeltext.schema import MAX_REQUEST_LENGTH, MIN_TEXT_LENGTH

# Names that appear in results.
LABEL_NAMES = {0: "legitimate", 1: "phishing"}
DISPLAY_NAMES = {0: "Legitimate", 1: "Phishing"}
PROBABILITY = "probability"
MARGIN = "decision_function"


def reject_reason(
    raw: Column,
    cleaned: Column,
    min_length: int = MIN_TEXT_LENGTH,
    max_length: int = MAX_REQUEST_LENGTH,
) -> Column:
    """Why a request text cannot be scored; null when it can. The clean text is empty exactly
    for a blank one."""
    return (
        F.when(raw.isNull(), "missing")
        .when(F.length(raw) < 1, "empty")
        .when(F.length(raw) > max_length, "too_long")
        .when(F.length(cleaned) == 0, "blank")
        .when(F.length(cleaned) < min_length, "too_short")
    )


def label_name(prediction: Column) -> Column:
    return (
        F.when(prediction == 0, LABEL_NAMES[0])
        .when(prediction == 1, LABEL_NAMES[1])
        .otherwise(prediction.cast("string"))
    )


def display_name(prediction: Column) -> Column:
    return (
        F.when(prediction == 1, DISPLAY_NAMES[1])
        .when(prediction == 0, DISPLAY_NAMES[0])
        .otherwise("Unknown")
    )


def finite(score: Column) -> Column:
    """The score, or null for NaN and the infinities."""
    bad = F.isnan(score) | (F.abs(score) == F.lit(float("inf")))
    return F.when(~bad, score)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def confidence_percent(score: Column, score_type: Column) -> Column:
    """Score as a percentage in [0, 100]: probabilities in [0, 1] are scaled, margins pass
    through the logistic function of their size."""
    kind = F.lower(F.coalesce(score_type, F.lit("")))
    direct = kind.contains("probability") | kind.contains("confidence")
    percent = (
        F.when(direct & score.between(0, 1), score * 100.0)
        .when(direct, score)
        .otherwise(100.0 * sigmoid(F.abs(score)))
    )
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), percent))


def confidence_text(score: Column, score_type: Column) -> Column:
    # Half to even first: Java's format would round halves up.
    text = F.format_string("%.1f%%", F.bround(confidence_percent(score, score_type), 1))
    return F.when(score.isNull(), "N/A").otherwise(text)
