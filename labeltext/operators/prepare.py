"""Cleaning, deduplication, and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labeltext.functions.text import clean_text, normalize_label
from labeltext.schema import (
    KEY,
    LABEL,
    MIN_TEXT_LENGTH,
    TEXT,
    VALID_LABELS,
    require_columns,
)


# The column that stands for the clean text where a table carries no text.
DIGEST = "_digest"


def _digest(text: Column) -> Column:
    """Stands for the text in grouping, so that no text is shuffled to find copies."""
    return F.sha2(text, 256)


def text_digest(text: Column, min_length: int = MIN_TEXT_LENGTH) -> Column:
    """Digest of the clean text, null if that is too short: all that deciding which rows stay
    needs of a text. Taken where the texts are read, before any join, no text is shuffled."""
    # As a lambda's argument the text is cleaned once.
    return F.transform(
        F.array(clean_text(text)), lambda t: F.when(F.length(t) >= min_length, _digest(t))
    )[0]


def _label_of(df: DataFrame, label: str) -> Column:
    """Normalised label; integer columns need no parsing."""
    if isinstance(df.schema[label].dataType, T.IntegralType):
        return F.when(F.col(label).isin(VALID_LABELS), F.col(label).cast("bigint"))
    return normalize_label(F.col(label))


def cleaned_rows(
    df: DataFrame,
    text: str = TEXT,
    label: str = LABEL,
    keep: list[str] | None = None,
    lowercase: bool = True,
    normalize_whitespace: bool = True,
    min_length: int = MIN_TEXT_LENGTH,
) -> DataFrame:
    """Canonical columns with clean text and label; rows without a usable label or with too
    short a text are dropped, copies stay."""
    require_columns(df, [text, label])
    clean = clean_text(F.col(text), lowercase, normalize_whitespace).alias(TEXT)
    # Going through a one-row array keeps the filters above the cleaning. Pushed below, they
    # would clean every text a second time, and before the join with the labels.
    return (
        df.select(
            *(keep or []),
            F.inline(F.array(F.struct(clean, _label_of(df, label).alias(LABEL)))),
        )
        .where(F.col(LABEL).isNotNull())
        .where(F.length(TEXT) >= min_length)
    )


def digested_rows(df: DataFrame, label: str = LABEL, keep: list[str] | None = None) -> DataFrame:
    """``cleaned_rows`` for a table that has a ``DIGEST`` instead of texts."""
    # Through a one-row array, as in ``cleaned_rows``: digests are made once, not for the filter too.
    both = F.inline(F.array(F.struct(DIGEST, _label_of(df, label).alias(LABEL))))
    rows = df.select(*(keep or []), both)
    return rows.where(F.col(LABEL).isNotNull() & F.col(DIGEST).isNotNull())


def distinct_keys(rows: DataFrame, key: str = KEY) -> DataFrame:
    """(key, label) of one row per (text, label), the one with the smallest key. ``rows`` have
    a ``DIGEST`` or the clean text.

    Only digests are grouped: each map task sends one short row per distinct text, however
    often it occurs, and no text is shuffled."""
    digest = F.col(DIGEST) if DIGEST in rows.columns else _digest(F.col(TEXT)).alias(DIGEST)
    return (
        rows.select(key, LABEL, digest)
        .groupBy(DIGEST, LABEL)
        .agg(F.min(key).alias(key))
        .select(key, LABEL)
    )


def drop_copies(rows: DataFrame, key: str | None = KEY) -> DataFrame:
    """One row per (text, label). With a key the survivors are picked by key, and a table
    already partitioned by that key moves no text at all. Without a key there is no order to
    respect and Spark's own deduplication does."""
    if key is None:
        return rows.dropDuplicates([TEXT, LABEL])
    return rows.join(distinct_keys(rows, key).select(key), key, "left_semi")


def clean_dataset(
    df: DataFrame,
    text: str = TEXT,
    label: str = LABEL,
    key: str | None = KEY,
    keep: list[str] | None = None,
    lowercase: bool = True,
    normalize_whitespace: bool = True,
    min_length: int = MIN_TEXT_LENGTH,
    drop_duplicates: bool = True,
) -> DataFrame:
    """The model-ready table: (key,) text_combined, label."""
    carried = ([key] if key else []) + [c for c in keep or [] if c != key]
    rows = cleaned_rows(
        df, text, label, carried, lowercase, normalize_whitespace, min_length
    )
    return drop_copies(rows, key) if drop_duplicates else rows


def cleaning_summary(
    df: DataFrame,
    text: str = TEXT,
    label: str = LABEL,
    min_length: int = MIN_TEXT_LENGTH,
    drop_duplicates: bool = True,
) -> DataFrame:
    """One row: raw, cleaned and removed rows and label counts of the cleaned table, from
    one pass over digests: those of a ``DIGEST`` column, if there is one, made with its own
    ``min_length``."""
    if DIGEST in df.columns:
        digest = F.col(DIGEST)
        require_columns(df, [label])
    else:
        require_columns(df, [text, label])
        digest = text_digest(F.col(text), min_length)
    flags = df.select(digest.alias("digest"), _label_of(df, label).alias("label")).select(
        F.when(
            F.col("label").isNotNull() & F.col("digest").isNotNull(), F.struct("digest", "label")
        ).alias("_kept")
    )
    groups = flags.groupBy("_kept").agg(F.count(F.lit(1)).alias("_rows"))
    counted = F.lit(1) if drop_duplicates else F.col("_rows")

    def kept(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, counted)), F.lit(0)).cast("bigint")

    return (
        groups.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("raw_rows"),
            kept(F.col("_kept").isNotNull()).alias("cleaned_rows"),
            kept(F.col("_kept.label") == 0).alias("label_0"),
            kept(F.col("_kept.label") == 1).alias("label_1"),
        )
        .withColumn("rows_removed", F.col("raw_rows") - F.col("cleaned_rows"))
        .select("raw_rows", "cleaned_rows", "rows_removed", "label_0", "label_1")
    )


def copies_across(df: DataFrame, slices: str, first: list[str], second: list[str]) -> DataFrame:
    """Rows of the ``second`` slices whose clean text also occurs in the ``first`` ones: the
    phases are drawn before copies are dropped, so a holdout may hold training texts. ``df`` has
    a ``DIGEST`` of every text, however short, or the texts."""
    digest = F.col(DIGEST) if DIGEST in df.columns else text_digest(F.col(TEXT), 0).alias(DIGEST)
    groups = (
        df.select(slices, digest)
        .groupBy(DIGEST)
        .agg(
            F.count_if(F.col(slices).isin(first)).alias("_first"),
            F.count_if(F.col(slices).isin(second)).alias("_second"),
        )
    )
    return groups.agg(
        F.coalesce(F.sum("_second"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_first") > 0, F.col("_second"))), F.lit(0)).alias(
            "seen_before"
        ),
    )
