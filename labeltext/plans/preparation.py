"""Raw corpus to split, clean, checked tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.operators.prepare import DIGEST, cleaned_rows, digested_rows, distinct_keys
from labeltext.operators.quality import all_passed, validate_tagged
from labeltext.operators.sampling import (
    HOLDOUT,
    SAMPLE,
    SPLITS,
    phase_partition,
    phase_rows,
    train_val_test_split,
)
from labeltext.schema import KEY, MIN_TEXT_LENGTH
from labeltext.session import cut_lineage
from labeltext.sources.files import export_jsonl, write_stage


def split_keys(phased: DataFrame, min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """(raw_index, label, split) of the cleaned modelling sample. Everything is decided on
    this narrow table: texts are read once for their digests, or not at all if ``phased`` has
    a ``DIGEST`` column, made with its own ``min_length``."""
    sample = phase_rows(phased, SAMPLE)
    if DIGEST in phased.columns:
        rows = digested_rows(sample, keep=[KEY])
    else:
        rows = cleaned_rows(sample, keep=[KEY], min_length=min_length)
    return train_val_test_split(cut_lineage(distinct_keys(rows)))


def modelling_table(phased: DataFrame, min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """raw_index, text_combined, label, split: sampled, cleaned, without copies, split.

    Partitioned by key, as the feature steps want it. A shuffled join leaves it like that
    already; behind a broadcast join this is the one move of the texts."""
    rows = cleaned_rows(phase_rows(phased, SAMPLE), keep=[KEY], min_length=min_length)
    keys = split_keys(phased, min_length).select(KEY, "split")
    return rows.join(keys, KEY).repartition(KEY)


def holdout_table(phased: DataFrame, min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """The untouched phase, cleaned the same way but with its copies."""
    rows = phase_rows(phased, HOLDOUT)
    return cleaned_rows(rows, keep=[KEY], min_length=min_length)


def validate_splits(modelling: DataFrame, min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """Verdicts for the cleaned table and its three splits, from one scan."""
    tagged = modelling.withColumn(
        "dataset", F.explode(F.array(F.lit("cleaned"), F.col("split")))
    )
    return validate_tagged(tagged, ["cleaned", *SPLITS], min_length)


def prepare(raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write phases and modelling splits below ``path`` and return both tables as read back.
    RuntimeError if a check fails."""
    phases = write_stage(phase_partition(raw), f"{path}/phases", "phase")
    splits = write_stage(modelling_table(phases), f"{path}/splits", "split")
    if not all_passed(validate_splits(splits)):
        raise RuntimeError("data validation failed")
    export_jsonl(splits, f"{path}/jsonl")
    return phases, splits

