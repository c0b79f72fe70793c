"""Exact stratified samples, phase partitions and train/val/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labeltext.operators.ranking import rank_slices
from labeltext.schema import (
    HOLDOUT_FRACTION,
    KEY,
    LABEL,
    PHASE1_FRACTION,
    PHASE2_FRACTION,
    SEED,
    TEST_SIZE,
    TRAIN_SIZE,
    VAL_SIZE,
    require_columns,
)

# Slice names that appear in results.
PHASE1 = "phase1_reference"
PHASE2 = "phase2_increment"
SAMPLE = "phase2_sample"
HOLDOUT = "phase3_holdout"
SPLITS = ["train", "val", "test"]
TOLERANCE = 1e-8


def _share(column: str, fraction: float):
    """``column * fraction`` rounded half to even."""
    return F.bround(F.col(column) * F.lit(float(fraction)), 0).cast("bigint")


def stratified_sample(
    df: DataFrame,
    fraction: float,
    seed: int = SEED,
    label: str = LABEL,
    key: str = KEY,
    stratify: bool = True,
) -> DataFrame:
    """Exactly ``fraction`` of the rows, of each label if ``stratify``."""
    if not 0 < fraction <= 1:
        raise ValueError(f"sample fraction must lie in (0, 1], got {fraction}")
    if stratify:
        require_columns(df, [label])
    return rank_slices(
        df,
        [label] if stratify else [],
        key,
        seed,
        ["in"],
        lambda totals: totals.withColumn("r0", _share("n", fraction)),
        name="_sample",
    ).drop("_sample")


def phase_partition(
    df: DataFrame,
    phase1: float = PHASE1_FRACTION,
    phase2: float = PHASE2_FRACTION,
    holdout: float = HOLDOUT_FRACTION,
    sample: float | None = None,
    seed: int = SEED,
    label: str = LABEL,
    key: str = KEY,
    stratify: bool = True,
) -> DataFrame:
    """Add ``phase``: three disjoint slices, each with the label mix of the whole table.
    The modelling sample is the union of the first two (see :func:`phase_rows`)."""
    sample = phase1 + phase2 if sample is None else sample
    if abs(phase1 + phase2 + holdout - 1.0) > TOLERANCE:
        raise ValueError("phase fractions must sum to 1")
    if abs(sample - (phase1 + phase2)) > TOLERANCE:
        raise ValueError("sample fraction must equal the first two phase fractions together")
    if not stratify:
        raise ValueError("phases must be stratified by label")
    require_columns(df, [label])
    return rank_slices(
        df,
        [label],
        key,
        seed,
        [PHASE1, PHASE2, HOLDOUT],
        lambda totals: totals.withColumn("r0", _share("n", phase1)).withColumn(
            "r1", _share("n", sample)
        ),
    )


def phase_rows(df: DataFrame, phase: str) -> DataFrame:
    """Rows of one phase; the modelling sample is the first two phases."""
    names = [PHASE1, PHASE2] if phase == SAMPLE else [phase]
    return df.where(F.col("phase").isin(names))


def with_sample_rows(df: DataFrame) -> DataFrame:
    """Add the rows of the modelling sample as a fourth phase, without a second scan."""
    sample = F.when(F.col("phase") == HOLDOUT, F.array("phase")).otherwise(
        F.array(F.col("phase"), F.lit(SAMPLE))
    )
    return df.withColumn("phase", F.explode(sample))


def _split_bounds(totals: DataFrame, groups: list[str], val: float, test: float) -> DataFrame:
    """Upper ranks of train and val per group. ``totals`` has one row per group.

    Sizes of the whole come first (holdout and test round up); groups then get the floor of
    their share and the largest remainders one row more, the smaller label first on ties."""
    holdout = val + test
    everything = Window.partitionBy(F.lit(0))
    by_remainder = everything.orderBy(F.col("rest").desc(), *groups)

    def quota(df: DataFrame, size: str, of: str, drawn: str, name: str) -> DataFrame:
        share = F.try_divide(size, of) * F.col(drawn)
        return (
            df.withColumn("share", share)
            .withColumn("base", F.floor("share"))
            .withColumn("rest", F.col("share") - F.col("base"))
            .withColumn("left", F.col(drawn) - F.sum("base").over(everything))
            .withColumn(
                name,
                F.col("base")
                + (F.row_number().over(by_remainder) <= F.col("left")).cast("bigint"),
            )
        )

    out = (
        totals.withColumn("total", F.sum("n").over(everything))
        .withColumn("n_holdout", F.ceil(F.col("total") * F.lit(holdout)))
        .withColumn("n_test", F.ceil(F.col("n_holdout") * F.lit(test / holdout)))
        .withColumn("n_train", F.col("total") - F.col("n_holdout"))
        .withColumn("n_val", F.col("n_holdout") - F.col("n_test"))
    )
    out = quota(out, "n", "total", "n_train", "r0")
    out = out.withColumn("held", F.col("n") - F.col("r0"))
    out = quota(out, "held", "n_holdout", "n_val", "take")
    return out.select(*groups, "n", "r0", (F.col("r0") + F.col("take")).alias("r1"))


def train_val_test_split(
    df: DataFrame,
    train: float = TRAIN_SIZE,
    val: float = VAL_SIZE,
    test: float = TEST_SIZE,
    seed: int = SEED,
    label: str = LABEL,
    key: str = KEY,
    stratify: bool = True,
) -> DataFrame:
    """Add ``split``: train, val or test, with the label mix of the whole table."""
    if abs(train + val + test - 1.0) > TOLERANCE:
        raise ValueError("split sizes must sum to 1")
    if min(train, val, test) <= 0:
        raise ValueError("split sizes must be positive")
    if stratify:
        require_columns(df, [label])
    groups = [label] if stratify else []
    return rank_slices(
        df,
        groups,
        key,
        seed,
        SPLITS,
        lambda totals: _split_bounds(
            totals, [c for c in totals.columns if c != "n"], val, test
        ),
        name="split",
    )
