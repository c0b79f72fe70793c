"""Count tables: distributions, shares, phase and split summaries, key overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.operators.sampling import HOLDOUT, PHASE1, PHASE2, with_sample_rows
from labeltext.schema import KEY, LABEL, SOURCE


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value (or combination of values); null values have no row."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def with_source(df: DataFrame, manifest: DataFrame, key: str = KEY, how: str = "inner") -> DataFrame:
    """Attach the source of each row by key."""
    return df.join(manifest.select(key, SOURCE), key, how)


def source_distribution(df: DataFrame, manifest: DataFrame, key: str = KEY) -> DataFrame:
    """Rows per slice and source; empty if the table lost its key."""
    if key not in df.columns:
        empty = manifest.select(F.lit("").alias("slice"), SOURCE).limit(0)
        return distribution(empty, "slice", SOURCE)
    return distribution(with_source(df.select(key, "slice"), manifest, key), "slice", SOURCE)


def shares(counts: DataFrame, slices: str = "slice", digits: int = 4) -> DataFrame:
    """Add each count's share of its slice. ``counts`` has one row per slice and value."""
    totals = counts.groupBy(slices).agg(F.sum("n").alias("_total"))
    return (
        counts.join(totals, slices)
        .withColumn("share", F.round(F.col("n") / F.col("_total"), digits))
        .drop("_total")
    )


def label_counts(df: DataFrame, by: str, label: str = LABEL) -> DataFrame:
    """One row per ``by`` value with rows and both label counts."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(label) == 0).alias("label_0"),
        F.count_if(F.col(label) == 1).alias("label_1"),
    )


def phase_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, label counts and positive rate of the three phases and the modelling sample."""
    return label_counts(with_sample_rows(df.select("phase", label)), "phase", label).withColumn(
        "positive_rate", F.round(F.col("label_1") / F.col("rows"), 4)
    )


def sample_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per phase and label with the totals per phase (label null) and the raw total
    (both null)."""
    by_phase = with_sample_rows(df.select("phase", label))
    counts = by_phase.groupBy("phase", label).agg(F.count(F.lit(1)).alias("n"))
    raw = F.sum(F.when(F.col("phase").isin(PHASE1, PHASE2, HOLDOUT), F.col("n")))
    return counts.rollup("phase", label).agg(
        F.when(F.grouping("phase") == 1, raw).otherwise(F.sum("n")).alias("n")
    )


def split_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Splits by label counts, absent combinations as 0."""
    return label_counts(df, "split", label)


def key_overlap(df: DataFrame, slices: str, pairs: list[tuple[list[str], list[str]]],
                key: str = KEY) -> DataFrame:
    """For each pair of slice sets: keys in both, only in the first, only in the second.

    One pass: slices are collected into flags per key, whatever the number of pairs."""
    names = sorted({n for pair in pairs for side in pair for n in side})
    flags = df.groupBy(key).agg(
        *[F.max((F.col(slices) == n).cast("int")).alias(f"in_{i}") for i, n in enumerate(names)]
    )

    def member(side: list[str]):
        return F.greatest(F.lit(0), *[F.col(f"in_{names.index(n)}") for n in side]) == 1

    counted = flags.agg(
        *[
            F.struct(
                F.lit("+".join(a)).alias("left_slices"),
                F.lit("+".join(b)).alias("right_slices"),
                F.count_if(member(a) & member(b)).alias("in_both"),
                F.count_if(member(a) & ~member(b)).alias("only_left"),
                F.count_if(~member(a) & member(b)).alias("only_right"),
            ).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return counted.select(
        F.inline(F.array(*[F.col(f"p{i}") for i in range(len(pairs))]))
    )
