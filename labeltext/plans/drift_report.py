"""The full drift report between two slices as one long table.

Texts are only read to build a profile: a handful of count tables. The report is derived
from these, so a fixed reference is profiled once and merged with each new increment.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeltext.operators import drift
from labeltext.operators.classifiers import FittedModels, predictions
from labeltext.operators.counts import distribution, source_distribution
from labeltext.operators.sampling import PHASE1, PHASE2
from labeltext.schema import KEY, LABEL, SOURCE, TEXT, TOP_NEW_TOKENS
from labeltext.session import cut_lineage


@dataclass
class DriftProfile:
    """``lengths``: slice, label, length, n; ``tokens``: token, ref_n, cur_n; ``sources``:
    slice, source, n; ``predicted``: slice, prediction, n."""

    lengths: DataFrame
    tokens: DataFrame
    sources: DataFrame | None = None
    predicted: DataFrame | None = None

    def merged(self, other: DriftProfile) -> DriftProfile:
        """Profile of both inputs together; the slices of the two must differ."""
        tokens = self.tokens.unionByName(other.tokens).groupBy("token").agg(
            F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n")
        )

        def union(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
            return None if a is None or b is None else a.unionByName(b)

        return DriftProfile(
            union(self.lengths, other.lengths),
            tokens,
            union(self.sources, other.sources),
            union(self.predicted, other.predicted),
        )


def drift_profile(
    df: DataFrame,
    manifest: DataFrame | None = None,
    models: FittedModels | None = None,
    reference: str = PHASE1,
    current: str = PHASE2,
) -> DriftProfile:
    """Count tables of raw rows tagged with ``slice``, each written once. Sources and
    predictions are counted only if a manifest or models are given."""
    df = df.where(F.col("slice").isin(reference, current))
    size = F.length(F.coalesce(F.col(TEXT), F.lit(""))).cast("bigint")
    lengths = df.groupBy("slice", LABEL, size.alias(drift.LENGTH)).agg(
        F.count(F.lit(1)).alias("n")
    )
    sources = predicted = None
    if manifest is not None:
        sources = cut_lineage(source_distribution(df, manifest))
    if models is not None:
        scored = predictions(df, models, KEY, TEXT, keep=["slice"])
        predicted = cut_lineage(distribution(scored, "slice", "prediction"))
    return DriftProfile(
        cut_lineage(lengths),
        cut_lineage(drift.token_pairs(df, TEXT, reference, current)),
        sources,
        predicted,
    )


def _line(section: str, name: Column, value: Column, slice_: Column | None = None) -> list[Column]:
    return [
        F.lit(section).alias("section"),
        (F.lit(None).cast("string") if slice_ is None else slice_).alias("slice"),
        name.cast("string").alias("name"),
        value.cast("double").alias("value"),
    ]


def _measures(df: DataFrame, section: str, names: list[str], by_slice: bool = False) -> DataFrame:
    """One line per named column of ``df``."""
    pairs = [F.struct(F.lit(n).alias("_name"), F.col(n).cast("double").alias("_value"))
             for n in names]
    kept = ["slice"] if by_slice else []
    flat = df.select(*kept, F.inline(F.array(*pairs)))
    slice_ = F.col("slice") if by_slice else None
    return flat.select(*_line(section, F.col("_name"), F.col("_value"), slice_))


def _compared(counts: DataFrame, section: str, key: str, reference: str, current: str):
    """Lines for the counts of a distribution and for the distance of its two sides."""
    distance = drift.js_distance(drift.side_by_side(counts, key, reference, current))
    return [
        counts.select(*_line(section, F.col(key), F.col("n"), F.col("slice"))),
        _measures(
            distance.withColumnRenamed("js_distance", "jensen_shannon_distance"),
            section,
            ["jensen_shannon_distance"],
        ),
    ]


def report_of(
    profile: DriftProfile,
    reference: str = PHASE1,
    current: str = PHASE2,
    top: int = TOP_NEW_TOKENS,
) -> DataFrame:
    """(section, slice, name, value); lines without a slice compare both."""
    def rolled(*columns: str) -> DataFrame:
        return profile.lengths.groupBy(*columns).agg(F.sum("n").alias("n"))

    lengths = rolled("slice", drift.LENGTH)
    labels = rolled("slice", LABEL).where(F.col(LABEL).isNotNull())
    stats, test = ["mean", "median", "p90", "max"], ["ks_statistic", "ks_pvalue"]
    vocabulary = [
        "reference_vocab_size", "current_vocab_size", "new_token_count", "new_token_rate",
    ]
    parts = [
        _measures(rolled("slice").withColumnRenamed("n", "rows"), "rows", ["rows"], True),
        *_compared(labels, "label", LABEL, reference, current),
        _measures(drift.length_stats(lengths), "text_length", stats, True),
        _measures(drift.ks_test(lengths, reference, current), "text_length", test),
        _measures(drift.vocabulary_drift(profile.tokens), "vocabulary", vocabulary),
        drift.new_tokens(profile.tokens, top).select(
            *_line("new_tokens", F.col("token"), F.col("n"))
        ),
    ]
    if profile.sources is not None:
        parts += _compared(profile.sources, "source", SOURCE, reference, current)
    if profile.predicted is not None:
        parts += _compared(profile.predicted, "prediction", "prediction", reference, current)
    return reduce(DataFrame.unionByName, parts)


def drift_report(
    df: DataFrame,
    manifest: DataFrame | None = None,
    models: FittedModels | None = None,
    reference: str = PHASE1,
    current: str = PHASE2,
    top: int = TOP_NEW_TOKENS,
) -> DataFrame:
    """Report for one table holding both slices."""
    profile = drift_profile(df, manifest, models, reference, current)
    return report_of(profile, reference, current, top)
