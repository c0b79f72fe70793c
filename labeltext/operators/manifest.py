"""Source manifest: which source and source row each row of the combined table came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labeltext.operators.counts import distribution
from labeltext.schema import KEY, LABEL, SOURCE
from labeltext.session import stored


def number_blocks(sources: DataFrame) -> DataFrame:
    """Add ``raw_index``: sources laid end to end in the order of ``source_pos``, rows in the
    order of ``source_row_index``. Only the table of source sizes is ordered as a whole."""
    sizes = sources.groupBy(SOURCE, "source_pos").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(F.lit(0))
        .orderBy("source_pos")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        SOURCE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        sources.join(stored(starts), SOURCE)
        .withColumn(KEY, F.col("_start") + F.col("source_row_index"))
        .drop("_start")
    )


def source_manifest(sources: DataFrame, combined: DataFrame) -> DataFrame:
    """raw_index, source, source_row_index and the label of the combined table.

    ``sources``: source, source_pos, source_row_index, label; ``combined``: raw_index, label.
    ValueError if a source's label counts differ from those of its block, or if a combined
    row belongs to no source."""
    numbered = number_blocks(sources).select(
        KEY, SOURCE, "source_row_index", F.col(LABEL).alias("_source_label")
    )
    both = combined.select(KEY, LABEL).join(numbered, KEY, "full_outer")
    blocks = both.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            (F.count_if(F.col(LABEL) == v) - F.count_if(F.col("_source_label") == v)).alias(f"d{v}")
            for v in (0, 1)
        ],
    )
    differs = F.col(SOURCE).isNotNull() & ((F.col("d0") != 0) | (F.col("d1") != 0))
    problems = blocks.agg(
        F.count_if(differs).alias("sources"),
        F.min(F.when(differs, F.col(SOURCE))).alias("example"),
        F.sum(F.when(F.col(SOURCE).isNull(), F.col("rows"))).alias("unassigned"),
    ).first()
    if problems["sources"]:
        raise ValueError(
            f"{problems['sources']} sources differ in label counts from their block of the "
            f"combined table, e.g. {problems['example']}"
        )
    if problems["unassigned"]:
        raise ValueError(f"{problems['unassigned']} combined rows belong to no source")
    return both.select(KEY, SOURCE, "source_row_index", LABEL)


def label_by_source(manifest: DataFrame) -> DataFrame:
    return distribution(manifest, SOURCE, LABEL)
