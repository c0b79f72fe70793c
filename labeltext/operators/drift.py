"""Drift between two slices of one table: distributions, text lengths, vocabulary.

Input tables carry a ``slice`` column. Every measure first shrinks to a table of counts, by
an aggregation with map-side partial sums, and goes on from there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeltext.functions.text import tokens
from labeltext.operators.ranking import running_sums
from labeltext.operators.sampling import PHASE1, PHASE2
from labeltext.schema import TEXT, TOP_NEW_TOKENS

LENGTH = "length"
HISTOGRAM_BINS = 80
SHOWN_QUANTILE = 0.98
SERIES_TERMS = 20


def side_by_side(
    counts: DataFrame,
    key: str,
    reference: str = PHASE1,
    current: str = PHASE2,
    value: str = "n",
) -> DataFrame:
    """One row per key with its count on either side, 0 where it does not occur."""
    return counts.groupBy(key).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("slice") == side, F.col(value))), F.lit(0)).alias(name)
            for side, name in ((reference, "ref_n"), (current, "cur_n"))
        ]
    )


def js_distance(pairs: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (natural log) of the two count columns, as one row; null if a
    side is empty."""
    totals = pairs.agg(F.sum("ref_n").alias("ref"), F.sum("cur_n").alias("cur"))
    p = F.try_divide("ref_n", totals.select("ref").scalar())
    q = F.try_divide("cur_n", totals.select("cur").scalar())

    def term(x: Column, y: Column) -> Column:
        return F.when(x > 0, 0.5 * x * F.ln(2 * x / (x + y))).when(x == 0, 0.0)

    divergence = F.sum(term(F.col("p"), F.col("q")) + term(F.col("q"), F.col("p")))
    return pairs.select(p.alias("p"), q.alias("q")).agg(
        F.sqrt(F.when(divergence.isNotNull(), F.greatest(F.lit(0.0), divergence))).alias(
            "js_distance"
        )
    )


def length_counts(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Rows per slice and text length in characters, null text as length 0. The input of all
    length measures."""
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    return df.groupBy("slice", size.cast("bigint").alias(LENGTH)).agg(
        F.count(F.lit(1)).alias("n")
    )


def length_stats(lengths: DataFrame) -> DataFrame:
    """Mean, median, 90th percentile (both interpolated) and maximum per slice."""
    return lengths.groupBy("slice").agg(
        (F.sum(F.col(LENGTH) * F.col("n")) / F.sum("n")).alias("mean"),
        F.percentile(LENGTH, F.lit(0.5), F.col("n")).alias("median"),
        F.percentile(LENGTH, F.lit(0.9), F.col("n")).alias("p90"),
        F.max(LENGTH).cast("double").alias("max"),
    )


def length_histogram(
    lengths: DataFrame, bins: int = HISTOGRAM_BINS, reference: str = PHASE1
) -> DataFrame:
    """Equal-width bins over each slice's own range, with densities. ``shown`` marks the bins
    that start below the reference's 98th percentile. Bin numbers are exact integers."""
    ranges = lengths.groupBy("slice").agg(
        F.min(LENGTH).alias("lo"), F.max(LENGTH).alias("hi"), F.sum("n").alias("total")
    )
    cut = (
        lengths.where(F.col("slice") == reference)
        .agg(F.percentile(LENGTH, F.lit(SHOWN_QUANTILE), F.col("n")))
        .scalar()
    )
    span = F.col("hi") - F.col("lo")
    number = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(LENGTH) - F.col("lo")) * bins / span), F.lit(bins - 1))
    )
    width = F.when(span == 0, F.lit(1.0)).otherwise(span / bins)
    return (
        lengths.join(ranges, "slice")
        .withColumn("bin", number.cast("bigint"))
        .withColumn("width", width)
        .groupBy("slice", "bin", "lo", "width", "total")
        .agg(F.sum("n").alias("n"))
        .select(
            "slice",
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("start"),
            "n",
            (F.col("n") / (F.col("total") * F.col("width"))).alias("density"),
        )
        .withColumn("shown", F.col("start") < cut)
    )


def kolmogorov_tail(x: Column) -> Column:
    """P(K > x) of the Kolmogorov distribution: the two classical series, each where it
    converges within a few terms."""
    terms = F.sequence(F.lit(1), F.lit(SERIES_TERMS))

    def total(term) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda acc, k: acc + term(k))

    tail = 2 * total(lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x))
    head = total(
        lambda k: F.exp(-(2 * k - 1) * (2 * k - 1) * (math.pi**2) / (8 * x * x))
    ) * (F.lit(math.sqrt(2 * math.pi)) / x)
    return F.when(x < 1e-3, 1.0).when(x < 1.0, 1 - head).otherwise(tail)


def ks_test(
    lengths: DataFrame, reference: str = PHASE1, current: str = PHASE2
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic over the lengths and its p-value in the limit
    of large samples, as one row; null if a slice is empty."""
    pairs = side_by_side(lengths, LENGTH, reference, current)
    sums = running_sums(pairs, [], LENGTH, ["ref_n", "cur_n"])
    last = sums.agg(F.max("cum_ref_n").alias("ref"), F.max("cum_cur_n").alias("cur"))
    ref, cur = last.select("ref").scalar(), last.select("cur").scalar()
    gap = F.abs(F.try_divide("cum_ref_n", ref) - F.try_divide("cum_cur_n", cur))
    return (
        sums.select(gap.alias("gap"), ref.alias("ref"), cur.alias("cur"))
        .agg(
            F.max("gap").alias("ks_statistic"),
            F.max("ref").alias("ref"),
            F.max("cur").alias("cur"),
        )
        .withColumn(
            "effective",
            F.sqrt(F.try_divide(F.col("ref") * F.col("cur"), F.col("ref") + F.col("cur"))),
        )
        .select(
            "ks_statistic",
            kolmogorov_tail(F.col("effective") * F.col("ks_statistic")).alias("ks_pvalue"),
        )
    )


def token_counts(df: DataFrame, text: str = TEXT, by: list[str] | None = None) -> DataFrame:
    """Occurrences per token, case kept."""
    by = by or []
    return (
        df.select(*by, F.explode(tokens(F.col(text))).alias("token"))
        .groupBy(*by, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def token_pairs(
    df: DataFrame, text: str = TEXT, reference: str = PHASE1, current: str = PHASE2
) -> DataFrame:
    """Occurrences of each token on either side, from one pass over the texts and one
    shuffle of partial counts by token."""
    exploded = df.select("slice", F.explode(tokens(F.col(text))).alias("token"))
    return exploded.groupBy("token").agg(
        F.count_if(F.col("slice") == reference).alias("ref_n"),
        F.count_if(F.col("slice") == current).alias("cur_n"),
    )


def vocabulary_drift(pairs: DataFrame) -> DataFrame:
    """Vocabulary sizes, new tokens, and the share of current occurrences that are new."""
    new = (F.col("ref_n") == 0) & (F.col("cur_n") > 0)
    total = F.coalesce(F.sum("cur_n"), F.lit(0))
    return pairs.agg(
        F.count_if(F.col("ref_n") > 0).alias("reference_vocab_size"),
        F.count_if(F.col("cur_n") > 0).alias("current_vocab_size"),
        F.count_if(new).alias("new_token_count"),
        F.when(total > 0, F.coalesce(F.sum(F.when(new, F.col("cur_n"))), F.lit(0)) / total)
        .otherwise(0.0)
        .alias("new_token_rate"),
    )


def new_tokens(pairs: DataFrame, top: int = TOP_NEW_TOKENS) -> DataFrame:
    """The most frequent tokens of the current slice that the reference lacks."""
    return (
        pairs.where((F.col("ref_n") == 0) & (F.col("cur_n") > 0))
        .select("token", F.col("cur_n").alias("n"))
        .orderBy(F.col("n").desc(), "token")
        .limit(top)
    )


def vocabulary_difference(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Token counts of ``current`` without the tokens of ``reference``."""
    return current.join(reference.select("token"), "token", "left_anti")


def share_table(
    counts: DataFrame, key: str, reference: str = PHASE1, current: str = PHASE2
) -> DataFrame:
    """Counts and 4-digit shares of both slices side by side."""
    pairs = side_by_side(counts, key, reference, current)
    totals = pairs.agg(F.sum("ref_n").alias("ref"), F.sum("cur_n").alias("cur"))

    def share(side: str) -> Column:
        return F.round(F.try_divide(f"{side}_n", totals.select(side).scalar()), 4)

    return pairs.select(
        key, "ref_n", "cur_n", share("ref").alias("ref_share"), share("cur").alias("cur_share")
    )
