"""Threshold metrics, ranking metrics and error slices of prediction tables.

A prediction table has label, prediction, score and any grouping columns, e.g. model and
split; all groups are evaluated in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeltext.operators.ranking import running_sums
from labeltext.schema import KEY, LABEL, MODEL_NAMES, PRIMARY_METRIC, SOURCE

METRICS = [
    "accuracy", "precision", "recall", "f1", "f2", "true_negative", "false_positive",
    "false_negative", "true_positive", "false_positive_rate", "false_negative_rate",
]
RANKING_METRICS = ["roc_auc", "average_precision"]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def confusion(df: DataFrame, by: list[str]) -> DataFrame:
    """The four cells for labels 0 and 1 per group."""
    label, prediction = F.col(LABEL), F.col("prediction")

    def cell(y: int, p: int) -> Column:
        return F.count_if((label == y) & (prediction == p)).cast("double")

    return df.groupBy(*by).agg(
        cell(0, 0).alias("true_negative"),
        cell(0, 1).alias("false_positive"),
        cell(1, 0).alias("false_negative"),
        cell(1, 1).alias("true_positive"),
    )


def classification_report(df: DataFrame, by: list[str], positive_label: int = 1) -> DataFrame:
    """The eleven threshold metrics per group. Precision, recall and F follow
    ``positive_label``; cells and error rates always take 1 as positive. 0/0 gives 0."""
    tn, fp, fn, tp = (
        F.col(c)
        for c in ("true_negative", "false_positive", "false_negative", "true_positive")
    )
    hit, extra, missed = (tp, fp, fn) if positive_label == 1 else (tn, fn, fp)

    def f_score(beta: int) -> Column:
        weight = beta * beta
        return _ratio((1 + weight) * hit, (1 + weight) * hit + weight * missed + extra)

    return confusion(df, by).select(
        *by,
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(hit, hit + extra).alias("precision"),
        _ratio(hit, hit + missed).alias("recall"),
        f_score(1).alias("f1"),
        f_score(2).alias("f2"),
        tn, fp, fn, tp,
        _ratio(fp, fp + tn).alias("false_positive_rate"),
        _ratio(fn, fn + tp).alias("false_negative_rate"),
    )


def score_steps(df: DataFrame, by: list[str]) -> DataFrame:
    """Per group and distinct score, in falling order of score: label counts and their
    running sums. The base of all ranking metrics."""
    counts = (
        df.where(F.col("score").isNotNull())
        .groupBy(*by, "score")
        .agg(
            F.count_if(F.col(LABEL) == 1).alias("pos"),
            F.count_if(F.col(LABEL) == 0).alias("neg"),
        )
    )
    return running_sums(counts, by, "score", ["pos", "neg"], descending=True)


def ranking_report(steps: DataFrame, by: list[str]) -> DataFrame:
    """ROC-AUC (ties count half; null with a single class) and average precision (step sum;
    0 without positives) per group."""
    pos, neg = F.sum("pos"), F.sum("neg")
    above = F.col("cum_pos") - F.col("pos")
    pairs_won = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return steps.groupBy(*by).agg(
        F.when((pos > 0) & (neg > 0), pairs_won / (pos * neg)).alias("roc_auc"),
        _ratio(F.sum(F.col("pos") * precision), pos).alias("average_precision"),
    )


def pr_curve(steps: DataFrame, by: list[str]) -> DataFrame:
    """Precision and recall at every distinct score used as threshold. The point (recall 0,
    precision 1), which has no threshold, is not listed."""
    positives = steps.groupBy(*by).agg(F.sum("pos").alias("_positives"))
    return steps.join(positives, by).select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.when(F.col("_positives") > 0, F.col("cum_pos") / F.col("_positives"))
        .otherwise(1.0)
        .alias("recall"),
    )


def full_report(df: DataFrame, by: list[str], positive_label: int = 1) -> DataFrame:
    """All thirteen metrics per group; the two ranking metrics are null without scores."""
    ranking = ranking_report(score_steps(df, by), by)
    return classification_report(df, by, positive_label).join(ranking, by, "left")


def long_metrics(report: DataFrame, by: list[str]) -> DataFrame:
    """One row per metric; metrics without a value have no row."""
    names = [m for m in METRICS + RANKING_METRICS if m in report.columns]
    return report.unpivot(by, names, "metric", "value").where(F.col("value").isNotNull())


def run_metrics(
    report: DataFrame, rows: DataFrame, run_id: str, parent_id: str | None = None
) -> DataFrame:
    """Rows of the append-only metrics table: ``{split}_{metric}`` per model, and row and
    label counts per split. ``rows`` has split and label."""
    metrics = long_metrics(report, ["model", "split"]).select(
        "model", F.concat_ws("_", "split", "metric").alias("metric"), "value"
    )
    counts = (
        rows.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(LABEL) == 0).alias("label_0"),
            F.count_if(F.col(LABEL) == 1).alias("label_1"),
        )
        .unpivot("split", ["rows", "label_0", "label_1"], "name", "value")
        .where((F.col("value") > 0) | (F.col("name") == "rows"))
        .select(
            F.lit(None).cast("string").alias("model"),
            F.concat_ws("_", "split", "name").alias("metric"),
            F.col("value").cast("double").alias("value"),
        )
    )
    return metrics.unionByName(counts).select(
        F.lit(run_id).alias("run_id"),
        F.lit(parent_id).cast("string").alias("parent_id"),
        "model",
        "metric",
        "value",
    )


def model_comparison(report: DataFrame, order_by: str = f"val_{PRIMARY_METRIC}") -> DataFrame:
    """One row per model with ``val_*`` and ``test_*`` columns, best first."""
    names = [m for m in METRICS + RANKING_METRICS if m in report.columns]
    wide = report.groupBy("model").agg(
        *[
            F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
            for s in ("val", "test")
            for m in names
        ]
    )
    return wide.orderBy(F.col(order_by).desc(), "model")


def best_model(report: DataFrame, metric: str = PRIMARY_METRIC,
               order: list[str] | None = None) -> DataFrame:
    """The model with the highest validation metric, the one listed first on ties."""
    order = order or MODEL_NAMES
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return (
        report.where(F.col("split") == "val")
        .orderBy(F.col(metric).desc(), F.when(position > 0, position).otherwise(len(order) + 1),
                 "model")
        .limit(1)
        .select(F.col("model").alias("best_model"), F.col(metric).alias(f"val_{metric}"))
    )


def metric_delta(first: DataFrame, second: DataFrame, metrics: list[str]) -> DataFrame:
    """Second minus first, rounded to 4 digits, for models present in both."""
    a = first.select("model", *[F.col(m).alias(f"_{m}") for m in metrics])
    return second.join(a, "model").select(
        "model", *[F.round(F.col(m) - F.col(f"_{m}"), 4).alias(f"delta_{m}") for m in metrics]
    )


def metric_pivot(tables: dict[str, DataFrame], metric: str) -> DataFrame:
    """Models by phases for one metric; null where a phase lacks a model."""
    tagged = None
    for phase, table in tables.items():
        part = table.select("model", metric).withColumn("phase", F.lit(phase))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("model").pivot("phase", list(tables)).agg(F.first(metric))


def error_slices(df: DataFrame, by: list[str], top: int = 5, key: str = KEY) -> DataFrame:
    """The first ``top`` false negatives and false positives per group, in key order."""
    kind = F.when((F.col(LABEL) == 1) & (F.col("prediction") == 0), "false_negative").when(
        (F.col(LABEL) == 0) & (F.col("prediction") == 1), "false_positive"
    )
    errors = df.withColumn("error", kind).where(F.col("error").isNotNull())
    # The rank limit right above the window becomes a group limit below the shuffle: each task
    # sends its first ``top`` rows per group only.
    order = Window.partitionBy(*by, "error").orderBy(key)
    return (
        errors.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= top)
        .select(
            *by, "error", F.col("position").cast("bigint").alias("position"),
            *[c for c in df.columns if c not in by],
        )
    )


def stats_by_source(df: DataFrame) -> DataFrame:
    """Per source (rows without one form a group): sizes, errors, recall and miss rate, null
    without positives; most misses first."""
    label, prediction = F.col(LABEL), F.col("prediction")
    stats = df.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(label == 1).alias("positives"),
        F.count_if(label == 0).alias("negatives"),
        F.count_if((label == 1) & (prediction == 0)).alias("false_negatives"),
        F.count_if((label == 0) & (prediction == 1)).alias("false_positives"),
    )
    miss_rate = F.when(
        F.col("positives") > 0, F.col("false_negatives") / F.col("positives")
    )
    return stats.select(
        "*",
        F.round(1 - miss_rate, 4).alias("recall"),
        F.round(miss_rate, 4).alias("false_negative_rate"),
    ).orderBy(F.col("false_negatives").desc(), SOURCE)


def latency_summary(
    log: DataFrame, latency: str, failed: Column, quantile: float = 0.95
) -> DataFrame:
    """Requests, failures, mean latency and the nearest-rank quantile at index
    round((n-1) * quantile), from counts per distinct latency. Requests without a latency
    count as requests and failures; mean and quantile are of the others."""
    counts = log.groupBy(latency).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("failures")
    )
    every = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("requests"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("failures"),
    )
    counts = counts.where(F.col(latency).isNotNull())
    total = counts.agg(F.sum("n")).scalar()
    wanted = F.bround((total - 1) * F.lit(quantile), 0) + 1
    sums = running_sums(counts, [], latency, ["n"])
    timed = sums.agg(
        (F.sum(F.col(latency) * F.col("n")) / F.sum("n")).alias("mean_latency_ms"),
        F.min(F.when(F.col("cum_n") >= wanted, F.col(latency))).alias("p95_latency_ms"),
    )
    # One row each.
    return every.join(timed, F.lit(True)).select(
        "requests", "failures", "mean_latency_ms", "p95_latency_ms"
    )


def latest_children(runs: DataFrame) -> DataFrame:
    """Children of the most recently started finished parent run. ``runs`` has run_id,
    parent_id, name, status, start_time."""
    latest = (
        runs.where(F.col("parent_id").isNull() & (F.col("status") == "FINISHED"))
        .orderBy(F.col("start_time").desc(), F.col("run_id").desc())
        .limit(1)
        .select(F.col("run_id").alias("parent_id"))
    )
    return runs.join(F.broadcast(latest), "parent_id").orderBy("name", "run_id")
