"""Train, compare, pick, evaluate."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.operators.classifiers import (
    FittedModels,
    fit_models,
    load_models,
    predictions,
    save_models,
)
from labeltext.operators.features import TfidfParams
from labeltext.operators.metrics import best_model, full_report, run_metrics
from labeltext.schema import KEY, LABEL, MODEL_NAMES, PRIMARY_METRIC
from labeltext.session import cut_lineage
from labeltext.sources.files import append_rows
from labeltext.sources.model_store import publish

# Parameters of the two named sweep runs.
SWEEP = [
    {"name": "phase2_baseline", "max_features": 20_000, "ngram_range": (1, 2), "C": 1.0},
    {"name": "phase2_experimental", "max_features": 10_000, "ngram_range": (1, 3), "C": 0.5},
]


@dataclass
class TrainingRun:
    models: FittedModels
    predictions: DataFrame
    report: DataFrame
    best: str


def train_and_compare(
    splits: DataFrame,
    names: list[str] | None = None,
    params: TfidfParams = TfidfParams(),
    options: dict[str, dict] | None = None,
    metric: str = PRIMARY_METRIC,
) -> TrainingRun:
    """Fit on the train split, score val and test once for all models, and pick the best by
    the validation metric. ``splits`` should be a stored table."""
    names = names or MODEL_NAMES
    models = fit_models(splits.where(F.col("split") == "train"), names, params, options)
    scored = cut_lineage(
        predictions(
            splits.where(F.col("split") != "train"), models, keep=["split", LABEL]
        )
    )
    report = cut_lineage(full_report(scored, ["model", "split"]))
    best = best_model(report, metric, names).first()["best_model"]
    return TrainingRun(models, scored, report, best)


def publish_best(run: TrainingRun, store: str, metric: str = PRIMARY_METRIC) -> str:
    """Publish the run's selected model with its validation metric; returns the version."""
    row = run.report.where((F.col("split") == "val") & (F.col("model") == run.best)).first()
    return publish(run.models.only(run.best), store, row[metric], metric)


def evaluate(models: FittedModels, tables: dict[str, DataFrame]) -> DataFrame:
    """All metrics of all models on each named table (raw_index, text_combined, label)."""
    tagged = [df.select(KEY, "text_combined", LABEL).withColumn("slice", F.lit(name))
              for name, df in tables.items()]
    scored = [predictions(df, models, keep=["slice", LABEL]) for df in tagged]
    union = reduce(DataFrame.unionByName, scored)
    by = ["model", "slice"]
    return full_report(union, by).join(
        union.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")), by
    )


def cross_slice(first: FittedModels, second: FittedModels, increment: DataFrame) -> DataFrame:
    """A model fitted on the first phase next to the current best, both on the increment."""
    columns = ["f2", "recall", "false_negative_rate", "precision", "false_positive_rate"]
    parts = [
        evaluate(models, {"phase2_increment": increment}).select(
            F.concat(F.lit(prefix), "model").alias("model"),
            "slice",
            *[F.round(c, 4).alias(c) for c in columns],
        )
        for prefix, models in (("phase1_", first), ("phase2_", second))
    ]
    return parts[0].unionByName(parts[1])


def fit_outcome(models: FittedModels, run_id: str) -> DataFrame:
    """Rows of the run table that say how each model's optimiser ended."""
    rows = [
        (run_id, None, head.model, metric, float(getattr(head, metric)))
        for head in models.heads
        for metric in ("iterations", "relative_gradient", "converged")
    ]
    return models.terms.sparkSession.createDataFrame(
        rows, "run_id string, parent_id string, model string, metric string, value double"
    )


def sweep(
    splits: DataFrame,
    path: str,
    runs: list[dict] = SWEEP,
    names: list[str] | None = None,
    artifacts: str | None = None,
) -> DataFrame:
    """Train once per parameter set and append the metrics of each run, and how its fits
    ended, to the run table. ``artifacts`` takes what each run made: all its models
    (``run_models``) and its predictions, partitioned by run; a run of the same name replaces
    its own only."""
    for run in runs:
        params = TfidfParams(
            max_features=run["max_features"],
            ngram_range=tuple(run["ngram_range"]),
            min_df=run.get("min_df", TfidfParams.min_df),
            max_df=run.get("max_df", TfidfParams.max_df),
        )
        options = {"logistic_regression": {"C": run["C"]}}
        result = train_and_compare(splits, names, params, options)
        if artifacts is not None:
            save_models(result.models, f"{artifacts}/models/run={run['name']}")
            result.predictions.write.mode("overwrite").parquet(
                f"{artifacts}/predictions/run={run['name']}"
            )
        table = run_metrics(result.report, splits, run["name"])
        append_rows(table.unionByName(fit_outcome(result.models, run["name"])), path)
    return splits.sparkSession.read.parquet(path)


def run_models(spark: SparkSession, artifacts: str, name: str) -> FittedModels:
    """All models of a run of the sweep."""
    return load_models(spark, f"{artifacts}/models/run={name}")


def run_predictions(spark: SparkSession, artifacts: str) -> DataFrame:
    """The val and test predictions of all runs; a filter on ``run`` reads that run only."""
    return spark.read.parquet(f"{artifacts}/predictions")


def scoring_throughput(
    df: DataFrame,
    models: FittedModels,
    sizes: list[int],
    repeats: int = 3,
    key: str = KEY,
) -> DataFrame:
    """Time to score the first ``size`` rows, several times each. Sizes are capped to the
    table; without rows there is nothing to time."""
    rows = []
    for size in sizes:
        batch = cut_lineage(df.orderBy(key).limit(size))
        n = batch.count()
        if n == 0:
            continue
        for repeat in range(1, repeats + 1):
            started = time.perf_counter()
            predictions(batch, models, key).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - started
            rows.append((n, repeat, elapsed, n / elapsed if elapsed else 0.0, elapsed / n * 1000))
    return df.sparkSession.createDataFrame(
        rows,
        "batch_size bigint, repeat int, elapsed_seconds double, records_per_second double, "
        "milliseconds_per_record double",
    )
