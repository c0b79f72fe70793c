"""The four text classifiers. Fitted, each of them is a constant or one coefficient per
vocabulary term, so that all of them score together in one pass over the texts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labeltext.functions.scoring import MARGIN, PROBABILITY, sigmoid
from labeltext.operators.features import (
    TfidfParams,
    document_sums,
    document_weights,
    free_name,
    vocabulary,
)
from labeltext.operators.linear import fit_blocks, objective_at, training_blocks
from labeltext.schema import KEY, LABEL, MODEL_NAMES, NB_ALPHA, TEXT
from labeltext.session import cut_lineage


@dataclass
class Head:
    """What a fitted model adds to the shared term table, and how its optimiser ended, if it
    has one."""

    model: str
    score_type: str
    intercept: float = 0.0
    constant: int | None = None
    iterations: int = 0
    relative_gradient: float = 0.0
    converged: bool = True


@dataclass
class FittedModels:
    """``terms``: term, term_id, idf and a column ``w_<model>`` per non-constant model."""

    terms: DataFrame
    heads: list[Head]
    params: TfidfParams = field(default_factory=TfidfParams)

    def only(self, model: str) -> FittedModels:
        return FittedModels(self.terms, [h for h in self.heads if h.model == model], self.params)


# ---- fitting ---------------------------------------------------------------------------


def majority_label(labels: DataFrame) -> DataFrame:
    """The most frequent label, the smaller one on ties, as one row."""
    return (
        labels.groupBy(LABEL)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), LABEL)
        .limit(1)
        .select(F.col(LABEL).alias("majority_label"))
    )


def complement_nb(weights: DataFrame, alpha: float = NB_ALPHA) -> DataFrame:
    """(term_id, weight_0, weight_1): minus the log share of the term among the *other*
    class's smoothed weights. ``weights`` has label, term_id, weight. The result has one row
    per vocabulary term, which bounds the windows over it."""
    def mass(label: int) -> Column:
        return F.sum(F.when(F.col(LABEL) == label, F.col("weight")).otherwise(0.0))

    counts = weights.groupBy("term_id").agg(mass(0).alias("m0"), mass(1).alias("m1"))
    everything = Window.partitionBy(F.lit(0))

    def share(other: str) -> Column:
        smooth = F.col(other) + alpha
        return -F.ln(smooth / F.sum(smooth).over(everything))

    return counts.select(
        "term_id", share("m1").alias("weight_0"), share("m0").alias("weight_1")
    )


@dataclass
class TrainingData:
    """The shared feature table; ``blocks`` are the cached rows of the linear models, by
    whether their classes are balanced."""

    features: DataFrame
    n_features: int
    blocks: dict[bool, RDD] = field(default_factory=dict)


def _fit_dummy(data: TrainingData, options: dict) -> tuple[Head, DataFrame | None]:
    if options.get("strategy", "most_frequent") != "most_frequent":
        raise ValueError("dummy supports the strategy most_frequent")
    label = majority_label(data.features).first()["majority_label"]
    return Head("dummy", PROBABILITY, constant=int(label)), None


def _fit_complement_nb(data: TrainingData, options: dict) -> tuple[Head, DataFrame | None]:
    entries = data.features.select(
        LABEL, F.explode(F.arrays_zip("indices", "values")).alias("_e")
    ).select(LABEL, F.col("_e.indices").cast("bigint").alias("term_id"),
             F.col("_e.values").alias("weight"))
    by_class = complement_nb(entries, float(options.get("alpha", NB_ALPHA)))
    column = (F.col("weight_1") - F.col("weight_0")).alias("w")
    return Head("complement_nb", PROBABILITY), by_class.select("term_id", column)


def _balanced(options: dict) -> bool:
    return options.get("class_weight", "balanced") == "balanced"


def _linear(name: str, loss: str, score_type: str, max_iter: int):
    def fit(data: TrainingData, options: dict) -> tuple[Head, DataFrame | None]:
        result = fit_blocks(
            data.blocks[_balanced(options)],
            data.n_features,
            loss,
            C=float(options.get("C", 1.0)),
            max_iter=int(options.get("max_iter", max_iter)),
        )
        rows = [(i, float(w)) for i, w in enumerate(result.coefficients)]
        table = data.features.sparkSession.createDataFrame(rows, "term_id bigint, w double")
        head = Head(
            name, score_type, result.bias, None, result.iterations, result.relative_gradient,
            result.converged,
        )
        return head, table

    return fit


# Name -> function from (training data, options) to head and coefficients per term.
REGISTRY: dict[str, Callable[[TrainingData, dict], tuple[Head, DataFrame | None]]] = {
    "dummy": _fit_dummy,
    "logistic_regression": _linear("logistic_regression", "log", PROBABILITY, 1000),
    "linear_svc": _linear("linear_svc", "squared_hinge", MARGIN, 5000),
    "complement_nb": _fit_complement_nb,
}
LINEAR = ["logistic_regression", "linear_svc"]

# The loss of each model that an optimiser fits.
LOSS_OF = {"logistic_regression": "log", "linear_svc": "squared_hinge"}


def training_features(
    train: DataFrame, vocab: DataFrame, params: TfidfParams, key: str = KEY, text: str = TEXT
) -> DataFrame:
    """(key, label, indices, values), with empty arrays for documents without known terms."""
    return document_weights(train, vocab, params, text, [key, LABEL])


def fit_models(
    train: DataFrame,
    names: list[str] | None = None,
    params: TfidfParams = TfidfParams(),
    options: dict[str, dict] | None = None,
    key: str = KEY,
    text: str = TEXT,
) -> FittedModels:
    """Fit the named models on one shared feature table. ``train`` has key, text, label and
    should be a stored table, as it is read more than once."""
    names = names or MODEL_NAMES
    unknown = sorted(set(names) - set(REGISTRY))
    if unknown:
        raise ValueError(f"unsupported models: {unknown}")
    vocab = cut_lineage(vocabulary(train, params, text))
    features = cut_lineage(training_features(train, vocab, params, key, text))
    data = TrainingData(features, vocab.count())
    options = {name: (options or {}).get(name, {}) for name in names}
    for balanced in {_balanced(options[name]) for name in names if name in LINEAR}:
        data.blocks[balanced] = training_blocks(features, balanced)
    try:
        # The fits are driver loops around many short jobs, which share the cluster.
        with ThreadPoolExecutor(len(names)) as pool:
            fits = list(pool.map(lambda name: REGISTRY[name](data, options[name]), names))
    finally:
        for blocks in data.blocks.values():
            blocks.unpersist()

    terms = vocab.select("term", "term_id", "idf")
    for name, (_, coefficients) in zip(names, fits):
        if coefficients is not None:
            terms = terms.join(
                coefficients.withColumnRenamed("w", f"w_{name}"), "term_id", "left"
            )
    return FittedModels(cut_lineage(terms), [head for head, _ in fits], params)


# ---- optimality ------------------------------------------------------------------------


def _objectives(train: DataFrame, models: FittedModels, options: dict | None, text: str):
    """The terms in the order of the weights, and (head, point, value and gradient there, value
    and gradient at zero, training rows) of each linear model of ``models``."""
    vocab = models.terms.orderBy("term_id").collect()
    features = cut_lineage(document_weights(train, models.terms, models.params, text, [LABEL]))
    rows, found, blocks = features.count(), [], {}
    try:
        for head in models.heads:
            if head.model not in LINEAR:
                continue
            given = (options or {}).get(head.model, {})
            balanced, c = _balanced(given), float(given.get("C", 1.0))
            if balanced not in blocks:
                blocks[balanced] = training_blocks(features, balanced)
            weights = [r[f"w_{head.model}"] for r in vocab]
            point = np.array([*weights, head.intercept], np.float64)
            at = [
                objective_at(blocks[balanced], x, LOSS_OF[head.model], c)
                for x in (point, np.zeros_like(point))
            ]
            found.append((head, point, *at, rows))
    finally:
        for each in blocks.values():
            each.unpersist()
    return [r["term"] for r in vocab], found


def objective_table(
    train: DataFrame, models: FittedModels, options: dict | None = None, text: str = TEXT
) -> DataFrame:
    """What the optimiser sees where ``models`` stand, fitted or not: model, part ('objective',
    'bias' or 'weight'), term (null but for weights) and value; those of bias and weights are
    the slopes of the objective. ``terms`` of the models must number the vocabulary from 0."""
    terms, found = _objectives(train, models, options, text)
    rows = []
    for head, _, (value, gradient), _, _ in found:
        rows += [(head.model, "objective", None, value), (head.model, "bias", None, float(gradient[-1]))]
        rows += [(head.model, "weight", t, float(g)) for t, g in zip(terms, gradient)]
    return train.sparkSession.createDataFrame(
        rows, "model string, part string, term string, value double"
    )


def certificates(
    train: DataFrame, models: FittedModels, options: dict | None = None, text: str = TEXT
) -> DataFrame:
    """How near each linear model is to the one optimum of its objective, from a fresh pass over
    the training rows. The penalty bends the objective by at least 1 in every direction, so at
    a gradient g the value is at most |g|^2 / 2 above the least (``gap_bound``), and weights and
    bias lie within |g| of the optimum (``distance_bound``). ``relative_gradient`` is |g| as a
    share of the gradient at zero, as in the head."""
    rows = []
    for head, _, (value, gradient), (zero, steepest), n in _objectives(train, models, options, text)[1]:
        size = float(np.linalg.norm(gradient))
        unit = max(1e-12, float(np.linalg.norm(steepest)))
        rows.append((head.model, n, value, zero, size / unit, size * size / 2, size, head.converged))
    return train.sparkSession.createDataFrame(
        rows,
        "model string, rows bigint, objective double, objective_at_zero double, "
        "relative_gradient double, gap_bound double, distance_bound double, converged boolean",
    )


# ---- scoring ---------------------------------------------------------------------------


def margins(
    df: DataFrame, models: FittedModels, key: str = KEY, text: str = TEXT,
    keep: list[str] | None = None,
) -> DataFrame:
    """key, kept columns and ``margin_<model>`` per non-constant model, a row per row of
    ``df``, in one map over its texts; documents without known terms get the intercept.

    Margins are rounded to 12 digits; a text's terms are added up in term order."""
    linear = [h for h in models.heads if h.constant is None]
    columns = [f"w_{h.model}" for h in linear]
    carried = list(dict.fromkeys([key, *(keep or [])]))
    sums = document_sums(df, models.terms, columns, models.params, text, carried)
    return sums.select(
        *carried,
        *[
            F.round(F.col(free_name(carried, c)) + F.lit(h.intercept), 12).alias(f"margin_{h.model}")
            for h, c in zip(linear, columns)
        ],
    )


def predictions(
    df: DataFrame, models: FittedModels, key: str = KEY, text: str = TEXT,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document and model: key, kept columns, model, prediction, score,
    score_type. A score is the probability of label 1 if the model has one, else its
    margin."""
    if all(h.constant is not None for h in models.heads):
        base = df.select(key, *(keep or []))
    else:
        base = margins(df, models, key, text, keep)
    results = []
    for head in models.heads:
        if head.constant is not None:
            prediction, score = F.lit(head.constant), F.lit(float(head.constant))
        else:
            margin = F.col(f"margin_{head.model}")
            prediction = (margin > 0).cast("int")
            score = sigmoid(margin) if head.score_type == PROBABILITY else margin
        results.append(
            F.struct(
                F.lit(head.model).alias("model"),
                prediction.cast("bigint").alias("prediction"),
                score.alias("score"),
                F.lit(head.score_type).alias("score_type"),
            )
        )
    return base.select(key, *(keep or []), F.inline(F.array(*results)))


# ---- storage ---------------------------------------------------------------------------

HEAD_COLUMNS = (
    "position int, model string, score_type string, intercept double, constant int, "
    "iterations int, relative_gradient double, converged boolean"
)


def save_models(models: FittedModels, path: str) -> None:
    """Term table as Parquet, heads and parameters as JSON rows."""
    spark = models.terms.sparkSession
    models.terms.write.mode("overwrite").parquet(f"{path}/terms")
    heads = spark.createDataFrame(
        [(i, *asdict(head).values()) for i, head in enumerate(models.heads)], HEAD_COLUMNS
    )
    heads.coalesce(1).write.mode("overwrite").json(f"{path}/heads")
    values = asdict(models.params)
    values["ngram_range"] = list(values["ngram_range"])
    spark.createDataFrame(
        [values],
        "max_features int, ngram_range array<int>, min_df int, max_df double, "
        "lowercase boolean, strip_accents boolean",
    ).coalesce(1).write.mode("overwrite").json(f"{path}/params")


def load_models(spark: SparkSession, path: str) -> FittedModels:
    heads = (
        spark.read.schema(HEAD_COLUMNS)
        .json(f"{path}/heads")
        .orderBy("position")
        .collect()
    )
    params = spark.read.json(f"{path}/params").first().asDict()
    params["ngram_range"] = tuple(params["ngram_range"])
    return FittedModels(
        spark.read.parquet(f"{path}/terms"),
        [Head(*h[1:]) for h in heads],
        TfidfParams(**params),
    )
