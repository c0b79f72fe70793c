"""Linear classifiers with an L2 penalty on weights and bias, fitted as Spark jobs.

Minimises  0.5 * (|w|^2 + b^2) + C * sum_i s_i * loss(y_i * (w.x_i + b)),  y in {-1, 1}, with
the logistic loss or the squared hinge. The bias is a constant feature and penalised like
the others. (Spark ML's own linear estimators leave the bias free, and its LinearSVC has the
plain hinge loss.)

Rows become compact blocks once and stay cached. Each step of the optimiser is one job: every
partition adds up loss and gradient, partial sums are merged in a tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.functions.batches import bounded, pieces, releasing
from labeltext.schema import LABEL

LOSSES = ("log", "squared_hinge")
# Steps the optimiser remembers; the squared hinge needs a third of the jobs it needs with 10.
HISTORY = 50
# Gradients that are added up at a time.
MERGE_WIDTH = 64
# Numbers of a block at most; a row with more is a block of its own.
BLOCK_VALUES = 1 << 17
# Columns of a block and the type of the numbers in each buffer.
BLOCK = {
    "starts": np.int64, "ids": np.int32, "values": np.float64, "sign": np.float64,
    "weight": np.float64,
}


class Fit(NamedTuple):
    """A fitted model. ``relative_gradient`` is the gradient's length at the end as a share of
    that at zero; ``converged`` tells whether it shrank to the tolerance."""

    coefficients: np.ndarray
    bias: float
    iterations: int
    relative_gradient: float
    converged: bool


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of feature arrays -> rows of raw buffers (row starts, ids, values,
    signed labels, row weights), at most ``BLOCK_VALUES`` ids each."""
    for whole in batches:
        many = np.diff(np.asarray(whole.column(0).offsets, dtype=np.int64))
        for start, end in pieces(many, BLOCK_VALUES):
            batch = whole.slice(start, end - start)
            ids, values = batch.column(0), batch.column(1)
            starts = np.asarray(ids.offsets, dtype=np.int64)
            parts = (
                starts - starts[0],
                np.asarray(ids.flatten(), dtype=np.int32),
                np.asarray(values.flatten(), dtype=np.float64),
                np.asarray(batch.column(2), dtype=np.float64),
                np.asarray(batch.column(3), dtype=np.float64),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.tobytes()], pa.binary()) for p in parts],
                list(BLOCK),
            )


def _block_sums(blocks: Iterator[tuple], point: np.ndarray, loss: str):
    """Loss and gradient summed over the blocks of one partition."""
    total, gradient = 0.0, np.zeros_like(point)
    for block in blocks:
        starts, ids, values, sign, weight = (
            np.frombuffer(cell, kind) for cell, kind in zip(block, BLOCK.values())
        )
        owner = np.repeat(np.arange(len(sign)), np.diff(starts))
        dots = np.bincount(owner, values * point[ids], minlength=len(sign))
        margin = sign * (dots + point[-1])
        if loss == "log":
            total += float(weight @ np.logaddexp(0.0, -margin))
            slope = -weight * sign * np.exp(-np.logaddexp(0.0, margin))
        else:
            short = np.maximum(0.0, 1.0 - margin)
            total += float(weight @ (short * short))
            slope = -2.0 * weight * sign * short
        gradient[:-1] += np.bincount(ids, values * slope[owner], minlength=len(point) - 1)
        gradient[-1] += slope.sum()
    yield total, gradient


def _add(a, b):
    return a[0] + b[0], a[1] + b[1]


def _merged(sums: RDD) -> tuple[float, np.ndarray]:
    """Total of one pair per partition, added up in a tree of that width, so that neither a
    task nor the driver receives many more than ``MERGE_WIDTH`` gradients."""
    levels = math.ceil(math.log(max(sums.getNumPartitions(), 2), MERGE_WIDTH))
    return sums.treeReduce(_add, depth=levels)


def class_weights(df: DataFrame) -> dict[int, float]:
    """n / (2 * n_class) for both labels."""
    counts = df.agg(F.count_if(F.col(LABEL) == 0), F.count_if(F.col(LABEL) == 1)).first()
    if not min(counts):
        raise ValueError("both labels must occur in the training rows")
    return {label: sum(counts) / (2.0 * n) for label, n in enumerate(counts)}


def training_blocks(features: DataFrame, balanced: bool = True) -> RDD:
    """Cached blocks of the feature table, to be unpersisted by the caller. ``features`` has
    indices, values and label, one row per document; the arrays may be empty.

    An RDD, because each step of the optimiser runs array code over whole partitions and
    returns one pair per partition; a DataFrame job per step takes twice as long."""
    by_label = class_weights(features) if balanced else {0: 1.0, 1: 1.0}
    positive = F.col(LABEL) == 1
    blocks = bounded(features).select(
        "indices",
        "values",
        F.when(positive, 1.0).otherwise(-1.0).alias("sign"),
        F.when(positive, by_label[1]).otherwise(by_label[0]).alias("weight"),
    ).mapInArrow(releasing(_to_blocks), ", ".join(f"{name} binary" for name in BLOCK))
    return blocks.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


def objective_at(
    blocks: RDD, point: np.ndarray, loss: str, C: float = 1.0
) -> tuple[float, np.ndarray]:
    """The objective and its gradient at ``point``, the weights and then the bias: one job."""
    if loss not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}, choose from {LOSSES}")
    shared = blocks.context.broadcast(point)
    total, gradient = _merged(
        blocks.mapPartitions(lambda part: _block_sums(part, shared.value, loss))
    )
    shared.unpersist()
    return C * total + 0.5 * float(point @ point), C * gradient + point


def fit_blocks(
    blocks: RDD,
    n_features: int,
    loss: str,
    C: float = 1.0,
    max_iter: int = 1000,
    tolerance: float = 1e-4,
) -> Fit:
    """Fit one loss, for at most ``max_iter`` steps."""
    def objective(point: np.ndarray) -> tuple[float, np.ndarray]:
        return objective_at(blocks, point, loss, C)

    start = np.zeros(n_features + 1)
    point, steps, shrunk = _minimize(objective, start, max_iter, tolerance)
    return Fit(point[:-1], float(point[-1]), steps, shrunk, shrunk <= tolerance)


def fit_linear(
    features: DataFrame, n_features: int, loss: str, balanced: bool = True, **options
) -> tuple[np.ndarray, float]:
    """Coefficients and bias for one feature table."""
    blocks = training_blocks(features, balanced)
    try:
        fit = fit_blocks(blocks, n_features, loss, **options)
        return fit.coefficients, fit.bias
    finally:
        blocks.unpersist()


def _minimize(
    objective, point: np.ndarray, max_iter: int, tolerance: float
) -> tuple[np.ndarray, int, float]:
    """Limited-memory BFGS with step halving, until the gradient has shrunk by ``tolerance``.
    Also returns the steps taken and how far the gradient has shrunk: after ``max_iter``
    steps, or where no step lowers the value, the fit ends unfinished."""
    value, gradient = objective(point)
    unit = max(1e-12, float(np.linalg.norm(gradient)))
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    taken = 0
    while taken < max_iter and np.linalg.norm(gradient) > tolerance * unit:
        direction = _two_loop(gradient, steps)
        slope = float(gradient @ direction)
        size = 1.0 if steps else 1.0 / max(1.0, float(np.linalg.norm(gradient)))
        for _ in range(40):
            trial = point + size * direction
            trial_value, trial_gradient = objective(trial)
            if trial_value <= value + 1e-4 * size * slope:
                break
            size *= 0.5
        else:
            break
        moved, turned = trial - point, trial_gradient - gradient
        if float(moved @ turned) > 1e-12 * float(turned @ turned):
            steps = [*steps, (moved, turned)][-HISTORY:]
        point, value, gradient = trial, trial_value, trial_gradient
        taken += 1
    return point, taken, float(np.linalg.norm(gradient)) / unit


def _two_loop(gradient: np.ndarray, steps) -> np.ndarray:
    """Descent direction from the remembered steps."""
    q, kept = gradient.copy(), []
    for moved, turned in reversed(steps):
        rho = 1.0 / float(turned @ moved)
        alpha = rho * float(moved @ q)
        q -= alpha * turned
        kept.append((moved, turned, rho, alpha))
    if steps:
        moved, turned = steps[-1]
        q *= float(moved @ turned) / float(turned @ turned)
    for moved, turned, rho, alpha in reversed(kept):
        q += (alpha - rho * float(turned @ q)) * moved
    return -q
