import random

import pytest
from pyspark.sql import functions as F

from labeltext.operators import metrics


def table(spark, labels, predictions, scores=None):
    scores = scores or [None] * len(labels)
    rows = [("m", "val", i, y, p, s) for i, (y, p, s) in enumerate(zip(labels, predictions, scores))]
    return spark.createDataFrame(
        rows, "model string, split string, raw_index bigint, label bigint, prediction bigint, "
        "score double"
    )


BY = ["model", "split"]


def test_known_confusion(spark):
    row = metrics.classification_report(
        table(spark, [1, 1, 1, 0, 0], [1, 0, 1, 1, 0]), BY
    ).first()
    assert (row["true_positive"], row["false_negative"], row["false_positive"]) == (2, 1, 1)
    assert row["f2"] == pytest.approx(2 / 3)
    assert row["false_negative_rate"] == pytest.approx(1 / 3)


def test_zero_division_and_other_positive(spark):
    row = metrics.classification_report(table(spark, [1, 0], [0, 0]), BY).first()
    assert row["precision"] == row["f1"] == row["f2"] == 0
    df = table(spark, [1, 1, 0, 0, 0], [1, 0, 0, 0, 1])
    row = metrics.classification_report(df, BY, positive_label=0).first()
    assert row["precision"] == pytest.approx(2 / 3) and row["recall"] == pytest.approx(2 / 3)
    assert row["true_positive"] == 1 and row["false_negative_rate"] == pytest.approx(0.5)


def test_ranking_with_ties(spark):
    scores = [0.9, 0.8, 0.8, 0.4, 0.3, 0.1, 0.1]
    df = table(spark, [1, 0, 1, 1, 0, 0, 1], [0] * 7, scores)
    row = metrics.full_report(df, BY).first()
    assert row["roc_auc"] == pytest.approx(0.666667, abs=1e-6)
    assert row["average_precision"] == pytest.approx(0.747024, abs=1e-6)


def test_ranking_equals_quadratic_definition(spark):
    rng = random.Random(5)
    labels = [rng.randint(0, 1) for _ in range(600)]
    scores = [round(rng.gauss(y * 0.5, 1), 1) if rng.random() < 0.7 else 0.0 for y in labels]
    row = metrics.full_report(table(spark, labels, [0] * 600, scores).repartition(5), BY).first()
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert row["roc_auc"] == pytest.approx(auc)
    ap, last = 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        hit = sum(s >= t for s in pos)
        every = hit + sum(s >= t for s in neg)
        ap += (hit / len(pos) - last) * hit / every
        last = hit / len(pos)
    assert row["average_precision"] == pytest.approx(ap)


def test_single_class(spark):
    row = metrics.full_report(table(spark, [0, 0], [0, 0], [0.1, 0.2]), BY).first()
    assert row["roc_auc"] is None and row["average_precision"] == 0
    row = metrics.full_report(table(spark, [0, 1], [0, 0]), BY).first()
    assert row["roc_auc"] is None


def test_slices_by_source(spark):
    rows = [("a", 1, 0), ("a", 1, 1), ("b", 0, 1), (None, 1, 0), (None, 1, 0)]
    df = spark.createDataFrame(rows, "source string, label bigint, prediction bigint")
    out = {r["source"]: r for r in metrics.stats_by_source(df).collect()}
    assert out["a"]["recall"] == 0.5 and out["a"]["false_negative_rate"] == 0.5
    assert out["b"]["recall"] is None and out["b"]["false_positives"] == 1
    assert out[None]["rows"] == 2 and out[None]["recall"] == 0
    assert metrics.stats_by_source(df).first()["source"] is None


def test_error_slices(spark):
    df = table(spark, [1] * 10 + [0], [0] * 10 + [1], [0.1] * 11)
    out = metrics.error_slices(df, BY).orderBy("error", "position").collect()
    assert [r["raw_index"] for r in out] == [0, 1, 2, 3, 4, 10]


def test_comparison_best_and_delta(spark):
    rows = [("a", "val", 0.5), ("b", "val", 0.7), ("c", "val", 0.7), ("a", "test", 0.1),
            ("b", "test", 0.2), ("c", "test", 0.3)]
    report = spark.createDataFrame(rows, "model string, split string, f2 double")
    assert [r["model"] for r in metrics.model_comparison(report).collect()] == ["b", "c", "a"]
    assert metrics.best_model(report, order=["a", "c", "b"]).first()["best_model"] == "c"
    val = report.where("split = 'val'")
    delta = metrics.metric_delta(val.where("model <> 'a'"),
                                 report.where("split = 'test' and model <> 'c'"), ["f2"])
    assert [tuple(r) for r in delta.collect()] == [("b", -0.5)]
    pivot = metrics.metric_pivot({"p1": val.where("model = 'a'"), "p2": val}, "f2")
    assert {r["model"]: (r["p1"], r["p2"]) for r in pivot.collect()} == {
        "a": (0.5, 0.5), "b": (None, 0.7), "c": (None, 0.7),
    }


def test_run_metrics(spark):
    df = table(spark, [1, 0], [1, 0], [0.9, 0.2])
    out = metrics.run_metrics(metrics.full_report(df, BY), df, "r1").collect()
    values = {(r["model"], r["metric"]): r["value"] for r in out}
    assert values[("m", "val_f2")] == 1 and values[("m", "val_roc_auc")] == 1
    assert values[(None, "val_rows")] == 2 and values[(None, "val_label_1")] == 1
    assert len(values) == 16


def test_latency_summary(spark):
    df = spark.createDataFrame([(float(i), i == 3) for i in range(1, 11)], "ms double, bad boolean")
    row = metrics.latency_summary(df, "ms", F.col("bad")).first()
    assert (row["requests"], row["failures"]) == (10, 1)
    assert row["mean_latency_ms"] == 5.5 and row["p95_latency_ms"] == 10


def test_latest_children(spark):
    rows = [("p1", None, "train", "FINISHED", 1), ("p2", None, "train", "FINISHED", 2),
            ("p3", None, "train", "FAILED", 3), ("c1", "p1", "x", "FINISHED", 1),
            ("c2", "p2", "y", "FINISHED", 2), ("c3", "p2", "x", "FAILED", 2)]
    runs = spark.createDataFrame(
        rows, "run_id string, parent_id string, name string, status string, start_time long"
    )
    assert [r["run_id"] for r in metrics.latest_children(runs).collect()] == ["c3", "c2"]


def test_requests_without_latency_count(spark):
    log = spark.createDataFrame(
        [(10.0, False), (30.0, True), (None, True), (None, False)], "ms double, bad boolean"
    )
    row = metrics.latency_summary(log, "ms", F.col("bad")).first()
    assert (row["requests"], row["failures"], row["mean_latency_ms"]) == (4, 2, 20.0)
