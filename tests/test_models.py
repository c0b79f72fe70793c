import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labeltext.functions import batches
from labeltext.functions.text import fold_accents
from labeltext.operators import features, linear
from labeltext.operators.classifiers import (
    FittedModels,
    Head,
    certificates,
    fit_models,
    load_models,
    majority_label,
    objective_table,
    predictions,
    save_models,
)
from labeltext.operators.features import TfidfParams
from labeltext.operators.linear import fit_linear
from labeltext.plans.scoring import respond, score_table, screen
from labeltext.plans.training import (
    evaluate,
    fit_outcome,
    run_models,
    run_predictions,
    scoring_throughput,
    sweep,
    train_and_compare,
)
from labeltext.sources.model_store import load_published, publish, published

TEXTS = [
    ("win money now click link", 1), ("click here to win prize money", 1),
    ("free prize click now", 1), ("meeting agenda for monday", 0),
    ("lunch on monday with team", 0), ("project agenda and notes", 0),
    ("team notes from the meeting", 0), ("Éclair recipe notes", 0), ("!", 0),
    ("money money prize", 1),
]
PARAMS = TfidfParams(max_features=100, min_df=1, max_df=1.0)


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "raw_index bigint, text_combined string, label bigint")


def matrix(params=PARAMS, texts=TEXTS):
    """The same features with plain Python, as (terms, dense matrix)."""
    docs = []
    for text, _ in texts:
        words = re.findall(r"(?u)\b\w\w+\b", text.lower().replace("é", "e"))
        grams = [" ".join(words[i : i + n]) for n in range(params.ngram_range[0], params.ngram_range[1] + 1)
                 for i in range(len(words) - n + 1)]
        docs.append(Counter(grams))
    df, tf = Counter(), Counter()
    for d in docs:
        df.update(d.keys())
        tf.update(d)
    kept = [t for t in df if params.min_df <= df[t] <= params.max_df * len(docs)]
    kept = sorted(sorted(kept, key=lambda t: (-tf[t], t))[: params.max_features])
    x = np.zeros((len(docs), len(kept)))
    for i, d in enumerate(docs):
        for j, t in enumerate(kept):
            if d[t]:
                x[i, j] = (1 + math.log(d[t])) * (math.log((1 + len(docs)) / (1 + df[t])) + 1)
        norm = np.linalg.norm(x[i])
        x[i] /= norm if norm else 1
    return kept, x


@pytest.mark.parametrize(
    "params",
    [PARAMS, TfidfParams(max_features=12, min_df=1, max_df=1.0), TfidfParams(min_df=2, max_df=0.35),
     TfidfParams(ngram_range=(1, 3), min_df=1, max_df=1.0)],
)
def test_features_equal_python(train, params):
    kept, x = matrix(params)
    vocab = features.vocabulary(train, params)
    assert [r["term"] for r in vocab.orderBy("term_id").collect()] == kept
    found = np.zeros_like(x)
    for r in features.tfidf_weights(train, vocab, params).collect():
        found[r["raw_index"], r["term_id"]] = r["weight"]
    assert np.allclose(found, x, atol=1e-12)


def test_empty_vocabulary(spark):
    df = spark.createDataFrame([(0, "aa", 0), (1, "bb", 1)],
                               "raw_index bigint, text_combined string, label bigint")
    vocab = features.vocabulary(df)
    assert vocab.isEmpty() and features.tfidf_weights(df, vocab).isEmpty()


def test_vectors_feed_spark_ml(train):
    from pyspark.ml.classification import NaiveBayes

    from labeltext.operators.classifiers import training_features

    kept, x = matrix()
    vocab = features.vocabulary(train, PARAMS)
    arrays = training_features(train, vocab, PARAMS)
    vectors = features.feature_vectors(arrays, len(kept)).orderBy("raw_index")
    assert np.allclose([r["features"].toArray() for r in vectors.collect()], x, atol=1e-12)
    model = NaiveBayes(modelType="complement", smoothing=0.5).fit(vectors)
    ours = predictions(train, fit_models(train, ["complement_nb"], PARAMS)).orderBy("raw_index")
    theirs = model.transform(vectors).orderBy("raw_index").collect()
    filled = [bool(r["features"].numNonzeros()) for r in theirs]
    pairs = [(int(t["prediction"]), o["prediction"]) for t, o in zip(theirs, ours.collect())]
    assert all(a == b for (a, b), f in zip(pairs, filled) if f)


def test_majority_and_unknown_model(spark, train):
    assert majority_label(train).first()[0] == 0
    even = spark.createDataFrame([(1,), (0,)], "label bigint")
    assert majority_label(even).first()[0] == 0
    with pytest.raises(ValueError, match="unsupported"):
        fit_models(train, ["forest"])


@pytest.mark.parametrize("loss", ["log", "squared_hinge"])
def test_linear_fit_reaches_the_optimum(spark, loss):
    """Against plain gradient descent on the dense problem with a penalised bias."""
    rng = np.random.default_rng(6)
    x = rng.random((40, 5)) * (rng.random((40, 5)) < 0.6)
    y = np.where(x[:, 0] + 0.3 * rng.standard_normal(40) > 0.3, 1.0, -1.0)
    rows = [([int(j) for j in np.flatnonzero(r)], [float(v) for v in r[r != 0]], int(s > 0))
            for r, s in zip(x, y)]
    df = spark.createDataFrame(rows, "indices array<int>, values array<double>, label bigint")
    w, b = fit_linear(df.repartition(3), 5, loss, C=2.0, tolerance=1e-9)
    weight = np.where(y > 0, 40 / (2 * (y > 0).sum()), 40 / (2 * (y < 0).sum())) * 2.0
    full, point = np.hstack([x, np.ones((40, 1))]), np.zeros(6)
    for _ in range(60000):
        margin = y * (full @ point)
        slope = -1 / (1 + np.exp(margin)) if loss == "log" else -2 * np.maximum(0, 1 - margin)
        point = point - 0.002 * (point + full.T @ (weight * y * slope))
    assert np.allclose(np.append(w, b), point, atol=1e-4)


def test_certificates_prove_the_fit(train):
    options = {"linear_svc": {"C": 2.0, "class_weight": None}}
    models = fit_models(train, ["logistic_regression", "linear_svc", "complement_nb"], PARAMS, options)
    found = {r["model"]: r for r in certificates(train, models, options).collect()}
    assert set(found) == {"logistic_regression", "linear_svc"}
    n = train.count()
    assert np.isclose(found["logistic_regression"]["objective_at_zero"], n * np.log(2))
    assert np.isclose(found["linear_svc"]["objective_at_zero"], 2.0 * n)
    for head in models.heads[:2]:
        row = found[head.model]
        assert np.isclose(row["relative_gradient"], head.relative_gradient) and row["rows"] == n
        assert np.isclose(row["gap_bound"], row["distance_bound"] ** 2 / 2)
    # A small step away costs more than the bound allows the fit to be off.
    moved = [Head(**{**vars(h), "intercept": h.intercept + 0.5}) for h in models.heads]
    worse = certificates(train, FittedModels(models.terms, moved, PARAMS), options).collect()
    for row in worse:
        best = found[row["model"]]
        assert row["objective"] >= best["objective"] - best["gap_bound"] + 0.125 - 0.5 * best["distance_bound"]
        assert row["distance_bound"] >= 0.5 - best["distance_bound"]
    # The slopes agree with differences of the objective.
    table = {(r["model"], r["part"], r["term"]): r["value"]
             for r in objective_table(train, FittedModels(models.terms, moved, PARAMS), options).collect()}
    near = [Head(**{**vars(h), "intercept": h.intercept + 1e-5}) for h in moved]
    after = {(r["model"], r["part"]): r["value"]
             for r in objective_table(train, FittedModels(models.terms, near, PARAMS), options).collect()}
    for name in found:
        step = (after[name, "objective"] - table[name, "objective", None]) / 1e-5
        assert np.isclose(step, table[name, "bias", None], rtol=1e-3, atol=1e-3)


def test_an_unfinished_fit_says_so(train):
    options = {"logistic_regression": {"max_iter": 1}}
    names = ["logistic_regression", "linear_svc", "dummy"]
    models = fit_models(train, names, PARAMS, options)
    short, full, constant = models.heads
    assert not short.converged and short.iterations == 1 and short.relative_gradient > 1e-4
    assert full.converged and full.iterations > 1 and full.relative_gradient <= 1e-4
    assert constant.converged and constant.iterations == 0
    outcome = {(r["model"], r["metric"]): r["value"] for r in fit_outcome(models, "r").collect()}
    assert outcome["logistic_regression", "converged"] == 0.0
    assert outcome["linear_svc", "converged"] == 1.0 and len(outcome) == 9


def test_the_version_names_the_model_that_scored(spark, train):
    models = fit_models(train, ["dummy", "complement_nb"], PARAMS)
    messages = screen(spark.createDataFrame([("m", "a text that is long enough")], "k string, text string"))
    versions = {r["model"]: r["model_version"] for r in respond(messages, models, "k").collect()}
    assert versions == {"dummy": "phase2_dummy", "complement_nb": "phase2_complement_nb"}
    given = respond(messages, models, "k", "v7").select("model_version").distinct().collect()
    assert [r[0] for r in given] == ["v7"]


def test_complement_nb_equals_formula(train):
    models = fit_models(train, ["complement_nb", "dummy"], PARAMS)
    kept, x = matrix()
    y = np.array([label for _, label in TEXTS])
    counts = np.array([x[y == c].sum(axis=0) for c in (0, 1)])
    rest = counts.sum(axis=0) + 0.5 - counts
    logs = -np.log(rest / rest.sum(axis=1, keepdims=True))
    joint = x @ logs.T
    expected = 1 / (1 + np.exp(joint[:, 0] - joint[:, 1]))
    out = predictions(train, models).where("model = 'complement_nb'").orderBy("raw_index").collect()
    assert np.allclose([r["score"] for r in out], expected, atol=1e-9)
    assert [r["prediction"] for r in out] == (joint[:, 1] > joint[:, 0]).astype(int).tolist()
    constant = predictions(train, models.only("dummy")).collect()
    assert {(r["prediction"], r["score"], r["score_type"]) for r in constant} == {(0, 0.0, "probability")}


@pytest.fixture(scope="module")
def all_models(train):
    return fit_models(train, params=PARAMS)


def test_saved_models_score_the_same(spark, train, all_models, tmp_path):
    save_models(all_models, str(tmp_path / "m"))
    loaded = load_models(spark, str(tmp_path / "m"))
    assert loaded.params == PARAMS
    first = sorted(map(tuple, predictions(train, all_models).collect()))
    assert sorted(map(tuple, predictions(train, loaded).collect())) == first
    assert len(first) == 4 * len(TEXTS)


def test_the_store_serves_the_best_complete_version(spark, train, all_models, tmp_path):
    store = str(tmp_path / "store")
    first = publish(all_models.only("complement_nb"), store, 0.7)
    best = publish(all_models.only("logistic_regression"), store, 0.9)
    publish(all_models.only("dummy"), store, 0.9, "recall")
    publish(all_models.only("dummy"), store, float("nan"))
    # A version without a manifest row, as a failed publication leaves it, is not seen.
    save_models(all_models, f"{store}/versions/unfinished")
    assert published(spark, store).count() == 4
    assert [h.model for h in load_published(spark, store).heads] == ["logistic_regression"]
    assert [h.model for h in load_published(spark, store, first).heads] == ["complement_nb"]
    assert [h.model for h in load_published(spark, store, metric="recall").heads] == ["dummy"]
    again = predictions(train, load_published(spark, store, best)).collect()
    assert sorted(again) == sorted(predictions(train, all_models.only("logistic_regression")).collect())
    with pytest.raises(ValueError, match="nothing published"):
        load_published(spark, store, "unfinished")


def test_score_types_and_learning(train, all_models):
    out = predictions(train, all_models, keep=["label"]).collect()
    kinds = {r["model"]: r["score_type"] for r in out}
    assert kinds["linear_svc"] == "decision_function"
    assert kinds["logistic_regression"] == "probability"
    for name in ("linear_svc", "logistic_regression"):
        assert all(r["prediction"] == r["label"] for r in out if r["model"] == name)


def test_train_and_compare(spark, train):
    rows = [(i * 3 + j, t, y, s) for i, (t, y) in enumerate(TEXTS)
            for j, s in enumerate(("train", "val", "test"))]
    splits = spark.createDataFrame(
        rows, "raw_index bigint, text_combined string, label bigint, split string"
    )
    run = train_and_compare(splits, params=PARAMS)
    assert run.best == "logistic_regression"
    assert run.report.count() == 8 and run.predictions.count() == 80
    report = evaluate(run.models.only(run.best), {"phase3_holdout": train})
    assert report.first()["rows"] == len(TEXTS) and report.first()["f2"] == 1
    path = f"{spark.conf.get('spark.checkpoint.dir')}/sweep-test"
    runs = [{"name": "one", "max_features": 50, "ngram_range": (1, 1), "C": 1.0, "min_df": 1},
            {"name": "two", "max_features": 20, "ngram_range": (1, 3), "C": 0.5, "min_df": 1}]
    kept = f"{path}-artifacts"
    out = sweep(splits, path, runs, ["dummy", "complement_nb"], kept)
    assert {r["run_id"] for r in out.select("run_id").distinct().collect()} == {"one", "two"}
    found = run_predictions(spark, kept)
    assert "PartitionFilters: [isnotnull(run" in found.where("run = 'two'")._jdf.queryExecution().toString()
    rest = splits.where("split != 'train'")
    for run in runs:
        models = run_models(spark, kept, run["name"])
        assert models.params.max_features == run["max_features"]
        assert models.params.ngram_range == run["ngram_range"] and len(models.heads) == 2
        again = predictions(rest, models, keep=["split", "label"])
        stored = found.where(F.col("run") == run["name"]).select(*again.columns)
        assert sorted(again.collect()) == sorted(stored.collect()) and stored.count() > 0


def test_throughput_batches(train, all_models):
    size = train.count()
    out = scoring_throughput(train, all_models.only("dummy"), [size + 7, 2], 1).collect()
    assert {r["batch_size"]: r["repeat"] for r in out} == {size: 1, 2: 1}
    for row in out:
        assert np.isclose(row["records_per_second"] * row["elapsed_seconds"], row["batch_size"])
        assert np.isclose(row["milliseconds_per_record"] * row["records_per_second"], 1000)
    assert not scoring_throughput(train.where("false"), all_models, [5], 2).collect()


def test_respond_and_score_table(spark, train, all_models):
    df = spark.createDataFrame(
        [("a", "  CLICK   Money  "), ("b", "   "), ("c", "ab"), ("d", "x" * 50001), ("e", None),
         ("f", ""), ("g", "Team meeting")],
        "id string, text string",
    )
    screened = screen(df)
    reasons = {r["id"]: r["reject_reason"] for r in screened.collect()}
    assert reasons == {"a": None, "b": "blank", "c": "too_short", "d": "too_long", "e": "missing",
                       "f": "empty", "g": None}
    out = {r["id"]: r for r in respond(screened.where("reject_reason is null"),
                                       all_models.only("linear_svc"), "id").collect()}
    assert out["a"]["label"] == "phishing" and out["a"]["is_phishing"]
    assert out["a"]["normalized_text_length"] == len("click money")
    assert out["a"]["score_type"] == "decision_function"
    assert out["g"]["label"] == "legitimate" and out["g"]["verdict"] == "Legitimate"
    table = score_table(train, all_models.only("linear_svc"), "raw_index")
    assert {"raw_index", "text_combined", "label", "prediction", "score"} <= set(table.columns)
    with pytest.raises(ValueError):
        score_table(df.drop("text"), all_models, "id")


def test_repeated_and_null_keys_are_scored_by_their_own_text(train, all_models):
    rows = predictions(train, all_models, keep=["text_combined"]).where("model <> 'dummy'")
    want = {(r["text_combined"], r["model"]): r["score"] for r in rows.collect()}
    for key in ("cast(null as bigint)", "cast(1 as bigint)"):
        same = train.selectExpr(f"{key} as raw_index", "text_combined", "label")
        got = predictions(same, all_models, keep=["text_combined"]).where("model <> 'dummy'")
        assert {(r["text_combined"], r["model"]): r["score"] for r in got.collect()} == want


def test_scoring_moves_no_row(spark, train):
    models = fit_models(train, ["complement_nb", "linear_svc"], PARAMS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        arriving = train.union(train).select("raw_index", "text_combined").coalesce(1)
        for scored in (
            score_table(arriving, models, "raw_index"),
            features.tfidf_weights(arriving, models.terms, PARAMS),
        ):
            plan = scored._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Join" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_row_is_scored_alone(spark, train):
    models = fit_models(train, ["complement_nb"], PARAMS)
    rows = [(None, "prize money now"), (None, "team notes"), (4, "prize money now"), (4, None), (4, ""), (5, "zzz")]
    table = spark.createDataFrame(rows, "raw_index long, text_combined string").withColumn("_tokens", F.lit("x"))
    got = {(r[0], r[1]): r for r in score_table(table, models, "raw_index").select("raw_index", "text_combined", "score", "_tokens").collect()}
    assert set(got) == set(rows) and all(r["_tokens"] == "x" for r in got.values())
    assert got[None, "prize money now"]["score"] == got[4, "prize money now"]["score"] > 0.5
    assert got[None, "team notes"]["score"] < 0.5
    assert got[4, None]["score"] == got[4, ""]["score"] == got[5, "zzz"]["score"]


def test_tasks_hold_pieces_of_bounded_size(spark, monkeypatch):
    """However many rows a batch has, arrays of few tokens, bytes and ids are made of it."""
    assert list(batches.pieces(np.array([3, 0, 9, 1, 1, 1, 4]), 3)) == [(0, 2), (2, 3), (3, 6), (6, 7)]
    assert list(batches.pieces(np.array([], int), 3)) == []
    sizes, whole = [], features.Lookup.weights

    def seen(self, lists):
        sizes.append(len(lists.flatten()))
        return whole(self, lists)

    monkeypatch.setattr(features.Lookup, "weights", seen)
    monkeypatch.setattr(features, "PIECE_TOKENS", 100)
    lists = pa.array([["a", "b"] * (k % 30) for k in range(200)] + [None, []], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(202)), lists], ["key", "tokens"])
    vocab = spark.createDataFrame([("a", 0, 1.5), ("a b", 1, 2.0)], "term string, term_id long, idf double")
    lookup = features.Lookup(vocab)
    found = [lookup.weights(p.column(1)) for p in features._pieces(iter([batch]))]
    assert max(sizes) <= 100 and sum(sizes) == len(lists.flatten())
    want = whole(lookup, lists)
    for k in (1, 2):
        assert np.array_equal(np.concatenate([f[k] for f in found]), want[k])

    monkeypatch.setattr(linear, "BLOCK_VALUES", 100)
    rows = [(list(range(k % 30)), [1.0] * (k % 30), 1.0, 2.0) for k in range(200)]
    names = ["indices", "values", "sign", "weight"]
    table = pa.table({n: [r[k] for r in rows] for k, n in enumerate(names)}).combine_chunks()
    blocks = [b.to_pylist()[0] for b in linear._to_blocks(iter(table.to_batches()))]
    ids = [np.frombuffer(b["ids"], np.int32) for b in blocks]
    assert max(map(len, ids)) <= 100
    assert np.concatenate(ids).tolist() == [i for r in rows for i in r[0]]
    lengths = np.concatenate([np.diff(np.frombuffer(b["starts"], np.int64)) for b in blocks])
    assert lengths.tolist() == [k % 30 for k in range(200)]


def test_batches_end_at_bytes(spark, monkeypatch):
    """Long rows: a task is handed few of them at a time."""
    cut = features._pieces

    def seen(found):
        for batch in found:
            assert batch.nbytes < 2 * most, f"a batch of {batch.nbytes} bytes"
            yield from cut(iter([batch]))

    most = 1 << 23
    monkeypatch.setattr(features, "_pieces", seen)
    long = F.repeat(F.lit("prize money now "), 5_000)
    table = spark.range(600, numPartitions=1).select(
        F.col("id").alias("raw_index"), F.when(F.col("id") % 2 == 0, long).otherwise("team").alias("text_combined")
    )
    vocab = spark.createDataFrame([("prize", 0, 1.5, 2.0)], "term string, term_id long, idf double, w double")
    sums = features.document_sums(table, vocab, ["w"], keep=["raw_index", "text_combined"])
    assert dict(sums.groupBy("w").count().collect()) == {2.0: 300, 0.0: 300}
    weights = features.document_weights(table, vocab)
    assert weights.where(F.size("indices") == 1).count() == 300
    spark.conf.set(batches.BATCH_SETTING, "1m")
    assert batches.bounded(table) is table and spark.conf.get(batches.BATCH_SETTING) == "1m"
    spark.conf.unset(batches.BATCH_SETTING)
    sizes = batches.bounded(table).mapInArrow(
        lambda found: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in found), "n long"
    )
    assert 2 < sizes.count() < 10


def test_accents_fold_in_pieces(spark):
    long = "\u00e9t\u00e9 " * 400_000
    rows = [(0, long), (1, "na\u00efve"), (2, None), (3, "plain"), (4, ""), (5, long)]
    table = spark.createDataFrame(rows, "k int, t string").coalesce(1)
    got = dict(table.select("k", fold_accents(F.col("t"))).collect())
    assert got == {0: "ete " * 400_000, 1: "naive", 2: None, 3: "plain", 4: "", 5: "ete " * 400_000}
