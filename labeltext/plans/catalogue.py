"""Every operator as a named query over the given tables: ``name(spark, folder)``.

The corpus is ``documents`` joined with ``labels`` on doc_id: text, source, and ``toxic`` as
label. The reference slice is the first phase of the corpus, the current one the second.
Floating results are rounded, so that the order of additions does not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labeltext.functions.scoring import MARGIN, PROBABILITY, confidence_text
from labeltext.functions.text import clean_text, normalize_label
from labeltext.operators import counts, drift, features, metrics, prepare, ranking, sampling
from labeltext.operators.classifiers import (
    LINEAR,
    FittedModels,
    Head,
    certificates,
    complement_nb,
    fit_models,
    majority_label,
    objective_table,
    predictions,
)
from labeltext.operators.manifest import label_by_source, number_blocks, source_manifest
from labeltext.operators.sampling import HOLDOUT, PHASE1, PHASE2
from labeltext.plans import preparation, scoring, training
from labeltext.plans.drift_report import drift_report
from labeltext.schema import KEY, LABEL, MAX_FEATURES, MIN_TEXT_LENGTH, SEED, SOURCE, TEXT
from labeltext.session import checkpoint_dir, cut_lineage
from labeltext.sources.files import jsonl_view
from labeltext.sources.model_store import load_published, published
from labeltext.sources.tables import corpus, manifest, read_table
from labeltext.streaming.jobs import answered, drift_stream, read_messages, score_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = ["length_rule", "digit_rule", "upper_rule"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- inputs ----------------------------------------------------------------------------


def digested(min_length: int = MIN_TEXT_LENGTH) -> dict[str, Column]:
    """Of a text only its digest, taken before the label join."""
    return {prepare.DIGEST: prepare.text_digest(F.col("text"), min_length)}


def phased(spark: SparkSession, folder: str, columns: dict[str, Column] | None = None) -> DataFrame:
    return sampling.phase_partition(corpus(spark, folder, columns))


def sliced(spark: SparkSession, folder: str, columns: dict[str, Column] | None = None) -> DataFrame:
    """The first two phases, tagged ``slice``."""
    both = sampling.phase_rows(phased(spark, folder, columns), sampling.SAMPLE)
    return both.withColumnRenamed("phase", "slice")


def lengths_by_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per slice and length. Lengths are taken before the label join."""
    size = F.length("text").cast("bigint")
    return (
        sliced(spark, folder, {drift.LENGTH: size})
        .groupBy("slice", drift.LENGTH)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of three fixed rules for every labelled document, with its phase as split:
    a prediction table whose making needs no training."""
    size = F.greatest(F.length("text"), F.lit(1))

    def share(characters: str) -> Column:
        return (F.length("text") - F.length(F.translate("text", characters, ""))) / size

    rules = {
        "length_rule": (F.length("text") / 1000.0, 2.0),
        "digit_rule": (share("0123456789"), 0.01),
        "upper_rule": (share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 0.02),
    }
    columns = {name: score for name, (score, _) in rules.items()}
    rows = phased(spark, folder, {SOURCE: F.col("source"), **columns})
    results = [
        F.struct(
            F.lit(name).alias("model"),
            (F.col(name) > limit).cast("bigint").alias("prediction"),
            F.col(name).alias("score"),
        )
        for name, (_, limit) in rules.items()
    ]
    split = F.when(F.col("phase") == PHASE1, "train").when(F.col("phase") == PHASE2, "val")
    return rows.select(
        KEY, LABEL, SOURCE, "phase", split.otherwise("test").alias("split"),
        F.inline(F.array(*results)),
    )


def modelling(spark: SparkSession, folder: str) -> DataFrame:
    """The split table, written once: training reads it several times."""
    return cut_lineage(preparation.modelling_table(phased(spark, folder)))


def fitted(splits: DataFrame, names: list[str]) -> FittedModels:
    return fit_models(splits.where(F.col("split") == "train"), names)


def bayes(spark: SparkSession, folder: str, names: tuple[str, ...] = ("complement_nb",)):
    return fitted(modelling(spark, folder), list(names))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"), "text"
    )


# ---- sources, cleaning, labels ---------------------------------------------------------


@query
def scan_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return corpus(spark, folder).select(KEY, TEXT, SOURCE, LABEL)


@query
def jsonl_export_view(spark: SparkSession, folder: str) -> DataFrame:
    return jsonl_view(preparation.modelling_table(phased(spark, folder)))


@query
def normalize_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Label spellings made of both label columns, e.g. ``' 1.0 '``, and what they mean."""
    labels = read_table(spark, folder, "labels")
    raw = F.concat(
        F.lit(" "),
        (F.col("toxic") + F.col("quality")).cast("string"),
        F.when(F.col("toxic") == 1, ".0\t").otherwise(""),
    )
    return (
        labels.select(raw.alias("raw"))
        .withColumn(LABEL, normalize_label(F.col("raw")))
        .groupBy("raw", LABEL)
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "documents")
        .select(F.col("doc_id").alias(KEY), clean_text(F.col("text")).alias(TEXT))
        .withColumn("n_chars", F.length(TEXT).cast("bigint"))
    )


@query
def clean_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.clean_dataset(corpus(spark, folder))


@query
def cleaning_summary(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.cleaning_summary(corpus(spark, folder, digested()))


@query
def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the cleaned table. No text leaves the map side: digests are grouped."""
    rows = prepare.digested_rows(corpus(spark, folder, digested()), keep=[KEY])
    return counts.distribution(prepare.distinct_keys(rows), LABEL)


@query
def copies_in_holdout(spark: SparkSession, folder: str) -> DataFrame:
    rows = phased(spark, folder, digested(0))
    return prepare.copies_across(rows, "phase", [PHASE1, PHASE2], [HOLDOUT])


# ---- sampling and splitting ------------------------------------------------------------


NARROW: dict[str, Column] = {}


@query
def seeded_rank(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.seeded_rank(corpus(spark, folder, NARROW), [LABEL], KEY, SEED)


@query
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_sample(corpus(spark, folder, NARROW), 0.6)


@query
def plain_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_sample(corpus(spark, folder, NARROW), 0.25, stratify=False)


@query
def phase_partition(spark: SparkSession, folder: str) -> DataFrame:
    return phased(spark, folder, NARROW)


@query
def train_val_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return preparation.split_keys(phased(spark, folder, digested()))


@query
def sample_summary(spark: SparkSession, folder: str) -> DataFrame:
    return counts.sample_summary(phased(spark, folder, NARROW))


@query
def phase_summary(spark: SparkSession, folder: str) -> DataFrame:
    return counts.phase_summary(phased(spark, folder, NARROW))


@query
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    return counts.split_summary(preparation.split_keys(phased(spark, folder, digested())))


@query
def partition_overlap(spark: SparkSession, folder: str) -> DataFrame:
    by_phase = counts.with_sample_rows(phased(spark, folder, NARROW))
    pairs = [
        ([sampling.SAMPLE], [HOLDOUT]),
        ([PHASE1], [PHASE2]),
        ([PHASE1, PHASE2], [sampling.SAMPLE]),
    ]
    return counts.key_overlap(by_phase, "phase", pairs)


# ---- manifest and sources --------------------------------------------------------------


def manifest_of_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Sources in name order, rows of a source in key order, laid end to end."""
    rows = ranking.key_rank(corpus(spark, folder, {SOURCE: F.col("source")}), [SOURCE], KEY)
    position = F.regexp_extract(SOURCE, r"(\d+)$", 1).cast("int")
    sources = rows.select(
        SOURCE, position.alias("source_pos"), (F.col("rank") - 1).alias("source_row_index"), LABEL
    )
    sources = cut_lineage(sources)
    return source_manifest(sources, number_blocks(sources).select(KEY, LABEL))


@query
def build_source_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_of_sources(spark, folder)


@query
def labels_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return label_by_source(corpus(spark, folder, {SOURCE: F.col("source")}))


@query
def source_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return counts.source_distribution(sliced(spark, folder, NARROW), manifest(spark, folder))


@query
def drift_share_table(spark: SparkSession, folder: str) -> DataFrame:
    return drift.share_table(source_distribution(spark, folder), SOURCE)


@query
def class_ratio(spark: SparkSession, folder: str) -> DataFrame:
    by_slice = counts.distribution(sliced(spark, folder, NARROW), "slice", LABEL)
    return counts.shares(by_slice)


# ---- quality ---------------------------------------------------------------------------


@query
def validate_checks(spark: SparkSession, folder: str) -> DataFrame:
    table = preparation.modelling_table(phased(spark, folder))
    return preparation.validate_splits(table)


@query
def request_screen(spark: SparkSession, folder: str) -> DataFrame:
    """All documents and all conversation turns as requests."""
    documents = read_table(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("message_id"), "text"
    )
    requests = documents.unionByName(messages(spark, folder))
    return scoring.screen(requests).select(
        "message_id",
        "reject_reason",
        F.length(TEXT).cast("bigint").alias("normalized_text_length"),
    )


# ---- drift -----------------------------------------------------------------------------


def _js(counts_: DataFrame, key: str) -> DataFrame:
    return rounded(drift.js_distance(drift.side_by_side(counts_, key)), "js_distance")


@query
def js_label(spark: SparkSession, folder: str) -> DataFrame:
    return _js(counts.distribution(sliced(spark, folder, NARROW), "slice", LABEL), LABEL)


@query
def js_source(spark: SparkSession, folder: str) -> DataFrame:
    return _js(source_distribution(spark, folder), SOURCE)


@query
def js_prediction(spark: SparkSession, folder: str) -> DataFrame:
    scored = predictions(
        sliced(spark, folder), bayes(spark, folder), keep=["slice"]
    )
    return _js(counts.distribution(scored, "slice", "prediction"), "prediction")


@query
def text_length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.length_stats(lengths_by_slice(spark, folder)), "mean", "median", "p90")


@query
def length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    table = drift.length_histogram(lengths_by_slice(spark, folder))
    return rounded(rounded(table, "start"), "density", digits=12)


@query
def ks_length(spark: SparkSession, folder: str) -> DataFrame:
    lengths = cut_lineage(lengths_by_slice(spark, folder))
    return rounded(drift.ks_test(lengths), "ks_statistic", "ks_pvalue")


@query
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return drift.token_counts(read_table(spark, folder, "documents"), "text")


@query
def vocabulary_drift(spark: SparkSession, folder: str) -> DataFrame:
    pairs = drift.token_pairs(sliced(spark, folder))
    return rounded(drift.vocabulary_drift(pairs), "new_token_rate")


@query
def new_tokens_topn(spark: SparkSession, folder: str) -> DataFrame:
    return drift.new_tokens(drift.token_pairs(sliced(spark, folder)))


@query
def new_tokens_all(spark: SparkSession, folder: str) -> DataFrame:
    """The same by an anti join of two token tables."""
    both = drift.token_counts(sliced(spark, folder), by=["slice"])
    current = both.where(F.col("slice") == PHASE2).select("token", "n")
    return drift.vocabulary_difference(current, both.where(F.col("slice") == PHASE1))


@query
def drift_report_table(spark: SparkSession, folder: str) -> DataFrame:
    report = drift_report(sliced(spark, folder), manifest(spark, folder), bayes(spark, folder))
    return rounded(report, "value", digits=8)


# ---- metrics ---------------------------------------------------------------------------

BY = ["model", "split"]


def _report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.full_report(rule_predictions(spark, folder), BY)


@query
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    table = metrics.classification_report(rule_predictions(spark, folder), BY)
    return rounded(table, *metrics.METRICS)


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    steps = metrics.score_steps(rule_predictions(spark, folder), BY)
    return rounded(metrics.ranking_report(steps, BY), "roc_auc").select(*BY, "roc_auc")


@query
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    steps = metrics.score_steps(rule_predictions(spark, folder), BY)
    return rounded(metrics.ranking_report(steps, BY), "average_precision").select(
        *BY, "average_precision"
    )


@query
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    steps = metrics.score_steps(rule_predictions(spark, folder), BY)
    return rounded(metrics.pr_curve(steps, BY), "threshold", "precision", "recall")


@query
def metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = rule_predictions(spark, folder)
    one_model = rows.where(F.col("model") == RULES[0])
    table = metrics.run_metrics(metrics.full_report(rows, BY), one_model, "rules")
    return rounded(table, "value")


@query
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    table = metrics.model_comparison(_report(spark, folder))
    return rounded(table, *[c for c in table.columns if c != "model"])


@query
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.best_model(_report(spark, folder), order=RULES), "val_f2")


@query
def metric_delta(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.classification_report(rule_predictions(spark, folder), BY)
    first, second = (report.where(F.col("split") == s) for s in ("train", "val"))
    return metrics.metric_delta(first, second, ["f2", "recall", "false_negative_rate"])


@query
def metric_pivot(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.classification_report(rule_predictions(spark, folder), BY)
    phases = {p: report.where(F.col("split") == s) for p, s in
              (("phase1", "train"), ("phase2", "val"))}
    return rounded(metrics.metric_pivot(phases, "f2"), "phase1", "phase2")


@query
def error_slices(spark: SparkSession, folder: str) -> DataFrame:
    rows = rule_predictions(spark, folder).select(*BY, KEY, LABEL, "prediction", "score")
    return rounded(metrics.error_slices(rows, BY), "score")


@query
def slice_stats_by_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = rule_predictions(spark, folder).where(F.col("model") == RULES[0]).drop(SOURCE)
    joined = counts.with_source(rows.where(F.col("phase") == PHASE2), manifest(spark, folder),
                                how="left")
    return metrics.stats_by_source(joined)


@query
def confidence_pct(spark: SparkSession, folder: str) -> DataFrame:
    rows = rule_predictions(spark, folder)
    kind = F.when(F.col("model") == RULES[0], MARGIN).otherwise(PROBABILITY)
    return rows.select(KEY, "model", confidence_text(F.col("score"), kind).alias("confidence"))


@query
def latency_summary(spark: SparkSession, folder: str) -> DataFrame:
    log = read_table(spark, folder, "events")
    table = metrics.latency_summary(log, "value", F.col("event_type") == "error")
    return rounded(table, "mean_latency_ms", "p95_latency_ms", digits=6)


@query
def latest_run_children(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as parent runs, order lines as their children."""
    orders = read_table(spark, folder, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey")).alias("run_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING").alias("status"),
        F.col("o_orderdate").alias("start_time"),
    )
    lines = read_table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.concat(F.lit("l"), "l_orderkey"), "l_linenumber", "l_partkey").alias(
            "run_id"
        ),
        F.concat(F.lit("o"), "l_orderkey").alias("parent_id"),
        F.col("l_returnflag").alias("name"),
        F.lit("FINISHED").alias("status"),
        F.col("l_shipdate").alias("start_time"),
    )
    return metrics.latest_children(orders.unionByName(lines)).select(
        "run_id", "parent_id", "name", "status"
    )


# ---- features and models ---------------------------------------------------------------


@query
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    """Analysed single tokens of all documents: occurrences and documents per term."""
    params = features.TfidfParams(ngram_range=(1, 1))
    documents = read_table(spark, folder, "documents").select(
        F.col("doc_id").alias(KEY), F.col("text").alias(TEXT)
    )
    return features.term_totals(documents, params)


@query
def tfidf_vocab(spark: SparkSession, folder: str) -> DataFrame:
    splits = modelling(spark, folder)
    return rounded(features.vocabulary(splits.where(F.col("split") == "train")), "idf")


@query
def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    splits = modelling(spark, folder)
    vocab = cut_lineage(features.vocabulary(splits.where(F.col("split") == "train")))
    return rounded(features.tfidf_weights(splits, vocab, keep=["split"]), "weight")


@query
def vocab_sample(spark: SparkSession, folder: str) -> DataFrame:
    splits = modelling(spark, folder)
    vocab = features.vocabulary(splits.where(F.col("split") == "train"))
    order = ranking.seeded_hash(F.col("term"), SEED)
    return vocab.orderBy(order, "term").limit(15).select("term", "term_id")


@query
def dummy_predict(spark: SparkSession, folder: str) -> DataFrame:
    keys = preparation.split_keys(phased(spark, folder, digested()))
    majority = majority_label(keys.where(F.col("split") == "train")).scalar()
    return keys.where(F.col("split") != "train").select(
        KEY, "split", LABEL, majority.alias("prediction"), majority.cast("double").alias("score")
    )


@query
def complement_nb_weights(spark: SparkSession, folder: str) -> DataFrame:
    train = modelling(spark, folder).where(F.col("split") == "train")
    vocab = cut_lineage(features.vocabulary(train))
    by_class = complement_nb(features.tfidf_weights(train, vocab, keep=[LABEL]))
    named = by_class.join(vocab.select("term", "term_id"), "term_id")
    return rounded(named.select("term", "weight_0", "weight_1"), "weight_0", "weight_1")


@query
def linear_score_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Val and test rows scored by the fitted Bayes weights."""
    splits = modelling(spark, folder)
    rest = splits.where(F.col("split") != "train")
    scored = predictions(rest, fitted(splits, ["complement_nb"]), keep=["split", LABEL])
    return rounded(scored, "score").drop("score_type", "model")


@query
def holdout_eval(spark: SparkSession, folder: str) -> DataFrame:
    by_phase = phased(spark, folder)
    splits = cut_lineage(preparation.modelling_table(by_phase))
    models = fitted(splits, ["dummy", "complement_nb"])
    report = training.evaluate(models, {HOLDOUT: preparation.holdout_table(by_phase)})
    names = metrics.METRICS + metrics.RANKING_METRICS
    return rounded(report, *names).select("model", "rows", *names)


@query
def published_holdout(spark: SparkSession, folder: str) -> DataFrame:
    """Two models trained, the better one by validation F2 published, loaded from the store and
    evaluated on the holdout."""
    by_phase = cut_lineage(phased(spark, folder))
    splits = cut_lineage(preparation.modelling_table(by_phase))
    run = training.train_and_compare(splits, ["dummy", "complement_nb"])
    store = _fresh(spark, "models")
    training.publish_best(run, store)
    report = training.evaluate(
        load_published(spark, store), {HOLDOUT: preparation.holdout_table(by_phase)}
    )
    chosen = published(spark, store).select(
        F.col("models").alias("model"), F.col("value").alias("val_f2")
    )
    names = metrics.METRICS + metrics.RANKING_METRICS
    joined = report.join(chosen, "model").select("model", "val_f2", "rows", *names)
    return rounded(joined, "val_f2", *names)


@query
def scored_response(spark: SparkSession, folder: str) -> DataFrame:
    screened = scoring.screen(messages(spark, folder))
    accepted = screened.where(F.col("reject_reason").isNull())
    return rounded(scoring.respond(accepted, bayes(spark, folder), "message_id"), "score")


@query
def batch_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, labelled or not, scored as they are."""
    documents = read_table(spark, folder, "documents").select(
        F.col("doc_id").alias(KEY), F.col("text").alias(TEXT), SOURCE
    )
    scored = scoring.score_table(documents, bayes(spark, folder), KEY)
    return rounded(scored, "score").select(KEY, SOURCE, "prediction", "score", "score_type")


@query
def objective_at_point(spark: SparkSession, folder: str) -> DataFrame:
    """Objective and slopes of both linear models where each weight follows from its term's
    length and the bias is 1/8."""
    train = modelling(spark, folder).where(F.col("split") == "train")
    vocab = cut_lineage(features.vocabulary(train))
    weight = (F.length("term") % 7 - 3) / 8.0
    point = FittedModels(
        vocab.select("term", "term_id", "idf", *[weight.alias(f"w_{m}") for m in LINEAR]),
        [Head(m, MARGIN, 0.125) for m in LINEAR],
    )
    return rounded(objective_table(train, point), "value", digits=7)


@query
def fit_certificates(spark: SparkSession, folder: str) -> DataFrame:
    """Both linear models, fitted: whether the gradient proves them optimal to the tolerance."""
    train = modelling(spark, folder).where(F.col("split") == "train")
    table = certificates(train, fit_models(train, LINEAR))
    return rounded(
        table.select(
            "model", "rows", "objective_at_zero", "converged",
            (F.col("relative_gradient") <= 1e-4).alias("gradient_vanishes"),
            (F.col("objective") < F.col("objective_at_zero")).alias("below_zero_point"),
            (F.col("gap_bound") <= 1e-3 * F.col("objective")).alias("gap_is_small"),
        ),
        "objective_at_zero",
        digits=6,
    )


# ---- training runs and streams ---------------------------------------------------------


@query
def train_four_models(spark: SparkSession, folder: str) -> DataFrame:
    run = training.train_and_compare(modelling(spark, folder))
    return metrics.model_comparison(run.report)


@query
def cross_slice_eval(spark: SparkSession, folder: str) -> DataFrame:
    """The first phase's model and the second phase's best by validation F2."""
    by_phase = cut_lineage(phased(spark, folder))
    first = prepare.clean_dataset(sampling.phase_rows(by_phase, PHASE1))
    increment = cut_lineage(prepare.clean_dataset(sampling.phase_rows(by_phase, PHASE2)))
    run = training.train_and_compare(cut_lineage(preparation.modelling_table(by_phase)))
    best = run.models.only(run.best)
    return training.cross_slice(
        fit_models(cut_lineage(first), ["logistic_regression"]), best, increment
    )


@query
def parameter_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return training.sweep(modelling(spark, folder), _fresh(spark, "sweep"))


def _fresh(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint storage."""
    stamp = spark.range(1).select(F.expr("uuid()")).first()[0]
    return f"{checkpoint_dir(spark)}/{name}-{stamp}"


TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


@query
def stream_both_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as a stream, some turns spoilt by rule so that each reason to reject
    occurs: both sinks read back with the latency log, a row per message."""
    spoilt = F.expr(
        "CASE conv_id % 12 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN repeat(' ', 4) "
        "WHEN 3 THEN substring(text, 1, 2) WHEN 4 THEN rpad(text, 50001, 'x') ELSE text END"
    )
    stream = read_messages(spark, f"{folder}/conversations*.parquet", TURNS).select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"), spoilt.alias("text")
    )
    out = _fresh(spark, "stream")
    sinks = [f"{out}/accepted", f"{out}/rejected"]
    score_stream(
        stream, bayes(spark, folder), "message_id", *sinks, f"{out}/offsets", available_now=True,
        log_path=f"{out}/log",
    ).awaitTermination()
    rows = answered(spark, *sinks, f"{out}/log", "message_id")
    return rounded(
        rows.select(
            "message_id", "reject_reason", "prediction", "score", "normalized_text_length",
            (F.col("latency_ms") > 0).alias("timed"),
        ),
        "score",
    )


@query
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as a stream: the accepted answers, read back."""
    models = bayes(spark, folder)
    stream = read_messages(spark, f"{folder}/conversations*.parquet", TURNS).select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"), "text"
    )
    out = _fresh(spark, "stream")
    score_stream(
        stream, models, "message_id", f"{out}/accepted", f"{out}/rejected", f"{out}/offsets",
        available_now=True,
    ).awaitTermination()
    return rounded(spark.read.parquet(f"{out}/accepted"), "score").drop("batch_id")


@query
def stream_drift(spark: SparkSession, folder: str) -> DataFrame:
    """The second phase arriving as files, checked against the first."""
    out = _fresh(spark, "drift")
    slices = cut_lineage(sliced(spark, folder))
    columns = [KEY, TEXT, LABEL]
    slices.where(F.col("slice") == PHASE2).select(*columns).write.parquet(f"{out}/incoming")
    schema = slices.select(*columns).schema
    drift_stream(
        read_messages(spark, f"{out}/incoming", schema),
        slices.where(F.col("slice") == PHASE1).select(*columns),
        f"{out}/reports",
        f"{out}/offsets",
        manifest(spark, folder),
        bayes(spark, folder),
        available_now=True,
    ).awaitTermination()
    return rounded(spark.read.parquet(f"{out}/reports"), "value", digits=8).drop("batch_id")

