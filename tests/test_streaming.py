from pyspark.sql import types as T

from labeltext.operators.classifiers import fit_models
from labeltext.operators.features import TfidfParams
from labeltext.streaming.jobs import answered, drift_stream, read_messages, score_stream

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])


def test_score_stream_splits_sinks_and_resumes(spark, tmp_path):
    rows = [(0, "win money click", 1), (1, "money prize click", 1), (2, "team meeting notes", 0),
            (3, "monday meeting notes", 0)]
    train = spark.createDataFrame(rows, "raw_index bigint, text_combined string, label bigint")
    models = fit_models(train, ["linear_svc"], TfidfParams(min_df=1, max_df=1.0))
    incoming = str(tmp_path / "in")
    paths = [str(tmp_path / n) for n in ("ok", "bad", "offsets")]
    log = str(tmp_path / "log")

    def send(messages):
        spark.createDataFrame(messages, SCHEMA).coalesce(1).write.mode("append").parquet(incoming)
        stream = read_messages(spark, incoming, SCHEMA, files_per_batch=1)
        score_stream(
            stream, models, "id", *paths, available_now=True, log_path=log
        ).awaitTermination()

    send([("a", "  Click for MONEY "), ("b", "  ")])
    send([("c", "notes of the meeting")])
    accepted = spark.read.parquet(paths[0])
    assert {(r["id"], r["prediction"]) for r in accepted.collect()} == {("a", 1), ("c", 0)}
    assert accepted.select("batch_id").distinct().count() == 2
    rejected = spark.read.parquet(paths[1]).collect()
    assert [(r["id"], r["reject_reason"]) for r in rejected] == [("b", "blank")]
    counts = {r["batch_id"]: (r["accepted"], r["rejected"]) for r in spark.read.parquet(log).collect()}
    assert counts == {0: (1, 1), 1: (1, 0)}
    every = {r["id"]: r for r in answered(spark, *paths[:2], log, "id").collect()}
    assert {k: r["reject_reason"] for k, r in every.items()} == {"a": None, "b": "blank", "c": None}
    assert all(r["latency_ms"] > 0 for r in every.values())
    assert every["a"]["latency_ms"] == every["b"]["latency_ms"] and every["b"]["prediction"] is None


def test_drift_stream_reports_each_increment(spark, tmp_path):
    schema = "raw_index bigint, text_combined string, label bigint"
    reference = spark.createDataFrame([(0, "aa bb", 0), (1, "aa", 1)], schema)
    incoming, reports = str(tmp_path / "in"), str(tmp_path / "reports")
    for i, text in enumerate(("aa cc", "aa bb")):
        spark.createDataFrame([(10 + i, text, 0)], schema).coalesce(1).write.mode("append").parquet(
            incoming
        )
        stream = read_messages(spark, incoming, reference.schema)
        drift_stream(stream, reference, reports, str(tmp_path / "offsets"),
                     available_now=True).awaitTermination()
    out = spark.read.parquet(reports).where("name = 'new_token_count'")
    assert {r["batch_id"]: r["value"] for r in out.collect()} == {0: 1.0, 1: 0.0}
