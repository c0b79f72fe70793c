"""Scoring and drift checks of arriving messages.

Both jobs work per micro-batch with the batch operators. A batch writes its own folder and
overwrites it when it is run again, so results stay exactly-once after a restart. Offsets are
kept in the checkpoint location, which must lie in storage all executors share.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from labeltext.operators.classifiers import FittedModels
from labeltext.operators.sampling import PHASE1, PHASE2
from labeltext.plans.drift_report import DriftProfile, drift_profile, report_of
from labeltext.plans.scoring import respond, screen


BATCH_LOG = "accepted bigint, rejected bigint, elapsed_ms double"


def read_messages(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def score_stream(
    messages: DataFrame,
    models: FittedModels,
    key: str,
    accepted_path: str,
    rejected_path: str,
    checkpoint: str,
    text: str = "text",
    model_version: str | None = None,
    available_now: bool = False,
    log_path: str | None = None,
) -> StreamingQuery:
    """Screen each message; answers and rejections go to their own sinks. Rows keep no state
    between batches, so there is no watermark. ``log_path`` takes a row per batch: its accepted
    and rejected messages, counted as they are written, and the time from its arrival until
    both sinks have it."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        started = time.perf_counter()
        seen = {"accepted": Observation(), "rejected": Observation()}

        def counted(rows: DataFrame, sink: str) -> DataFrame:
            return rows.observe(seen[sink], F.count(F.lit(1)).alias("n"))

        screened = screen(batch, text).persist()
        try:
            accepted = counted(screened.where(F.col("reject_reason").isNull()), "accepted")
            respond(accepted, models, key, model_version).write.mode("overwrite").parquet(
                f"{accepted_path}/batch_id={batch_id}"
            )
            counted(screened.where(F.col("reject_reason").isNotNull()), "rejected").select(
                key, "reject_reason"
            ).write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
        finally:
            screened.unpersist()
        if log_path is not None:
            elapsed = (time.perf_counter() - started) * 1000
            row = [(seen["accepted"].get["n"], seen["rejected"].get["n"], elapsed)]
            batch.sparkSession.createDataFrame(row, BATCH_LOG).coalesce(1).write.mode(
                "overwrite"
            ).parquet(f"{log_path}/batch_id={batch_id}")

    return _start(messages, handle, checkpoint, available_now)


def answered(
    spark: SparkSession, accepted_path: str, rejected_path: str, log_path: str, key: str
) -> DataFrame:
    """Every message of a scoring stream with what became of it: the response columns (null if
    rejected), ``reject_reason`` (null if accepted) and ``latency_ms``, the time its batch took
    from arrival to answer. A batch without a log row was not finished and is left out."""
    log = spark.read.schema(f"{BATCH_LOG}, batch_id bigint").parquet(log_path).select(
        "batch_id", F.col("elapsed_ms").alias("latency_ms")
    )
    accepted = spark.read.parquet(accepted_path)
    kind = accepted.schema[key].dataType.simpleString()
    rejected = spark.read.schema(f"`{key}` {kind}, reject_reason string, batch_id int").parquet(
        rejected_path
    )
    both = accepted.unionByName(rejected, allowMissingColumns=True)
    return both.withColumn("batch_id", F.col("batch_id").cast("bigint")).join(log, "batch_id")


def drift_stream(
    increments: DataFrame,
    reference: DataFrame,
    report_path: str,
    checkpoint: str,
    manifest: DataFrame | None = None,
    models: FittedModels | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Compare every arriving increment with a fixed reference slice. Both have raw_index,
    text_combined and label. The reference is profiled once, before the stream starts; a
    batch reads its own rows only."""
    columns = ["raw_index", "text_combined", "label"]

    def profile(df: DataFrame, slice_: str) -> DriftProfile:
        tagged = df.select(*columns).withColumn("slice", F.lit(slice_))
        return drift_profile(tagged, manifest, models)

    fixed = profile(reference, PHASE1)

    def handle(batch: DataFrame, batch_id: int) -> None:
        report_of(fixed.merged(profile(batch, PHASE2))).write.mode("overwrite").parquet(
            f"{report_path}/batch_id={batch_id}"
        )

    return _start(increments, handle, checkpoint, available_now)
