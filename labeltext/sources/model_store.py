"""A folder of published models.

Each version lies in a folder of its own and is complete before its row is added to the
manifest; readers go by the manifest alone. A failed save therefore leaves what was published
before as it is, and a version is never overwritten."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.operators.classifiers import FittedModels, load_models, save_models
from labeltext.schema import PRIMARY_METRIC
from labeltext.sources.files import append_rows

MANIFEST = "version string, models string, metric string, value double, published timestamp"


def publish(
    models: FittedModels, store: str, value: float, metric: str = PRIMARY_METRIC
) -> str:
    """Save ``models`` as a new version with the value it was selected by. Returns the version."""
    spark = models.terms.sparkSession
    version = uuid.uuid4().hex
    save_models(models, f"{store}/versions/{version}")
    names = ",".join(head.model for head in models.heads)
    row = spark.createDataFrame(
        [(version, names, metric, float(value))],
        "version string, models string, metric string, value double",
    )
    append_rows(row.withColumn("published", F.current_timestamp()).coalesce(1), f"{store}/manifest")
    return version


def published(spark: SparkSession, store: str) -> DataFrame:
    """The manifest: version, models, metric, value, published."""
    return spark.read.schema(MANIFEST).parquet(f"{store}/manifest")


def load_published(
    spark: SparkSession, store: str, version: str | None = None, metric: str = PRIMARY_METRIC
) -> FittedModels:
    """The named version, or the best one by ``metric``, the newest on ties."""
    rows = published(spark, store)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    else:
        rows = rows.where((F.col("metric") == metric) & ~F.isnan("value"))
    best = rows.orderBy(F.col("value").desc_nulls_last(), F.col("published").desc(), "version").first()
    if best is None:
        raise ValueError(f"nothing published in {store} as {version or metric!r}")
    return load_models(spark, f"{store}/versions/{best['version']}")
