"""CSV, JSON lines and Parquet hand-off tables."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labeltext.functions.text import na_to_null
from labeltext.operators.counts import distribution
from labeltext.schema import KEY, LABEL, RAW_SCHEMA, SOURCE, TEXT, require_columns
from labeltext.session import cut_lineage


def read_raw_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = RAW_SCHEMA
) -> DataFrame:
    """Quoted CSV with line breaks inside fields. Spellings of a missing value become null.

    With ``schema=None`` the header gives the columns, all as text."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    return df.select(
        *[
            na_to_null(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _header(spark: SparkSession, uri: str) -> tuple[str, ...]:
    """The column names in a CSV file's first line; reads no more of it."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([(line or "").removeprefix("\ufeff")]), []))


def _literal(spark: SparkSession, uri: str) -> str:
    """The path of a file URI, with characters that have a meaning in patterns escaped."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _listed(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files of each path, sorted: a file itself, or the part files of a folder."""
    files = [sorted(spark.read.schema("line string").text(p).inputFiles()) for p in paths]
    flat = [f for some in files for f in some]
    if len(set(flat)) < len(flat):
        raise ValueError("a file is listed more than once")
    return files


def numbered_rows(
    spark: SparkSession, paths: list[str], columns: list[str] | None = None
) -> DataFrame:
    """The rows of all CSV files of ``paths``, read once, with ``path_pos``, the position of
    their path, ``path_row``, their number within the path, and ``row``, their number over
    all paths. Numbers begin at 0 and have no gaps; files follow each other in the order of
    ``paths``, part files by name, rows as they stand in their file. Columns are found by name
    in each file's header; without ``columns``, those of the first file.

    A multi-line CSV file is read by one task, front to back, so a running row id orders its
    rows. The rows are stored with it, so every later use has the same numbers. Files with the
    same header are one scan; apart from headers no file is looked at alone. What is summed up
    in one piece has a row per file."""
    listed = _listed(spark, paths)
    if not any(listed):
        raise ValueError("no files to read")
    headers: dict[tuple[str, ...], list[str]] = {}
    for uri in (f for files in listed for f in files):
        headers.setdefault(_header(spark, uri), []).append(uri)
    columns = columns or list(next(iter(headers)))
    scans = None
    for header, uris in headers.items():
        missing = sorted(set(columns) - set(header))
        if missing:
            raise ValueError(f"{uris[0]}: input is missing required columns: {missing}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option(
            "escape", '"'
        ).csv([_literal(spark, uri) for uri in uris])
        part = rows.select(
            *[na_to_null(F.col(f"`{c}`")).alias(c) for c in columns],
            F.input_file_name().alias("_file"),
        )
        scans = part if scans is None else scans.unionAll(part)
    stored = cut_lineage(scans.withColumn("_id", F.monotonically_increasing_id()))

    order = [(uri, pos, k) for pos, files in enumerate(listed) for k, uri in enumerate(files)]
    places = spark.createDataFrame(order, "_file string, path_pos int, _part int")
    sizes = stored.groupBy("_file").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.orderBy("path_pos", "_part").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.join(places, "_file").withColumn(
        "_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    )
    path = files.withColumn("_start", F.min("_before").over(Window.partitionBy("path_pos")))
    place = F.col("_id") - F.col("_first") + F.col("_before")
    return stored.join(path.drop("_n", "_part"), "_file").select(
        *columns, "path_pos", (place - F.col("_start")).alias("path_row"), place.alias("row")
    )


def with_row_index(
    spark: SparkSession, path: str | list[str], name: str = KEY, across: bool = False
) -> DataFrame:
    """Raw CSV rows with their number within their path, or over all paths if ``across``."""
    rows = numbered_rows(spark, [path] if isinstance(path, str) else path)
    number = "row" if across else "path_row"
    others = [c for c in rows.columns if c not in ("path_pos", "path_row", "row")]
    return rows.select(*others, F.col(number).alias(name))


def check_labels(
    df: DataFrame, label: str = LABEL, name: str = "input", by: str | None = None
) -> DataFrame:
    """The labels as BIGINT; ValueError unless every one of them is 0 or 1. With ``by``, a
    column of names, one job checks all of them and the first wrong one is reported."""
    require_columns(df, [label])
    number = F.col(label).try_cast("double") if isinstance(
        df.schema[label].dataType, T.StringType
    ) else F.col(label).cast("double")
    numbers = df.select(*[c for c in df.columns if c != label], number.alias(label))
    bad = numbers.groupBy((F.col(by) if by else F.lit(name)).alias("name")).agg(
        F.count_if(F.col(label).isNull() | F.isnan(label)).alias("missing"),
        F.count_if(~F.col(label).cast("bigint").isin(0, 1)).alias("invalid"),
    ).where("missing > 0 or invalid > 0").orderBy("name").first()
    if bad and bad["missing"]:
        raise ValueError(f"{bad['name']}: {bad['missing']} labels are not numbers")
    if bad:
        raise ValueError(f"{bad['name']}: {bad['invalid']} labels are neither 0 nor 1")
    return numbers.withColumn(label, F.col(label).cast("bigint"))


def read_sources(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """Label and row index of each source file or folder, tagged with source name and
    position. All are read, numbered and checked together, however many there are."""
    rows = numbered_rows(spark, [path for _, path in files], [LABEL])
    names = spark.createDataFrame(
        [(k, source) for k, (source, _) in enumerate(files)], f"path_pos int, {SOURCE} string"
    )
    tagged = rows.join(names, "path_pos").select(
        F.col("path_row").alias("source_row_index"), LABEL, SOURCE, F.col("path_pos").alias("source_pos")
    )
    return check_labels(tagged, by=SOURCE)


def write_stage(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write a hand-off table, partitioned by phase or split, and read it back."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A metric table written as CSV or JSON."""
    if path.endswith(".json"):
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).option("header", True).csv(path)


def jsonl_view(df: DataFrame) -> DataFrame:
    """The two exported columns plus the split."""
    require_columns(df, [TEXT, LABEL, "split"])
    return df.select(
        F.col(TEXT).alias("text"), F.col(LABEL).cast("bigint").alias(LABEL), "split"
    )


def export_jsonl(df: DataFrame, path: str) -> DataFrame:
    """Write ``text`` and ``label`` as JSON lines, one folder per split, and return rows and
    label counts per split."""
    view = jsonl_view(df)
    view.write.mode("overwrite").partitionBy("split").json(path)
    written = df.sparkSession.read.schema("label bigint, split string").json(path)
    return distribution(written, "split", LABEL)


def write_summary(df: DataFrame, path: str) -> None:
    """A summary of few rows as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to an append-only table, e.g. run metrics."""
    df.write.mode("append").parquet(path)
