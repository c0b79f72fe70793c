"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.functions.batches import releasing
from labeltext.session import checkpoint_dir, cut_lineage

SLABS = 64


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: lineage is
    cut, and later reads prune columns."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table that ``stored`` wrote. Call it once everything made of it is stored
    itself, so that a lost executor asks for nothing that is gone."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def count_cells(
    df: DataFrame, cells: int, cells_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]]
) -> np.ndarray:
    """How often each cell number from 0 to ``cells`` - 1 occurs over all rows of ``df``.
    ``cells_of`` gives the cell numbers of a batch. Every task adds up an array of fixed
    size; the arrays are summed in Spark, and ``cells`` numbers reach the driver."""
    width = -(-cells // SLABS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * SLABS, np.int64)
        for batch in batches:
            for found in cells_of(batch):
                total += np.bincount(found, minlength=len(total))
        slabs = total.reshape(SLABS, width)
        full = np.flatnonzero(slabs.any(axis=1))
        if len(full):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full, pa.int32()),
                    pa.array([squeeze(slabs[k], delta=False) for k in full], pa.binary()),
                ],
                ["slab", "counts"],
            )

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for counts in group["counts"]:
            total += unsqueeze(counts.as_buffer(), delta=False)
        return pa.table({"slab": group["slab"][:1], "counts": pa.array([total.tobytes()])})

    kind = "slab int, counts binary"
    sums = df.mapInArrow(releasing(count), kind).groupBy("slab").applyInArrow(add, kind).collect()
    out = np.zeros((SLABS, width), np.int64)
    for slab, counts in sums:
        out[slab] = np.frombuffer(counts, np.int64)
    return out.reshape(-1)[:cells]


def squeeze(values: np.ndarray, delta: bool = True) -> bytes:
    """Integers as the planes of their bytes, of successive differences if ``delta``: small
    numbers take few planes, and planes of equal bytes compress well in the shuffle."""
    values = np.asarray(values, np.int64)
    if delta:
        values = np.diff(values, prepend=np.int64(0))
    folded = ((values << 1) ^ (values >> 63)).astype(np.uint64)
    most = int(folded.max()) if len(folded) else 0
    planes = max(1, -(-most.bit_length() // 8))
    raw = folded.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + np.ascontiguousarray(raw.T).tobytes()


def unsqueeze(data: bytes, delta: bool = True) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    planes = int(raw[0])
    body = raw[1:].reshape(planes, -1)
    full = np.zeros((body.shape[1], 8), np.uint8)
    full[:, :planes] = body.T
    folded = full.reshape(-1).view("<u8")
    values = (folded >> np.uint64(1)).astype(np.int64) ^ -(folded & np.uint64(1)).astype(np.int64)
    return np.cumsum(values) if delta else values


def by_bin(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by bin, the bins that occur, and where each begins (and the end)."""
    order = np.argsort(bins, kind="stable")
    ordered = bins[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    return order, ordered[first], np.append(first, len(ordered))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of undirected edges ``a``, ``b``: the component is
    its smallest node. Alternates large-star and small-star steps; every step is a grouping
    and a join on the node, and a node's neighbours are never gathered in one row."""
    edges = cut_lineage(edges.select("a", "b").where("a <> b").distinct())

    def sign(df: DataFrame):
        return tuple(
            df.agg(
                F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
            ).first()
        )

    before = sign(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), "m")
        large = large.where("a <> m").distinct().select("a", F.col("m").alias("b"))
        # Every edge now points to a smaller node.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").select(F.col("b").alias("a"), "m").where("a <> m")
        edges = cut_lineage(
            moved.union(small).distinct().select("a", F.col("m").alias("b"))
        )
        after = sign(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b")).groupBy("node").agg(
        F.min("component").alias("component")
    )
