"""Exact top-k inner products from an impact-ordered index, score at a time.

The vectors are cut into shards of bounded size, each an index in memory: for every dimension
postings (vector, impact) in segments by quantised impact, largest magnitude first. A block of
queries goes through a shard's segments in that order, adding to each vector's score the part
of its impact that the segment's level stands for. After each level a vector's score lies
between bounds: what was added, plus or minus what the query's weights can make of the
magnitudes left. Processing stops only when the bounds prove it: when the vectors whose upper
bound reaches the k-th largest lower bound are few, or all is added up. The vectors that can
still be among the first k, ties included, are then rescored exactly in integers.

Every block of queries meets every shard once; pairs of block and shard are dealt to tasks, and
a task gives at most k rows per query. No query set or index goes through the driver.

Components become floor(64 * x). Vectors that are null, or hold a null or non-finite component,
and rows without an id take no part; an empty vector scores 0; shorter vectors count as padded
with zeros. Rows with equal ids are different candidates, ordered as they come after score and
id; a query's own id is never its candidate. Query rows with equal ids are one query; if their
vectors differ, the candidates of each are ranked together. Other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCALE = 64
SHARD, BLOCK = 8192, 1024
LEVELS = 6
# Queries whose scores over a shard are held at a time.
GROUP = 256


class Shard:
    """Impact-ordered index of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        size = np.abs(self.vectors)
        top = int(size.max()) if size.size else 0
        # Level edges: segment s holds impacts of magnitude in [edge[s + 1], edge[s]).
        step = max(1, -(-(top + 1) // (1 << LEVELS)))
        self.edges = [0]
        while self.edges[0] <= top:
            self.edges.insert(0, max(step, self.edges[0] * 2))
        self.size = size

    def segments(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each level: the impacts its segments add, and a bound on the magnitudes of what
        is still to come, zero where all is added. A segment adds its members' impacts exactly."""
        for low, high in zip(self.edges[1:], self.edges[:-1], strict=True):
            here = (self.size >= low) & (self.size < high)
            left = self.size < low
            yield (
                np.where(here, self.vectors, 0).astype(np.float64),
                np.where(left, max(low - 1, 0), 0).astype(np.float64),
            )

    def search(self, names: np.ndarray, queries: np.ndarray, k: int):
        """Rows (query number, candidate number, score): the k best of each query, ties by id."""
        levels = list(self.segments())
        for at in range(0, len(queries), GROUP):
            exact = queries[at : at + GROUP]
            weights = exact.astype(np.float64)
            own = self.ids[None, :] == names[at : at + GROUP, None]
            score = np.zeros((len(exact), len(self.ids)))
            score[own] = -np.inf
            for n, (impact, left) in enumerate(levels):
                score += weights @ impact.T
                if n == len(levels) - 1 or k >= len(self.ids):
                    continue
                if n < len(levels) // 2:
                    continue
                slack = np.abs(weights) @ left.T
                low = np.partition(score - slack, -k, axis=1)[:, -k]
                possible = score + slack >= low[:, None]
                if possible.sum() <= 4 * k * len(exact):
                    break
            else:
                if k < len(self.ids):
                    low = np.partition(score, -k, axis=1)[:, -k]
                    possible = score >= low[:, None]
                else:
                    possible = np.ones_like(own)
            possible &= ~own
            q, c = np.nonzero(possible)
            value = (exact[q] * self.vectors[c]).sum(axis=1)
            order = np.lexsort((c, -value, q))
            q, c, value = q[order], c[order], value[order]
            first = np.searchsorted(q, np.arange(len(exact)))
            keep = np.arange(len(q)) - first[q] < k
            yield at + q[keep], c[keep], value[keep]


def _vectors(column: pa.Array) -> np.ndarray:
    """Integer vectors of a batch, padded with zeros to the longest."""
    many = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), int(many.max()) if len(many) else 0), np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(many)), many)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(many) - many, many)] = flat
    return out


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of up to ``size`` vectors each: ids and their vectors, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                vectors = _vectors(part.column("vector"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()),
                        pa.array([vectors.tobytes()], pa.binary()),
                        pa.array([vectors.shape[1]], pa.int32()),
                    ],
                    ["ids", "vectors", "width"],
                )

    return rows.mapInArrow(pack, "ids binary, vectors binary, width int")


def _unpacked(ids, vectors, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids.as_buffer(), np.int64)
    data = np.frombuffer(vectors.as_buffer() if width else b"", np.int64)
    return ids, data.reshape(len(ids), width)


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    rows = embeddings.where("vec_id is not null and embedding is not null").where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("vector"),
    )
    total = rows.count()
    shards = max(1, -(-total // SHARD))
    place = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    index = _packed(
        rows.withColumn("shard", place).repartitionById(shards, "shard"), SHARD
    ).withColumn("shard", F.spark_partition_id())
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    blocks = max(1, -(-total // (every * BLOCK)))
    queries = _packed(asked.repartition(blocks, "vec_id"), BLOCK).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    pairs = queries.select(
        "shard", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.col("width").alias("q_width"),
    ).join(index, "shard").repartition(F.xxhash64("shard", "q_ids"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {name: batch.column(name)[row] for name in batch.schema.names}
                widths = cell["q_width"].as_py(), cell["width"].as_py()
                q_ids, q = _unpacked(cell["q_ids"], cell["q_vectors"], widths[0])
                ids, vectors = _unpacked(cell["ids"], cell["vectors"], widths[1])
                shard = Shard(ids, _wide(vectors, max(widths)))
                for number, at, score in shard.search(q_ids, _wide(q, max(widths)), k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[number]), pa.array(shard.ids[at]), pa.array(score)],
                        ["query_id", "vec_id", "score"],
                    )

    found = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
