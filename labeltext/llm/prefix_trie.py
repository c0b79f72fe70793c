"""The prefix trie of conversations, by collapsing whole sequences.

1. Conversations are rebuilt: conversation c begins with the first h original turns of the
   conversation c - c % 5, h = crc32(decimal c) % 9, and goes on with its own after its first h.
2. Identical rebuilt conversations collapse into one *sequence* with a weight, the smallest
   conv_id and a list of ends. Everything later counts sequences, not conversations.
3. A sequence that is a proper prefix of another isn't a leaf: sequences whose last node is an
   inner node of another go by an anti-join; the rest are the trie's leaves.
4. Weighted prefixes are added up by node.

A turn is known by a 128-bit digest of its role and text, a node by a chained 128-bit digest of
its turns; texts aren't moved. A conversation's turns pass one task in order, one at a time.
Sums over subtrees don't go from node to node: every node belongs to the leaf sequence with the
smallest conv_id through it, each leaf sequence adds up its own nodes from its end to its root,
and the sums at a node of all leaf sequences through it make the subtree's. So work grows with
the turns, also for long conversations. No join is keyed by a node that many rows share: the
few parents with very many children are joined by a broadcast of at most ``HOT_PARENTS`` rows.
Ends are packed by ranges of conv_id and hashed as a stream.

Turns are ordered by ``turn``, null first, equal ones by their digest. A null role or text is
empty. Rows without a conv_id belong to no conversation. A repeated row is a turn of its own.
c % 5 has the sign of c. Other columns are ignored. An empty table has no nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.llm.shared import stored

GROUP, MOST = 5, 9
# Conversation ids in one packed list of ends.
ENDS = 1 << 14
HOT_PARENTS = 1000
ROOT = hashlib.sha256(b"root").digest()[:16]


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place from 0, digest and text bytes of each original turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(F.encode(whole, "UTF-8"), 256)), 1, 16)
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest", "bytes")
    return slim.select(
        "conv_id", (F.row_number().over(order) - 1).alias("place"), "digest", "bytes"
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """A row per node of each rebuilt conversation, its root included: conv_id, depth, node,
    parent, bytes, and whether it is the conversation's ``end``."""
    turns = stored(_turns(conversations))
    shared = lambda c: (F.crc32(F.encode(F.col(c).cast("string"), "UTF-8")) % MOST).cast("int")
    ids = turns.where("place = 0").select("conv_id")
    none = F.lit(None).cast("binary"), F.lit(0).cast("long")
    # One row each that stands before all turns, so that turnless conversations show.
    starts = ids.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("place"), *none)
    own = turns.where(F.col("place") >= shared("conv_id")).select(
        "conv_id", F.lit(2), "place", "digest", "bytes"
    )
    # The first turns, at most MOST - 1, of every fifth conversation, for those that share them.
    base = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("place") < MOST - 1))
    near = F.sequence(F.col("conv_id") - (GROUP - 1), F.col("conv_id") + (GROUP - 1))
    taken = base.select(F.col("conv_id").alias("base"), F.explode(near).alias("conv_id"), "place", "digest", "bytes")
    taken = taken.where(
        (F.col("conv_id") - F.col("conv_id") % GROUP == F.col("base")) & (F.col("place") < shared("conv_id"))
    ).join(ids, "conv_id", "left_semi").select("conv_id", F.lit(1), "place", "digest", "bytes")
    rows = starts.union(taken).union(own).repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row; it is an end if the next one begins a conversation
        node, depth = ROOT, 0
        for batch in batches:
            out = []
            for conv, part, digest, size in zip(
                *(batch.column(k).to_pylist() for k in (0, 1, 3, 4)), strict=True
            ):
                if part == 0:
                    row = (conv, 0, ROOT, None, 0)
                    node, depth = ROOT, 0
                else:
                    parent, depth = node, depth + 1
                    node = hashlib.sha256(parent + digest).digest()[:16]
                    row = (conv, depth, node, parent, size)
                if held is not None:
                    out.append((*held, part == 0))
                held = row
            if out:
                yield nodes_of(out)
        if held is not None:
            yield nodes_of([(*held, True)])

    def nodes_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["conv_id", "depth", "node", "parent", "bytes", "end"],
        )

    return rows.mapInArrow(
        chain, "conv_id long, depth long, node binary, parent binary, bytes long, end boolean"
    )


def sequences(rows: DataFrame) -> DataFrame:
    """The distinct sequences of ``rebuilt`` rows: node (the last), weight (how many
    conversations are it) and conv_id, the smallest of these."""
    return rows.where("end").groupBy("node").agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")
    )


def end_lists(rows: DataFrame) -> DataFrame:
    """The conversations that end at each node: node, chunk (a range of ids) and ids, sorted.
    A list holds at most ``ENDS`` ids; a node has as many lists as it needs."""
    chunk = F.floor(F.col("conv_id") / ENDS).cast("long").alias("chunk")
    return rows.where("end").groupBy("node", chunk).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids")
    )


def _ends_digest(lists: DataFrame) -> DataFrame:
    """SHA-256 of each node's ids, in order and comma-joined; lists pass one at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, total = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids"), strict=True):
                text = ",".join(map(str, ids.as_py())).encode()
                if name == node:
                    total.update(b"," + text)
                else:
                    if node is not None:
                        out.append((node, total.hexdigest()))
                    node, total = name, hashlib.sha256(text)
            if out:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*out, strict=True))], ["node", "ends"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([total.hexdigest()])], ["node", "ends"])

    rows = lists.repartition("node").sortWithinPartitions("node", "chunk")
    return rows.select("node", "ids").mapInArrow(digest, "node binary, ends string")


def trie(conversations: DataFrame) -> DataFrame:
    """Every node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256."""
    rows = stored(rebuilt(conversations))
    whole = stored(sequences(rows))
    paths = rows.join(
        whole.select("conv_id", "weight", F.col("node").alias("last")), "conv_id"
    )
    # Inner nodes of sequences; a sequence that ends at one is a proper prefix of another.
    inner = paths.where("not end").select("node").distinct()
    leaves = whole.join(inner, "node", "left_anti").select("conv_id", F.lit(True).alias("leaf"))
    paths = stored(paths.join(leaves, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False))))
    nodes = stored(
        paths.groupBy("node").agg(
            F.first("depth").alias("depth"), F.first("parent").alias("parent"),
            F.first("bytes").alias("bytes"), F.sum("weight").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("owner"),
            F.count_if("leaf").alias("n_leaves"),
        )
    )
    # What each node saves, on the path of the leaf sequence it belongs to; then sums from the
    # end of each such path.
    saving = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    steps = paths.where("leaf").select("conv_id", "depth", "node", F.lit(0).cast("long").alias("saved")).union(
        nodes.select(F.col("owner"), "depth", F.lit(None).cast("binary"), saving)
    )
    below = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    steps = steps.withColumn("sum", F.sum("saved").over(below)).where("node is not null")
    saved = steps.groupBy("node").agg(F.sum("sum").alias("saved_tokens"))

    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")
    )
    ends = _ends_digest(end_lists(rows))
    table = stored(
        nodes.drop("bytes", "owner").join(saved, "node").join(children, "node", "left")
        .join(ends, "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    )
    # Parents of more than a thousandth of all nodes are under a thousand.
    least = table.count() // HOT_PARENTS + 1
    names = table.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
        (F.col("n_children") >= least).alias("hot"),
    )
    hot = names.where("hot").withColumnRenamed("parent_conv_id", "hot_id").drop("hot")
    table = table.join(F.broadcast(hot), "parent", "left")
    cold = table.where("hot_id is null").join(names.where("not hot").drop("hot"), "parent", "left")
    near = table.where("hot_id is not null").withColumn("parent_conv_id", F.col("hot_id"))
    return near.unionByName(cold).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
