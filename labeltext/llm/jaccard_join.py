"""Near duplicates by n-gram Jaccard similarity: grouped prefix join.

A document is the set of its distinct word shingles. Two documents link when the Jaccard
similarity of their sets reaches a threshold; the result is their connected components.

1. Every shingle gets a place in one global order, rare ones first, from a table of counts of
   fixed size over all documents. A set's *prefix* is its first shingles in that order; sets
   similar enough share a shingle of their prefixes.
2. Documents with equal sets form one class, classes with equal prefix and size one *group*.
   An inverted index over the prefixes pairs groups, not documents; pairs whose sizes differ
   too much, whose common shingle stands too late, or whose histograms of codes overlap too
   little are filtered.
3. Pairs are expanded to classes and verified on the full sets.

Only components are asked for, so a bucket of the index with many groups (a cluster of near
copies) is linked along a chain and to its first members; then just pairs whose members are
in different components yet are compared, all of them. No link that joins two components
is lost, and a large cluster doesn't cost the square of its size.

Null or blank text: no shingles, alone in its component. Rows with equal ``doc_id`` are each
kept; a null ``doc_id`` joins like any other row and never names a component, unless all of
the component's are null. Other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, MapType, StructField, StructType

from labeltext.llm.shared import (
    by_bin,
    components,
    count_cells,
    discard,
    releasing,
    shuffle_partitions,
    squeeze,
    stored,
    unsqueeze,
)
from labeltext.llm.words import WHITE, batch_words, mix, row_shingles
from labeltext.session import cut_lineage

SHINGLE = 5
PERCENT = 75
# Size of the table of shingle counts; larger tables order shingles more finely.
RARITY_BITS = 20
# Index entries that one task holds.
BIN_ENTRIES = 400_000
# Index entries, rounded to whole buckets, that are paired at a time.
SLICE = 50_000
# Groups in a bucket up to which all pairs are taken at once, and first members each other
# one is paired with beyond.
SMALL_BUCKET, PIVOTS = 4, 3
FILTER_BITS = 20
# Cells of the histogram of a set's codes: the sum of the smaller counts bounds an overlap.
CELLS = 128
# Members that one task compares with as many others.
BLOCK = 1500

# Bytes of a code in the index: enough to tell codes of one bin apart nearly always. Codes
# that are taken for one another cost a comparison, no more.
CODE_BYTES = 6

_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _ceil(n: np.ndarray, over: int, under: int) -> np.ndarray:
    return (n * over + under - 1) // under


def _set_keys(row: np.ndarray, code: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes and 128-bit keys, equal for equal sets."""
    size = np.bincount(row, minlength=rows)
    key = np.zeros((rows, 2), np.uint64)
    full = np.flatnonzero(size)
    if len(full):
        first = np.flatnonzero(np.diff(row, prepend=-1))
        key[full, 0] = np.add.reduceat(mix(code), first)
        key[full, 1] = np.add.reduceat(mix(code ^ _OTHER), first)
    return size, key


def _histograms(row: np.ndarray, code: np.ndarray, rows: int) -> np.ndarray:
    at = row * CELLS + (code & np.uint64(CELLS - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=rows * CELLS), 255).astype(np.uint8)


def _binaries(values: np.ndarray, width: int) -> pa.Array:
    """Rows of ``width`` bytes each."""
    raw = np.ascontiguousarray(values).tobytes()
    fixed = pa.Array.from_buffers(
        pa.binary(width), len(raw) // width, [None, pa.py_buffer(raw)]
    )
    return fixed.cast(pa.binary())


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _packed(code: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Rows of codes, each cut to its last bytes; ``sizes`` are the rows' bytes."""
    code = code & np.uint64((1 << (8 * CODE_BYTES - 1)) - 1)
    raw = np.ascontiguousarray(code.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())]
    )


def _short(code: np.ndarray) -> bytes:
    """Codes cut to 48 bits: two sets of a thousand codes take different ones for equal once
    in a hundred million pairs."""
    return np.ascontiguousarray(code.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _long(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 6)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, 2:] = raw
    return full.reshape(-1).view("<u8")


def _similar_enough(n_a, n_b, overlap, percent: int):
    """Whether an overlap reaches the threshold: 100 * overlap >= percent * union."""
    return (100 + percent) * overlap >= percent * (n_a + n_b)


def _may_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least the overlap of the sets with these histograms. A full cell holds any number."""
    least = np.minimum(a, b)
    return least.sum(axis=1, dtype=np.int64) + np.where((least == 255).any(axis=1), 1 << 40, 0)


def _records(docs: DataFrame, counts: np.ndarray, bits: int, shingle: int, percent: int):
    """A row per document: ``rid`` numbers it, ``key`` is its set's, ``prefix`` the codes of
    its prefix, only on the first document of its group among those cut together."""
    rank = np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for lo, hi, words in batch_words(batch.column("text"), WHITE, lower=True):
                row, code = row_shingles(words, shingle)
                size, key = _set_keys(row, code, hi - lo)
                order = np.lexsort((code, rank[code >> np.uint64(64 - bits)], row))
                code = code[order]
                first = np.cumsum(size) - size
                place = np.arange(len(code)) - first[row]
                length = np.where(size > 0, size - _ceil(size, percent, 100) + 1, 0)
                kept = place < length[row]
                prefix = code[kept]
                group = np.zeros(hi - lo, np.uint64)
                edges = np.concatenate([[0], np.cumsum(length)])
                full = np.flatnonzero(length)
                if len(full):
                    # Which codes and, through mix(), in which places.
                    at = mix(prefix + place[kept].astype(np.uint64) * _OTHER)
                    group[full] = mix(
                        np.add.reduceat(at, edges[full]) + size[full].astype(np.uint64)
                    )
                lone = np.zeros(hi - lo, bool)
                lone[np.unique(group, return_index=True)[1]] = True
                lone &= length > 0
                shown = np.where(lone, length, 0) * CODE_BYTES
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(base + done + np.arange(hi - lo), pa.int64()),
                        batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()),
                        pa.array(size, pa.int64()),
                        _binaries(key, 16),
                        _binaries(_histograms(row, code, hi - lo), CELLS),
                        pa.array(group.view(np.int64), pa.int64()),
                        _packed(prefix[np.repeat(lone, length)], shown),
                    ],
                    ["rid", "doc_id", "n", "key", "cells", "grp", "prefix"],
                )
                done += hi - lo

    return docs.select("doc_id", "text").mapInArrow(
        releasing(cut),
        "rid long, doc_id long, n long, key binary, cells binary, grp long, prefix binary",
    )


def _may_link(n_a, n_b, place_a, place_b, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar, given the places of a common code in their
    prefixes, if that is their first common code. A similar pair has a common code for which
    this holds, its first."""
    left = 1 + np.minimum(n_a - place_a - 1, n_b - place_b - 1)
    return _similar_enough(n_a, n_b, left, percent) & _similar_enough(
        n_a, n_b, np.minimum(n_a, n_b), percent
    )


def _candidates(records: DataFrame, percent: int) -> DataFrame:
    """Rows of two kinds from the inverted index over the prefixes: ``kind`` 0, a pair of
    documents that stand for their groups; ``kind`` 1, a member (y) of a large bucket (x), in
    whose prefix the bucket's code has place ``place``."""
    spark = records.sparkSession
    held = records.where("length(prefix) > 0").select("rid", "n", "prefix")
    entries = (held.agg(F.sum(F.length("prefix"))).first()[0] or 0) // CODE_BYTES
    bins = max(2 * shuffle_partitions(spark), -(-entries // BIN_ENTRIES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            length = pc.binary_length(lists).to_numpy() // CODE_BYTES
            code = np.zeros((int(length.sum()), 8), np.uint8)
            code[:, :CODE_BYTES] = _fixed(lists, CODE_BYTES)
            code = code.reshape(-1).view("<u8")
            rid = np.repeat(batch.column("rid").to_numpy(), length)
            n = np.repeat(batch.column("n").to_numpy(), length)
            place = np.arange(len(code)) - np.repeat(np.cumsum(length) - length, length)
            at = (code & np.uint64(0xFFFFFF)) * np.uint64(bins) >> np.uint64(24)
            order, names, first = by_bin(at.astype(np.int64))
            code, rid, n, place = code[order], rid[order], n[order], place[order]
            spans = list(zip(first[:-1], first[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int32()),
                    pa.array([squeeze(code[a:b], delta=False) for a, b in spans], pa.binary()),
                    pa.array([squeeze(rid[a:b]) for a, b in spans], pa.binary()),
                    pa.array([squeeze(n[a:b]) for a, b in spans], pa.binary()),
                    pa.array([squeeze(place[a:b], delta=False) for a, b in spans], pa.binary()),
                ],
                ["bin", "code", "rid", "n", "place"],
            )

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[], [], [], []]
        for batch in batches:
            for code, rid, n, place in zip(*(batch.column(k) for k in (1, 2, 3, 4)), strict=True):
                parts[0].append(unsqueeze(code.as_buffer(), delta=False))
                parts[1].append(unsqueeze(rid.as_buffer()))
                parts[2].append(unsqueeze(n.as_buffer()))
                parts[3].append(unsqueeze(place.as_buffer(), delta=False))
        if not parts[0]:
            return
        code, rid, n, place = (np.concatenate(x) for x in parts)
        del parts
        order = np.lexsort((rid, code))
        code, rid, n, place = code[order], rid[order], n[order], place[order]
        # Slices of whole buckets, so that what is made of them stays small.
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        cuts = first[np.searchsorted(first, np.arange(0, len(code), SLICE))[1:] - 1]
        cuts = np.unique(np.concatenate([[0], cuts, [len(code)]]))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            for kind, x, y, late in paired(code[lo:hi], rid[lo:hi], n[lo:hi], place[lo:hi]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), kind, np.int32)),
                        pa.array(x),
                        pa.array(y),
                        pa.array(late),
                    ],
                    ["kind", "x", "y", "place"],
                )

    def paired(code, rid, n, place):
        """The two kinds of rows of some buckets, ordered by code and number."""
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        many = np.diff(np.append(first, len(code)))
        start, many = np.repeat(first, many), np.repeat(many, many)
        at = np.arange(len(code))
        found = []
        for step in range(1, SMALL_BUCKET):
            i = at[: max(0, len(at) - step)]
            ok = start[i] == start[i + step] if len(i) else np.zeros(0, bool)
            if step > 1:
                ok &= many[i] <= SMALL_BUCKET
            found.append((i[ok], i[ok] + step))
        for k in range(PIVOTS):
            i = at[(many > SMALL_BUCKET) & (at > start + k)]
            found.append((start[i] + k, i))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        ok = _may_link(n[a], n[b], place[a], place[b], percent) & (rid[a] != rid[b])
        x, y = rid[a[ok]], rid[b[ok]]
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        yield 0, x[new], y[new], np.zeros(int(new.sum()), np.int64)
        large = many > SMALL_BUCKET
        yield 1, code[large].astype(np.int64), rid[large], place[large]

    packed = held.mapInArrow(releasing(deal), "bin int, code binary, rid binary, n binary, place binary")
    return packed.repartitionById(bins, "bin").mapInArrow(
        releasing(pair), "kind int, x long, y long, place long"
    )


def _overlapping(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose histograms allow that they are similar."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_fixed(batch.column(k), CELLS) for k in ("left", "right"))
            n_a, n_b = (batch.column(k).to_numpy() for k in ("n_a", "n_b"))
            ok = _similar_enough(n_a, n_b, _may_overlap(a, b), percent)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = classes.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("cells").alias("left"))
    right = classes.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("cells").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "left", "right")
    return both.mapInArrow(releasing(keep), "a long, b long")


def _across(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one bucket, but of different components, that may be
    similar. Large buckets are cut into blocks, and each task compares two blocks."""
    open_ = members.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
    ).where("low < high").select("bucket", "blocks")
    dealt = (
        members.join(open_, "bucket").join(classes.select("cls", "n", "cells"), "cls")
        .withColumn("own", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0)
            .otherwise(1).alias("side"),
            "cls", "n", "place", "component", "cells",
        )
    )
    # One task may get several buckets; rows of one are next to each other.
    dealt = dealt.repartition("task").sortWithinPartitions("task")

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cls, n, place, component, side = (
            rows[k].to_numpy() for k in ("cls", "n", "place", "component", "side")
        )
        cells = _fixed(rows["cells"].combine_chunks(), CELLS)
        for i in np.flatnonzero(side != 1):
            j = np.flatnonzero((side != 0) if side[i] == 0 else (np.arange(len(cls)) > i))
            j = j[component[j] != component[i]]
            j = j[_may_link(n[i], n[j], place[i], place[j], percent)]
            j = j[_similar_enough(n[i], n[j], _may_overlap(cells[i], cells[j]), percent)]
            if len(j):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(cls[i], cls[j])), pa.array(np.maximum(cls[i], cls[j]))],
                    ["a", "b"],
                )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            task = batch.column("task").to_numpy()
            first = [0, *np.flatnonzero(np.diff(task)) + 1, len(task)]
            for a, b in zip(first[:-1], first[1:], strict=True):
                if held and held[0].column("task")[0].as_py() != task[a]:
                    yield from compare(pa.Table.from_batches(held))
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from compare(pa.Table.from_batches(held))

    return dealt.mapInArrow(releasing(pairs), "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int):
    """The pairs (a, b) of classes whose full sets are similar enough."""
    used = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    used = cut_lineage(used.join(classes.select("cls", "key"), "cls"))
    bits = FILTER_BITS

    def cell(key: pa.Array) -> np.ndarray:
        raw = np.frombuffer(b"".join(key.to_pylist()), np.uint64)[::2]
        return (raw >> np.uint64(64 - bits)).astype(np.int64)

    # Texts no pair needs aren't moved: a filter of fixed size that never misses a key.
    wanted = count_cells(
        used.select("key"), 1 << bits, lambda batch: iter([cell(batch.column("key"))])
    )
    wanted = np.packbits(wanted > 0)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = np.unpackbits(wanted).astype(bool)
        for batch in batches:
            for lo, hi, words in batch_words(batch.column("text"), WHITE, lower=True):
                row, code = row_shingles(words, shingle)
                size, key = _set_keys(row, code, hi - lo)
                edges = np.concatenate([[0], np.cumsum(size)])
                use = (size > 0) & test[(key[:, 0] >> np.uint64(64 - bits)).astype(np.int64)]
                rows = np.flatnonzero(use)
                rows = rows[np.unique(key[rows, 0], return_index=True)[1]]
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [
                            _binaries(key[rows], 16),
                            pa.array(
                                [_short(code[edges[k] : edges[k + 1]]) for k in rows],
                                pa.binary(),
                            ),
                        ],
                        ["key", "codes"],
                    )

    held = docs.select("text").mapInArrow(releasing(sets), "key binary, codes binary")
    held = held.dropDuplicates(["key"]).join(used, "key").select("cls", "codes")
    held = stored(held)

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("left"), batch.column("right"), strict=True):
                a, b = _long(a.as_buffer()), _long(b.as_buffer())
                joint = np.concatenate([a, b])
                joint.sort(kind="stable")
                common = int((joint[1:] == joint[:-1]).sum())
                ok.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(held.select(F.col("cls").alias("a"), F.col("codes").alias("left")), "a")
    both = both.join(held.select(F.col("cls").alias("b"), F.col("codes").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(releasing(similar), "a long, b long")


def _labelled(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """A stored row per row of ``docs``: doc_id, n (set size), key of the set, and component,
    null without shingles. Tables made on the way are removed when nothing reads them."""
    bits = RARITY_BITS

    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, words in batch_words(batch.column("text"), WHITE, lower=True):
            code = row_shingles(words, shingle)[1]
            yield (code >> np.uint64(64 - bits)).astype(np.int64)

    counts = count_cells(docs.select("text"), 1 << bits, cells)
    records = stored(_records(docs, counts, bits, shingle, percent))
    rows = stored(records.select("rid", "doc_id", "n", "key", "grp"))
    sets = rows.where("n > 0").groupBy("key", "n", "grp").agg(F.min("rid").alias("cls"))
    groups = sets.groupBy("grp", "n").agg(F.min("cls").alias("gid"), F.count("*").alias("classes"))
    shown = records.select(F.col("rid").alias("cls"), "cells")
    classes = stored(
        sets.join(groups, ["grp", "n"]).join(shown, "cls")
        .select("cls", "key", "n", "gid", "classes", "cells")
    )
    owner = rows.join(classes.select("key", "cls", "gid"), "key").select("rid", "gid")

    found = stored(_candidates(records, percent))
    discard(records)
    left = owner.select(F.col("rid").alias("x"), F.col("gid").alias("a"))
    right = owner.select(F.col("rid").alias("y"), F.col("gid").alias("b"))
    pairs = (
        found.where("kind = 0").select("x", "y").distinct().join(left, "x").join(right, "y")
        .where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    pairs = stored(pairs)
    inner = classes.where("cls <> gid").select(F.col("gid").alias("a"), F.col("cls").alias("b"))
    likely = stored(_overlapping(pairs.union(inner), classes, percent))
    links = cut_lineage(_verified(likely, docs, classes, shingle, percent))

    # What may still join two components: members of large buckets, of groups with several
    # classes, and of pairs of groups of which one has several.
    labels = cut_lineage(components(links))
    named = cut_lineage(
        classes.select("cls", "gid", "classes")
        .join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "gid", "classes", F.coalesce("component", "cls").alias("component"))
    )
    reach = named.groupBy("gid").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.max("classes").alias("classes"),
    )
    entries = (
        found.where("kind = 1")
        .select(F.col("x").alias("bucket"), F.col("y").alias("rid"), "place")
        .join(owner.join(reach, "gid"), "rid")
        .select("bucket", "gid", "place", "low", "high")
        .repartition("bucket")
    )
    mixed = entries.groupBy("bucket").agg(F.min("low").alias("a"), F.max("high").alias("b"))
    buckets = (
        entries.join(mixed.where("a < b").select("bucket"), "bucket", "left_semi")
        .groupBy("bucket", "gid").agg(F.min("place").alias("place"))
    )
    several = named.where("classes > 1").select("gid").distinct()
    whole = several.select(F.col("gid").alias("bucket"), "gid")
    wide = pairs.join(several.withColumnRenamed("gid", "a"), "a", "left_semi").union(
        pairs.join(several.withColumnRenamed("gid", "b"), "b", "left_semi").select("a", "b")
    ).distinct()
    name = F.xxhash64("a", "b").alias("bucket")
    whole = whole.union(wide.select(name, "a")).union(wide.select(name, "b"))
    buckets = buckets.union(whole.select("bucket", "gid", F.lit(0).cast("long")))
    members = stored(
        buckets.join(named.select("gid", "cls", "component"), "gid")
        .select("bucket", "cls", "place", "component")
    )
    rest = _across(members, classes, percent).join(likely, ["a", "b"], "left_anti")
    rest = cut_lineage(rest)
    if not rest.isEmpty():
        links = links.union(_verified(rest, docs, classes, shingle, percent))
        labels = cut_lineage(components(links))

    final = classes.select("key", "cls").join(
        labels.withColumnRenamed("node", "cls"), "cls", "left"
    ).select("key", F.coalesce("component", "cls").alias("component"))
    labelled = stored(rows.join(final, "key", "left").select("doc_id", "n", "key", "component"))
    for table in (rows, classes, found, pairs, likely, members):
        discard(table)
    return labelled


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id that links lead to) of each row."""
    labelled = _labelled(docs, shingle, percent)
    least = labelled.where("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id")
    )
    return labelled.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that with the smallest
    doc_id (null ids last), of several such the first by the key of its set and then by text.
    Rows are told apart by doc_id and set, so a row with another text stays whatever becomes of
    a row with the same id. Rows without shingles all stay.

    Only rows that may go are moved: a filter of fixed size over their ids, which never misses
    one, tells the others apart. Copies collapse within tasks before they meet."""
    labelled = _labelled(docs, shingle, percent).where("component is not null")
    who = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    first = labelled.groupBy("component").agg(F.min(who).alias("first"))
    verdict = labelled.groupBy("doc_id", "key").agg(
        F.count("*").alias("rows"), F.first("component").alias("component")
    ).join(first, "component")
    verdict = verdict.select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_set"), "rows", (who == F.col("first")).alias("_stays")
    ).where("rows > 1 or not _stays").drop("rows")
    verdict = cut_lineage(verdict)
    bits = FILTER_BITS

    def cells(ids: pa.Array) -> np.ndarray:
        known = pc.fill_null(ids.cast(pa.int64()), 0).to_numpy().astype(np.uint64)
        return (mix(known) >> np.uint64(64 - bits)).astype(np.int64)

    table = np.packbits(
        count_cells(verdict.select("_id"), 1 << bits, lambda batch: iter([cells(batch.column("_id"))])) > 0
    )

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = np.unpackbits(table).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(~test[cells(batch.column("doc_id"))]))

    # Rows that may go, with their sets' keys.
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = np.unpackbits(table).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(test[cells(batch.column("doc_id"))]))
            for lo, hi, words in batch_words(batch.column("text"), WHITE, lower=True):
                row, code = row_shingles(words, shingle)
                size, key = _set_keys(row, code, hi - lo)
                keys = [k if n else None for k, n in zip(_binaries(key, 16).to_pylist(), size, strict=True)]
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys, pa.binary())], [*names, "_set"])

    names = docs.columns
    kinds = StructType([*docs.schema.fields, StructField("_set", BinaryType())])
    asked = docs.mapInArrow(releasing(keyed), kinds)
    plain = [f.name for f in docs.schema if not isinstance(f.dataType, MapType)]
    order = F.struct(F.col("text").isNull(), F.md5("text"), F.xxhash64(*plain))
    once = asked.where("_set is not null").groupBy(F.col("doc_id").alias("_own"), "_set").agg(
        F.min_by(F.struct(*names), order).alias("_row")
    )
    once = once.join(
        verdict.withColumnRenamed("_set", "_key"),
        F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_set") == F.col("_key")), "left",
    ).where("_stays or _stays is null").select("_row.*")
    kept = docs.mapInArrow(releasing(others), docs.schema)
    return kept.union(asked.where("_set is null").select(names)).union(once)
