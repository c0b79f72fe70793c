"""Phrase collocations by SETM: relations of occurrences, joined by piece and position.

Level k is a persisted relation: in which piece and position each frequent phrase of k words
occurs, sorted by both, in blocks. A level is made of the one before:

* *merge-join*: an occurrence at a position and one at the next position of the same piece make
  an occurrence of one word more. Both are in the same sorted block;
* *group-count*: blocks count their distinct phrases, Spark sums these counts and keeps the
  *frequent groups*;
* *semi-join*: occurrences of other phrases are left out before the next level is made. Words
  are joined exactly, and get numbers. Longer phrases are tested by a filter of fixed size that
  misses none: what it lets through beyond the frequent ones fails the next count, as no phrase
  is more frequent than its parts. So no occurrence is shuffled by its phrase.

A phrase is named exactly, never by a hash: a word by its language and itself, longer ones by
the numbers of their words. A block holds the pieces of about ``BLOCK_BYTES`` of text, packed;
texts are cut once and not moved. What is shuffled is a row per task and distinct phrase, so no
phrase's occurrences are gathered anywhere, and once, for the words, the blocks.

Lower-cased are A-Z. Texts are split at ``.,;:!?`` and at line ends into pieces, these at spaces
and tabs into words. Everything is counted per language; a null language is ``und`` (as is that
name itself), a null text has no words. Rows with equal ids all count; other columns are
ignored; an empty table has no phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.llm.shared import discard, shuffle_partitions, squeeze, stored, unsqueeze
from labeltext.llm.words import mix, row_chunks, text_bytes

LONGEST = 5
LEAST = 100
FIRST = 2000
UNKNOWN = "und"
BLOCK_BYTES = 3_000_000
BATCH = 100_000

SPLITS = np.zeros(256, bool)
SPLITS[[*b".,;:!?\n\x0b\x0c\r"]] = True
BETWEEN = SPLITS.copy()
BETWEEN[[*b" \t"]] = True

FILTER_BITS = 24
# Distinct phrases of blocks, one for each block, that one task adds up.
BIN_PHRASES = 1_000_000
# Rows of the first relation are of two kinds: a block's occurrences, packed, and its distinct
# words with the index by which ``which`` names them.
FIRST_ROWS = "block long, place binary, which binary, at long, lang string, word string, n long"
# ``names`` holds the words' numbers of each distinct phrase, all first words first.
ROWS = "block long, size long, place binary, which binary, names binary"


def _words(column: pa.Array, lang: pa.Array) -> Iterator[tuple]:
    """Per block: positions, two apart between pieces; index of each occurrence; and the
    distinct (lang, word) with their counts."""
    data, edges = text_bytes(column)
    for lo, hi in row_chunks(edges, BLOCK_BYTES):
        part, rows = data[edges[lo] : edges[hi]], edges[lo : hi + 1] - edges[lo]
        inside = ~BETWEEN[part]
        if not inside.any():
            continue
        change = np.zeros(len(part) + 1, bool)
        change[rows] = True
        opens = inside & (change[:-1] | ~np.concatenate([[False], inside[:-1]]))
        start = np.flatnonzero(opens)
        row = np.searchsorted(rows, start, side="right") - 1
        # The words' bytes, one after the other.
        letters = part[inside]
        upper = (letters >= 0x41) & (letters <= 0x5A)
        letters = np.where(upper, letters + 32, letters).astype(np.uint8)
        count = np.concatenate([[0], np.cumsum(inside, dtype=np.int32)])
        offsets = np.append(count[start], count[-1]).astype(np.int32)
        found = pa.StringArray.from_buffers(
            len(start), pa.py_buffer(offsets), pa.py_buffer(letters)
        ).dictionary_encode()
        langs = lang.slice(lo, hi - lo).dictionary_encode()
        pair = langs.indices.to_numpy().astype(np.int64)[row] * len(found.dictionary)
        pair += found.indices.to_numpy()
        name, which, many = np.unique(pair, return_inverse=True, return_counts=True)
        piece = (np.cumsum(SPLITS[part], dtype=np.int32))[start] + row
        place = np.arange(len(start)) + piece - piece[0]
        names = [
            langs.dictionary.take(pa.array(name // len(found.dictionary))),
            found.dictionary.take(pa.array(name % len(found.dictionary))),
        ]
        yield place, which, names, many


def _rows(block: int, place: np.ndarray, which: np.ndarray, names: list, many: np.ndarray) -> pa.Table:
    def padded(value, kind: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.array([value], kind), pa.nulls(len(many), kind)])

    columns = [
        pa.array(np.full(len(many) + 1, block)),
        padded(squeeze(place), pa.binary()),
        padded(squeeze(which, delta=False), pa.binary()),
        *(pa.concat_arrays([pa.nulls(1, x.type), x]) for x in (pa.array(np.arange(len(many))), *names, pa.array(many, pa.int64()))),
    ]
    return pa.Table.from_arrays(columns, [f"_{k}" for k in range(len(columns))])


def words(docs: DataFrame) -> DataFrame:
    """Every word of every piece, and the distinct words of each block."""
    names = ["block", "place", "which", "at", "lang", "word", "n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            lang = pc.fill_null(batch.column("lang").cast(pa.string()), UNKNOWN)
            for found in _words(batch.column("text"), lang):
                yield from _rows(block, *found).rename_columns(names).to_batches(BATCH)
                block += 1

    return docs.select("text", "lang").mapInArrow(cut, FIRST_ROWS)


def _occurrences(block: int, place: np.ndarray, which: np.ndarray, names: np.ndarray) -> pa.Table:
    values = [squeeze(place), squeeze(which, delta=False), squeeze(names.reshape(-1), delta=False)]
    return pa.table(
        [pa.array([block]), pa.array([len(place)]), *(pa.array([v], pa.binary()) for v in values)],
        ["block", "size", "place", "which", "names"],
    )


def frequent_words(relation: DataFrame, numbers: DataFrame) -> DataFrame:
    """The relation of level 1. ``numbers`` has a row per block and frequent word in it: block,
    ``at`` (its index in the block) and id."""

    def choose(block: pa.Table, known: pa.Table) -> pa.Table:
        if not block.num_rows or not known.num_rows:
            return _occurrences(0, *[np.zeros(0, np.int64)] * 3).slice(0, 0)
        at, ids = (known[n].to_numpy() for n in ("at", "id"))
        place = unsqueeze(block["place"][0].as_buffer())
        which = unsqueeze(block["which"][0].as_buffer(), delta=False)
        index = np.full(max(int(which.max()), int(at.max())) + 1, -1)
        index[at] = np.arange(len(at))
        which = index[which]
        return _occurrences(block["block"][0].as_py(), place[which >= 0], which[which >= 0], ids)

    blocks = relation.where("place is not null").select("block", "place", "which")
    numbers = numbers.select(F.col("block").alias("of"), "at", "id")
    return blocks.groupBy("block").cogroup(numbers.groupBy("of")).applyInArrow(choose, ROWS)


def _merged(batch: pa.RecordBatch, length: int) -> Iterator[tuple]:
    """Merge-join of each block with itself, one position on: block, places, index of each
    occurrence, names (a row per word) and counts of the phrases of ``length`` + 1 words."""
    for k in range(batch.num_rows):
        place = unsqueeze(batch.column("place")[k].as_buffer())
        which = unsqueeze(batch.column("which")[k].as_buffer(), delta=False)
        names = unsqueeze(batch.column("names")[k].as_buffer(), delta=False).reshape(length, -1)
        next_to = np.flatnonzero(np.diff(place) == 1)
        if not len(next_to):
            continue
        size = names.shape[1]
        pair = which[next_to] * size + which[next_to + 1]
        pair, which, many = np.unique(pair, return_inverse=True, return_counts=True)
        longer = np.concatenate([names[:, pair // size], names[-1:, pair % size]])
        yield batch.column("block")[k].as_py(), place[next_to], which, longer, many


def count(relation: DataFrame, length: int, least: int) -> DataFrame:
    """The frequent groups of ``length`` + 1 words that the relation of ``length`` words
    makes: ids, an array of the words' numbers, and f. Blocks pack their distinct phrases by
    bin; there are as many bins as keep one in a task's memory, and a phrase is at most once
    in a block."""
    total = relation.agg(F.sum("size")).first()[0] or 0
    bins = max(shuffle_partitions(relation.sparkSession), -(-total // BIN_PHRASES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, names, many in _merged(batch, length):
                bin_ = (_code(names) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
                order = np.lexsort((*names[::-1], bin_))
                names, many, bin_ = names[:, order], many[order], bin_[order].astype(np.int64)
                first = np.flatnonzero(np.diff(bin_, prepend=-1))
                spans = list(zip(first, np.append(first[1:], len(bin_)), strict=True))
                packed = [
                    b"".join(squeeze(row[a:b], delta=k == 0) for k, row in enumerate(names))
                    for a, b in spans
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bin_[first], pa.int64()),
                        pa.array([b - a for a, b in spans], pa.int64()),
                        pa.array(packed, pa.binary()),
                        pa.array([squeeze(many[a:b], delta=False) for a, b in spans], pa.binary()),
                    ],
                    ["bin", "size", "names", "n"],
                )

    def add(part: pa.Table) -> pa.Table:
        sizes = part["size"].to_pylist()
        names = np.empty((length + 1, sum(sizes)), np.int64)
        many = np.concatenate([unsqueeze(n.as_buffer(), delta=False) for n in part["n"]])
        at = 0
        for size, packed in zip(sizes, part["names"], strict=True):
            packed, place = packed.as_buffer(), 0
            for k in range(length + 1):
                end = place + 1 + packed[place] * size
                names[k, at : at + size] = unsqueeze(packed[place:end], delta=k == 0)
                place = end
            at += size
        order = np.lexsort(names[::-1])
        names, many = names[:, order], many[order]
        new = np.ones(at, bool)
        new[1:] = (names[:, 1:] != names[:, :-1]).any(axis=0)
        first = np.flatnonzero(new)
        sums = np.add.reduceat(many, first)
        names, sums = names[:, first[sums >= least]], sums[sums >= least]
        offsets = pa.array(np.arange(len(sums) + 1) * (length + 1), pa.int32())
        ids = pa.ListArray.from_arrays(offsets, pa.array(names.T.reshape(-1)))
        return pa.table({"ids": ids, "f": pa.array(sums)})

    kind = "bin long, size long, names binary, n binary"
    return relation.mapInArrow(deal, kind).groupBy("bin").applyInArrow(add, "ids array<long>, f long")


def _code(names: np.ndarray) -> np.ndarray:
    code = np.zeros(names.shape[1], np.uint64)
    for row in names:
        code = mix(code + row.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return code


def _cells(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the filter for each phrase; names have a row per word."""
    code = _code(names)
    keep = np.uint64((1 << FILTER_BITS) - 1)
    return (code & keep).astype(np.int64), ((code >> np.uint64(FILTER_BITS)) & keep).astype(np.int64)


def filter_of(groups: DataFrame, length: int) -> np.ndarray:
    """A packed bitmap of fixed size that holds every phrase of ``groups``."""
    slabs = 64

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            names = batch.column("ids").flatten().to_numpy().reshape(-1, length).T
            for cell in _cells(names):
                bits[cell] = True
        parts = np.packbits(bits).reshape(slabs, -1)
        full = np.flatnonzero(parts.any(axis=1))
        if len(full):
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([parts[k].tobytes() for k in full], pa.binary())],
                ["slab", "bits"],
            )

    def unite(part: pa.Table) -> pa.Table:
        total = np.zeros((1 << FILTER_BITS) // 8 // slabs, np.uint8)
        for bits in part["bits"]:
            total |= np.frombuffer(bits.as_buffer(), np.uint8)
        return pa.table({"slab": part["slab"][:1], "bits": pa.array([total.tobytes()], pa.binary())})

    kind = "slab int, bits binary"
    out = np.zeros((slabs, (1 << FILTER_BITS) // 8 // slabs), np.uint8)
    for slab, bits in groups.select("ids").mapInArrow(mark, kind).groupBy("slab").applyInArrow(unite, kind).collect():
        out[slab] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def extend(relation: DataFrame, length: int, wanted: np.ndarray) -> DataFrame:
    """The relation of ``length`` + 1 words: the merge-join's occurrences that the filter
    lets through."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = np.unpackbits(wanted).astype(bool)
        for batch in batches:
            for block, place, which, names, _ in _merged(batch, length):
                one, two = _cells(names)
                good = test[one] & test[two]
                index = np.where(good, np.cumsum(good) - 1, -1)
                which = index[which]
                kept = which >= 0
                if kept.any():
                    yield from _occurrences(block, place[kept], which[kept], names[:, good]).to_batches()

    return relation.mapInArrow(merge, ROWS)


def _dense(level: DataFrame) -> DataFrame:
    """Numbers without gaps, which pack better. What is broadcast is a row per partition."""
    part = F.shiftright("id", 33)
    sizes = sorted(level.groupBy(part.alias("part")).count().collect())
    base, rows = 0, []
    for number, size in sizes:
        rows.append((number, base))
        base += size
    bases = level.sparkSession.createDataFrame(rows, "part long, base long")
    dense = level.withColumn("part", part).join(F.broadcast(bases), "part")
    return dense.withColumn("id", F.col("id") - F.shiftleft("part", 33) + F.col("base")).drop("part", "base")


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), the words of each language, and a table of frequent phrases for each length:
    ids, lang, words, f, and f of its first and of its last 1, 2, ... words (``heads``,
    ``tails``)."""
    every = stored(words(docs))
    found = every.where("at is not null").drop("place", "which")
    sizes = stored(found.groupBy("lang").agg(F.sum("n").alias("n")))
    none = F.array().cast("array<bigint>")
    level = stored(
        found.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        .withColumn("id", F.monotonically_increasing_id())
    )
    level = stored(_dense(level))
    numbers = found.join(level.select("lang", "word", "id"), ["lang", "word"])
    relation = stored(frequent_words(every, numbers.select("block", "at", "id")))
    discard(every)
    levels = [
        level.select(
            F.array("id").alias("ids"), "lang", F.array("word").alias("words"), "f",
            none.alias("heads"), none.alias("tails"),
        )
    ]
    for length in range(1, longest):
        groups = stored(count(relation, length, least))
        if length + 1 < longest:
            longer = stored(extend(relation, length, filter_of(groups, length + 1)))
            discard(relation)
            relation = longer
        before = levels[-1]
        first = before.select(
            F.col("ids").alias("head"), "lang", F.col("words").alias("first"),
            F.concat("heads", F.array("f")).alias("heads"),
        )
        last = before.select(
            F.col("ids").alias("tail"), F.element_at("words", -1).alias("word"),
            F.concat("tails", F.array("f")).alias("tails"),
        )
        groups = groups.select(
            "ids", "f", F.slice("ids", 1, length).alias("head"), F.slice("ids", 2, length).alias("tail")
        )
        levels.append(
            stored(
                groups.join(first, "head").join(last, "tail").select(
                    "ids", "lang", F.concat("first", F.array("word")).alias("words"), "f",
                    "heads", "tails", "head", "tail",
                )
            )
        )
    discard(relation)
    return sizes, levels


def scored(sizes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Candidates with the score of their weakest cut. Those inside a longer candidate that is
    as frequent are left out; if any such exists, one is a word longer."""
    out = None
    for k, level in enumerate(levels[1:], start=2):
        if k < len(levels):
            longer = levels[k].select("head", "tail", F.col("f").alias("g"))
            for end in ("head", "tail"):
                cover = longer.select(F.col(end).alias("ids"), F.col("g").alias("f")).distinct()
                level = level.join(cover, ["ids", "f"], "left_anti")
        rows = level.select("lang", "words", "f", "heads", "tails")
        out = rows if out is None else out.union(rows)
    whole = "decimal(38,0)"
    rows = out.join(sizes, "lang")
    # Up to 1000 * a * n and l * r fit 38 digits for a and n below 10^17.
    weight = (F.lit(1000).cast(whole) * F.col("f").cast("decimal(18,0)")).cast(whole)
    rows = rows.withColumn("weight", (weight * F.col("n").cast("decimal(18,0)")).cast(whole))
    cuts = F.expr(
        "transform(sequence(1, size(heads)), k -> named_struct("
        "'score', weight div cast(cast(heads[k - 1] as decimal(18,0)) "
        "* cast(tails[size(tails) - k] as decimal(18,0)) as decimal(38,0)), "
        "'k', k, 'l', heads[k - 1], 'r', tails[size(tails) - k]))"
    )
    # The smallest struct: by score, then by the cut's place.
    rows = rows.withColumn("best", F.array_min(cuts))
    return rows.select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"),
        "best.l", "best.r", "n", "best.score",
    )


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST
) -> DataFrame:
    """Each language's ``first`` phrases by score, frequency and phrase: lang, rank, phrase, a,
    l, r, n, score. Spark cuts each task's rows to as many before the last sort."""
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    )
    rows = scored(*frequent(docs, least, longest))
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
