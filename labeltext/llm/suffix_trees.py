"""Repeated passages: suffix trees over words, cut by prefix into groups that fit in memory.

Every word of the corpus begins a suffix. Suffixes are split by their first words, by as few
as give a group that fits in memory: a table of how many suffixes begin with which one, two
or three words (hashed to a fixed number of cells, counted over all documents) says how many
words each takes; where three don't suffice, the first ``width`` words decide. The groups
are independent subtrees; each is built in one task. A branch
of a subtree at a depth of ``width`` words or more that holds suffixes of several documents is
a repeat; consecutive repeated suffixes of a document are the maximal repeats' spans.

A suffix is shipped as a 64-bit code of its first ``width`` words with its document and
place, so a branch at that depth is a run of equal codes and no text is moved.

A branch may be hot: a passage in very many documents. Groups beyond the memory size that a
longer prefix can't split are dealt to several tasks by the suffixes' origin; each finds the
smallest document of its part, and only that one's suffixes meet again in a second round.

Null text has no words. A row with null ``doc_id`` takes part in nothing: nothing is removed
from it or because of it. Rows with equal ``doc_id`` never repeat each other; where they
differ, the places found in one are removed from each. Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.llm.shared import (
    by_bin,
    count_cells,
    shuffle_partitions,
    squeeze,
    unsqueeze,
)
from labeltext.llm.words import WHITE, batch_words, mix, windows
from labeltext.session import cut_lineage

WIDTH = 13
# Suffixes that one task holds at most, unless a branch can't be split.
GROUP_SUFFIXES = 1_000_000
# Cells of the tables of prefix counts, as bits, for one, two, three and ``width`` words.
LEVEL_BITS = (12, 14, 16, 17)
PACKED = "bin int, code binary, doc binary, place binary"


def _levels(words, at: np.ndarray, code: np.ndarray) -> list[np.ndarray]:
    """For the suffixes at words ``at``, their cell in each table of prefix counts."""
    one = words.code[at]
    two = mix(one + words.code[at + 1] * np.uint64(3))
    three = mix(two + words.code[at + 2] * np.uint64(5))
    found, base = [], 0
    for value, bits in zip((one, two, three, code), LEVEL_BITS, strict=True):
        found.append(base + (value >> np.uint64(64 - bits)).astype(np.int64))
        base += 1 << bits
    return found


def _plan(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The bin of each cell, -1 where a longer prefix decides, the tasks that share the bin,
    and the number of bins. Cells are laid one after the other into bins of like size."""
    home = np.full(len(counts), -1)
    share = np.ones(len(counts), np.int64)
    base, used = 0, 0
    for level, bits in enumerate(LEVEL_BITS):
        part = slice(base, base + (1 << bits))
        n = counts[part]
        last = level == len(LEVEL_BITS) - 1
        fits = np.flatnonzero((n > 0) & ((n <= size) | last))
        big = fits[n[fits] > size]
        fits = fits[n[fits] <= size]
        if len(fits):
            home[base + fits] = used + (np.cumsum(n[fits]) - 1) // max(size, 1)
            used = int(home[base + fits].max()) + 1
        for cell in big:
            share[base + cell] = -(-int(n[cell]) // size)
            home[base + cell] = used
            used += int(share[base + cell])
        base += 1 << bits
    return home, share, max(used, 1)


def _rows(bins, code, doc, place) -> Iterator[pa.RecordBatch]:
    """Suffixes packed by bin; codes may be left out."""
    order, names, first = by_bin(bins)
    code = code[order] if len(code) else code
    doc, place = doc[order], place[order]
    spans = list(zip(first[:-1], first[1:], strict=True))
    if spans:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int32()),
                pa.array([code[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([squeeze(doc[a:b]) for a, b in spans], pa.binary()),
                pa.array([squeeze(place[a:b]) for a, b in spans], pa.binary()),
            ],
            ["bin", "code", "doc", "place"],
        )


def _suffixes(docs: DataFrame, width: int, home, share) -> DataFrame:
    """The suffixes of at least ``width`` words, packed by bin."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin = TaskContext.get().partitionId()
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64()).to_numpy()
            for lo, _, words in batch_words(batch.column("text"), WHITE, lower=False, size=4_000_000):
                at, code = windows(words, width)
                if not len(at):
                    continue
                bins = np.full(len(at), -1)
                for cell in _levels(words, at, code):
                    todo = bins < 0
                    own = home[cell]
                    shared = share[cell]
                    if (shared > 1).any():
                        own = own + np.where(own < 0, 0, origin % shared)
                    bins = np.where(todo, own, bins)
                row = words.row[at]
                yield from _rows(bins, code, ids[lo + row], at - words.first[row])
                origin += 1

    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    return known.mapInArrow(deal, PACKED)


def _spread(value: np.ndarray, bins: int) -> np.ndarray:
    """Bins of 64-bit codes."""
    return (((value >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)


def _repeats(packed: DataFrame, bins: int, shared: set[int], parts: int) -> DataFrame:
    """Build each bin's subtree down to depth ``width``. Rows of kind 1 hold, packed by a bin of
    their document, the suffixes on a branch that a smaller document is on too. Rows of kind 2,
    packed by a bin of their code, hold the suffixes of each branch's smallest document, of
    shared bins only: another part may have a smaller one."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[bool, list] = {}
        for batch in batches:
            for name, *data in zip(*(batch.column(k) for k in range(4)), strict=True):
                code, doc, place = (x.as_buffer() for x in data)
                groups.setdefault(name.as_py() in shared, []).append(
                    (np.frombuffer(code, np.uint64), unsqueeze(doc), unsqueeze(place))
                )
        for split, held in groups.items():
            code, doc, place = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(code)
            code, doc, place = code[order], doc[order], place[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            least = np.repeat(
                np.minimum.reduceat(doc, first), np.diff(np.append(first, len(code)))
            )
            late = doc > least
            if split:
                early = ~late
                for batch in _rows(_spread(code[early], parts), code[early], doc[early], place[early]):
                    yield named(batch, 2)
            code, doc, place = code[late], doc[late], place[late]
            order = np.lexsort((place, doc))
            doc, place = doc[order], place[order]
            home = _spread(mix(doc.astype(np.uint64)), parts)
            for batch in _rows(home, code[:0], doc, place):
                yield named(batch, 1)

    def named(batch: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        kinds = pa.array(np.full(batch.num_rows, kind), pa.int32())
        return pa.RecordBatch.from_arrays([kinds, *batch.columns], ["kind", *batch.schema.names])

    return packed.repartitionById(bins, "bin").mapInArrow(build, f"kind int, {PACKED}")


def _by_document(packed: DataFrame, parts: int) -> DataFrame:
    """One row per document of packed suffixes, with their places."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            (unsqueeze(doc.as_buffer()), unsqueeze(place.as_buffer()).astype(np.int32))
            for batch in batches
            for doc, place in zip(batch.column("doc"), batch.column("place"), strict=True)
        ]
        if not held:
            return
        doc, place = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        for k in range(0, len(first), 5_000):
            start = first[k : k + 5_000]
            end = first[k + 5_000] if k + 5_000 < len(first) else len(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[start]),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(start, end) - start[0], pa.int32()),
                        pa.array(place[start[0] : end]),
                    ),
                ],
                ["doc_id", "places"],
            )

    return packed.select("bin", "doc", "place").repartitionById(parts, "bin").mapInArrow(
        gather, "doc_id long, places array<int>"
    )


def repeated_places(docs: DataFrame, width: int = WIDTH, size: int = GROUP_SUFFIXES) -> DataFrame:
    """doc_id and the places (word numbers) where a passage of ``width`` words begins that a
    document with a smaller doc_id has too; one row per document that has any."""
    spark = docs.sparkSession

    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, words in batch_words(batch.column("text"), WHITE, lower=False):
            at, code = windows(words, width)
            if len(at):
                yield from _levels(words, at, code)

    known = docs.where("doc_id is not null and text is not null")
    counts = count_cells(known.select("text"), sum(1 << b for b in LEVEL_BITS), cells)
    total = int(counts[: 1 << LEVEL_BITS[0]].sum())
    parts = shuffle_partitions(spark)
    size = max(1000, min(size, -(-total // (2 * parts))))
    home, share, bins = _plan(counts, size)
    shared = {
        int(home[cell]) + k for cell in np.flatnonzero(share > 1) for k in range(share[cell])
    }
    found = _repeats(_suffixes(docs, width, home, share), bins, shared, parts)
    columns = [F.col(name) for name in ("bin", "code", "doc", "place")]
    if shared:
        found = cut_lineage(found)
        again = found.where("kind = 2").select(columns)
        found = found.where("kind = 1").union(_repeats(again, parts, set(), parts))
    return _by_document(found, parts)


def drop_repeats(docs: DataFrame, width: int = WIDTH, size: int = GROUP_SUFFIXES) -> DataFrame:
    """Every row with the words removed that a repeated passage covers: doc_id, n_words,
    n_removed, kept_sha256, and ``spans``, the maximal runs of removed words (start, end)."""
    places = repeated_places(docs, width, size)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, digest, spans = [], [], [], []
            for text, begin in zip(batch.column("text"), batch.column("places"), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                removed, runs = 0, []
                if begin.is_valid and len(begin):
                    step = np.zeros(len(words) + 1, np.int64)
                    at = begin.values.to_numpy()
                    at = at[at < len(words)]
                    np.add.at(step, at, 1)
                    np.add.at(step, np.minimum(at + width, len(words)), -1)
                    covered = np.cumsum(step[:-1]) > 0
                    edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                    runs = edge.reshape(-1, 2).tolist()
                    removed = int(covered.sum())
                    total.append(len(words))
                    words = compress(words, ~covered)
                else:
                    total.append(len(words))
                gone.append(removed)
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
                spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"],
            )

    return (
        docs.select("doc_id", "text").join(places, "doc_id", "left")
        .mapInArrow(
            remove,
            "doc_id long, n_words long, n_removed long, kept_sha256 string, "
            "spans array<array<long>>",
        )
    )
