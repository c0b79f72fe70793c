"""Benchmark decontamination with an FM-index per training shard.

The test phrases are the runs of ``width`` words of the benchmark items. A shard is a run of
documents that one task reads. Its string is what could hold a phrase at all: words and pairs
of neighbours that occur in the benchmark, in runs long enough; everything else is a break. A
shard ends where its string has ``SHARD_WORDS`` words, which bounds the index.
Over it a task builds an FM-index: suffix array, Burrows-Wheeler transform, wavelet tree with
rank tables, and every ``SAMPLE``-th suffix position. All phrases are searched backwards
together; occurrences are located by walking back to sampled positions, and the spans of
words that they cover are merged per document.

Documents aren't shuffled. The benchmark is read in blocks of bounded size; each block is
one pass over the documents, and the passes add to the same columns.

Null or empty text has no words and no hits; a null or empty item has no phrase. Item ids are
compared as strings; items with equal ids count once. Every row of the documents is judged by
itself, whatever its ``doc_id``; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.llm.shared import releasing
from labeltext.llm.words import NOT_ALNUM, Words, batch_words, cut_words, text_bytes

WIDTH = 10
# Words of benchmark text in a block.
BLOCK_WORDS = 2_000_000
# Words of a shard's string, passed by at most those of one chunk of text.
SHARD_WORDS = 200_000
SAMPLE = 16
STATE = "doc_id long, text string, spans array<array<int>>, items array<string>"


class WaveletTree:
    """Ranks over a sequence of symbols: a bit table per level of the symbols' bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.zeros, self.ranks = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            rank = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(bit, out=rank[1:])
            self.ranks.append(rank)
            self.zeros.append(len(symbols) - int(rank[-1]))
            symbols = symbols[np.argsort(bit, kind="stable")]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``, less a number that depends on the
        symbol alone: ranks are used as differences to ``rank(symbol, 0)``."""
        for level, (rank, zeros) in enumerate(zip(self.ranks, self.zeros, strict=True)):
            ones = rank[place]
            bit = (symbol >> (self.bits - 1 - level)) & 1
            place = np.where(bit == 1, zeros + ones, place - ones)
        return place

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and ``rank`` of it there."""
        symbol = np.zeros(len(place), np.int64)
        for rank, zeros in zip(self.ranks, self.zeros, strict=True):
            ones = rank[place]
            bit = rank[place + 1] - ones
            symbol = symbol * 2 + bit
            place = np.where(bit == 1, zeros + ones, place - ones)
        return symbol, place


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes, by doubling the compared length."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    step = 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:] if step < n else rank[:0]
        order = np.lexsort((second, rank))
        new = np.ones(n, bool)
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if rank.max() == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Index of a string of positive symbols below ``2 ** bits``; 0 ends it."""

    def __init__(self, text: np.ndarray, bits: int):
        text = np.append(text, 0)
        order = suffix_array(text)
        last = text[order - 1]
        self.tree = WaveletTree(last, bits)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        self.sampled = np.where(order % SAMPLE == 0, order, -1)
        self.size = len(text)

    def _step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        zero = self.tree.rank(symbol, np.zeros(len(symbol), np.int64))
        return self.before[symbol] + self.tree.rank(symbol, place) - zero

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of equally long phrases -> their ranges in the sorted suffixes."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size)
        for k in range(phrases.shape[1] - 1, -1, -1):
            alive = np.flatnonzero(low < high)
            if not len(alive):
                break
            symbol = phrases[alive, k]
            low[alive] = self._step(symbol, low[alive])
            high[alive] = self._step(symbol, high[alive])
        return low, np.maximum(low, high)

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Positions in the text of sorted suffixes."""
        out, walked = np.zeros(len(place), np.int64), 0
        todo, place = np.arange(len(place)), place.copy()
        while len(todo):
            found = self.sampled[place]
            done = found >= 0
            out[todo[done]] = found[done] + walked
            todo, place = todo[~done], place[~done]
            symbol, rank = self.tree.access(place)
            zero = self.tree.rank(symbol, np.zeros(len(symbol), np.int64))
            place, walked = self.before[symbol] + rank - zero, walked + 1
        return out


class Runs(NamedTuple):
    """Words that could be part of a phrase, as symbols, with a break after each run; the row
    of each and its place among the row's words."""

    symbol: np.ndarray
    row: np.ndarray
    place: np.ndarray


class Phrases:
    """The phrases of a block of items, as symbols of the block's own vocabulary."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        texts = pa.array([text for _, text in items], pa.large_string())
        words = cut_words(*text_bytes(texts), NOT_ALNUM, True)
        self.width = width
        self.vocabulary, symbol = np.unique(words.code, return_inverse=True)
        symbol = symbol + 1
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        first, self.by_length = words.first, {}
        owners: dict[tuple, set[str]] = {}
        pairs = []
        for k, (name, _) in enumerate(items):
            own = symbol[first[k] : first[k + 1]]
            pairs.append(self._pair(own[:-1], own[1:]))
            for at in range(max(1, len(own) - width + 1) if len(own) else 0):
                named = owners.setdefault(tuple(own[at : at + width].tolist()), set())
                if name is not None:
                    named.add(name)
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        for phrase, names in owners.items():
            rows, who = self.by_length.setdefault(len(phrase), ([], []))
            rows.append(phrase)
            who.append(sorted(names))
        self.by_length = {
            length: (np.array(rows, np.int64), who)
            for length, (rows, who) in self.by_length.items()
        }
        self.shortest = min(self.by_length, default=1)

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a << 32) | b

    def symbols(self, code: np.ndarray) -> np.ndarray:
        """Symbols of words, 0 for words that aren't in the benchmark."""
        if not len(self.vocabulary) or not len(code):
            return np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, code), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == code, at + 1, 0)

    def runs(self, words: Words, row: int) -> Runs:
        """What of ``words``, whose first row is number ``row``, could hold a phrase."""
        symbol = self.symbols(words.code)
        # Runs of neighbours that the benchmark has, within one row.
        joined = np.zeros(len(symbol), bool)
        at = np.flatnonzero((symbol[1:] > 0) & (symbol[:-1] > 0) & (words.row[1:] == words.row[:-1]))
        if len(at) and len(self.pairs):
            pair = self._pair(symbol[at], symbol[at + 1])
            near = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[at + 1] = self.pairs[near] == pair
        opens = (symbol > 0) & ~joined
        start, run = np.flatnonzero(opens), np.cumsum(opens) - 1
        length = np.bincount(run[symbol > 0], minlength=len(start))
        keep = length >= self.shortest
        start, length = start[keep], length[keep]
        size = length + 1
        offset = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        at = np.minimum(np.repeat(start, size) + offset, len(symbol) - 1)
        text = np.where(offset < np.repeat(length, size), symbol[at], len(self.vocabulary) + 1)
        return Runs(text, row + words.row[at], at - words.first[words.row[at]])

    def find(self, shard: list[Runs]) -> Iterator[tuple[int, int, int, list[str]]]:
        """(row, first word, end, items) of every occurrence of a phrase; words are counted
        within their row."""
        text, row, start = (np.concatenate(parts) for parts in zip(*shard, strict=True))
        if not len(text):
            return
        index = FMIndex(text, (len(self.vocabulary) + 1).bit_length())
        for width, (rows, names) in self.by_length.items():
            low, high = index.search(rows)
            many = high - low
            hit = np.repeat(np.arange(len(rows)), many)
            place = np.repeat(low, many) + np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)
            at = index.locate(place)
            for which, r, word in zip(hit.tolist(), row[at].tolist(), start[at].tolist(), strict=True):
                yield r, word, word + width, names[which]

    def occurrences(
        self, column: pa.Array, shard_words: int = SHARD_WORDS
    ) -> Iterator[tuple[int, int, int, list[str]]]:
        """``find`` over a text column, shard by shard. Text is cut in chunks, of which only
        the runs are kept until the shard is full."""
        shard, size = [], 0
        for row, _, words in batch_words(column, NOT_ALNUM, True):
            shard.append(self.runs(words, row))
            size += len(shard[-1].symbol)
            if size >= shard_words:
                yield from self.find(shard)
                shard, size = [], 0
        if shard:
            yield from self.find(shard)


def _pass(docs: DataFrame, phrases: Phrases) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for row, start, end, names in phrases.occurrences(batch.column("text")):
                spans[row].append([start, end])
                items[row].extend(names)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array([_merged(x) for x in spans], pa.list_(pa.list_(pa.int32()))),
                    pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
                ],
                ["doc_id", "text", "spans", "items"],
            )

    return docs.mapInArrow(releasing(scan), STATE)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _blocks(benchmark: DataFrame, size: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of about ``size`` words, one of which the driver holds at a time.
    An item without an id is searched too: its hits count, but it names and counts as none."""
    items = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), "text"
    )
    block, words = [], 0
    for name, text in items.toLocalIterator():
        block.append((name, text))
        words += len(text) // 2
        if words >= size:
            yield block
            block, words = [], 0
    if block:
        yield block


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK_WORDS
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, ``items`` and
    ``spans``, the merged runs (start, end) of words inside occurrences."""
    state = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.expr("cast(array() as array<array<int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for items in _blocks(benchmark, block):
        state = _pass(state, Phrases(items, width))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(batch.num_rows, np.int64)
            for lo, hi, words in batch_words(batch.column("text"), NOT_ALNUM, True):
                total[lo:hi] = words.per_row
            items = batch.column("items").to_pylist()
            hit = [sum(b - a for a, b in x) for x in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(total),
                    pa.array(hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                    pa.array([h > 0 for h in hit], pa.bool_()),
                    batch.column("items"),
                    batch.column("spans"),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items",
                 "spans"],
            )

    return state.mapInArrow(
        releasing(digest),
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
        "contaminated boolean, items array<string>, spans array<array<int>>",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no phrase of the benchmark."""
    for items in _blocks(benchmark, block):
        docs = _without(docs, Phrases(items, width))
    return docs


def _without(docs: DataFrame, phrases: Phrases) -> DataFrame:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, *_ in phrases.occurrences(batch.column("text")):
                keep[row] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(releasing(clean), docs.schema)
