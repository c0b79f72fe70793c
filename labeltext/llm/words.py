"""Vectorised word tokenising over Arrow text columns: helpers that run inside Spark tasks.

Words are cut and hashed on the UTF-8 bytes of many texts at once, without a Python loop
per word. A word's hash is 64 bit, of a state of 128 bits that is scattered after every eight
bytes; whoever compares hashes treats equal ones as equal words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are cut at a time. A longer text is taken alone.
CHUNK_BYTES = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)
# Masks for the first 0 to 8 bytes of a little-endian block.
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# Everything in ASCII but digits and lower-case letters.
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def word_codes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs that begin at ``start``. Two lanes take up the words'
    blocks of eight bytes; each block changes both, and each lane the other, through ``mix``."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # Eight bytes from every place on.
    blocks = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    one = mix(length.astype(np.uint64) * _STEP + _TURN)
    two = one ^ _STEP
    # Words with a further block come first, so that each round works on a shorter run.
    order = np.argsort(-((length + 7) // 8), kind="stable") if length.max() > 8 else None
    if order is not None:
        start, length, one, two = start[order], length[order], one[order], two[order]
    place, many = 0, len(start)
    while many:
        left = np.minimum(length[:many] - place, 8)
        block = blocks[start[:many] + place] & _MASKS[left]
        first = mix((one[:many] ^ block) * _TURN + two[:many])
        two[:many] = mix(two[:many] + block * _STEP) ^ (first >> np.uint64(17))
        one[:many] = first
        place += 8
        many = int(np.count_nonzero(length[:many] > place))
    code = mix(one + two * _STEP)
    if order is not None:
        out = np.empty_like(code)
        out[order] = code
        return out
    return code


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edges = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    edges = edges.astype(np.int64)
    if data is None or edges[0] == edges[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def row_chunks(edges: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one row."""
    first, rows = 0, len(edges) - 1
    while first < rows:
        last = int(np.searchsorted(edges, edges[first] + size, side="right")) - 1
        last = max(first + 1, min(last, rows))
        yield first, last
        first = last


@dataclass
class Words:
    """Words of a run of rows: ``row`` counts from the first row of the run."""

    row: np.ndarray  # row of each word
    start: np.ndarray  # first byte of each word, in the bytes of the run
    end: np.ndarray
    code: np.ndarray  # 64-bit hash of each word
    per_row: np.ndarray  # words in each row

    @property
    def first(self) -> np.ndarray:
        """Index of the first word of each row, and the end."""
        return np.concatenate([[0], np.cumsum(self.per_row)])


def cut_words(data: np.ndarray, edges: np.ndarray, separator: np.ndarray, lower: bool) -> Words:
    """Cut every row into its runs of bytes that are no separators."""
    rows, size = len(edges) - 1, len(data)
    if lower:
        data = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
    inside = ~separator[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cuts = edges[(edges > 0) & (edges < size)]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(rows, np.int64))
    row = np.searchsorted(edges, start, side="right") - 1
    length = end - start
    code = word_codes(data, start, length)
    return Words(row, start, end, code, np.bincount(row, minlength=rows))


def batch_words(
    column: pa.Array, separator: np.ndarray, lower: bool, size: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row, words) for runs of rows of a text column."""
    data, edges = text_bytes(column)
    for first, last in row_chunks(edges, size):
        part = data[edges[first] : edges[last]]
        yield first, last, cut_words(part, edges[first : last + 1] - edges[first], separator, lower)


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and 64-bit hash of every run of ``width`` words within one row. Hashes of
    runs of 1, 2, 4, ... words are put together, scattered each time."""
    n = len(words.code) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code, done, run, size = None, 0, words.code, 1
    while True:
        if width & size:
            part = run[done : done + n]
            code = part if code is None else mix(code * _STEP + part)
            done += size
        size *= 2
        if size > width:
            break
        run = mix(run[: len(run) - size // 2] * _TURN + run[size // 2 :])
    at = np.flatnonzero(words.row[:n] == words.row[width - 1 :])
    return at, mix(code[at] + np.uint64(width))


def row_shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle of each row, sorted by row and hash. A row with
    fewer than ``width`` words has its whole sequence as one; a row without words has none."""
    at, code = windows(words, width)
    row = words.row[at]
    short = np.flatnonzero((words.per_row > 0) & (words.per_row < width))
    if len(short):
        first = words.first
        extra = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = words.per_row[short] > k
            take = words.code[np.minimum(first[short] + k, len(words.code) - 1)]
            extra = np.where(has, mix(extra * _STEP + take), extra)
        extra = mix(extra + words.per_row[short].astype(np.uint64))
        row, code = np.concatenate([row, short]), np.concatenate([code, extra])
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    if len(row):
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        row, code = row[new], code[new]
    return row, code
